import hashlib
import io
import zipfile

import pytest

from cdrflow.llm import warc_zip as W


def reader(data):
    return lambda at, n: data[at : at + n]


def make(**options):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", **options) as z:
        z.writestr("a/é.txt", b"hello")
        with z.open(zipfile.ZipInfo("big"), "w", force_zip64=True) as m:
            m.write(b"x" * 1000)
        z.comment = b"PK\x05\x06 is not a record" + b"\0" * 30
    return out.getvalue()


def test_directory_and_stored_bytes():
    data = make()
    found = W.central_directory(reader(data), len(data))
    assert set(found) == {"a/é.txt", "big"}
    at = W.stored_at(reader(data), found["big"])
    assert data[at : at + 1000] == b"x" * 1000 and found["big"].size == 1000
    packed = make(compression=zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="compressed"):
        W.stored_at(reader(packed), W.central_directory(reader(packed), len(packed))["a/é.txt"])


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = make()
    assert W.EOCD64 in data and W.LOCATOR64 in data
    found = W.central_directory(reader(data), len(data))
    at = W.stored_at(reader(data), found["big"])
    assert (found["big"].size, data[at : at + 1000]) == (1000, b"x" * 1000)


@pytest.mark.parametrize("data", [b"", b"not a zip", b"PK\x05\x06"])
def test_damaged_files(data):
    with pytest.raises(ValueError):
        W.central_directory(reader(data), len(data))


def test_round_trip(spark):
    big, small = "<p>é" * 200, "x" * 99
    rows = [(5, "http://a/", big), (3, "http://b/\r\nX: y", big), (9, None, big), (3, "http://b/", big), (None, "u", big), (1, "u", small), (2, "u", small),
            (4, "u", None), (6, "u", ""), (7, "ü", "ü" * 50), (8, "ü", "ü" * 50), (None, "q", "only " * 30), (None, "q", "only " * 30), (10, "l", "y" * 3_000_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    manifest, folder = W.archive_pages(df)
    out = W.read_records(W.read_index(manifest, folder), folder).collect()
    assert len(out) == len(rows)
    texts = {}
    for p, _, h in rows:
        texts.setdefault(hashlib.sha256((h or "").encode()).hexdigest(), []).append((p, (h or "").encode()))
    seen = {}
    for r in out:
        same = texts[r.payload_digest]
        ids = [p for p, _ in same if p is not None]
        assert r.payload_bytes == len(same[0][1])
        if r.record_type == "response":
            assert bytes(r.payload) == same[0][1] and r.refers_to is None
        else:
            assert r.payload is None and len(same[0][1]) >= 100 and r.refers_to == (min(ids) if ids else None)
        seen.setdefault(r.payload_digest, []).append((r.record_type, r.page_id))
    for digest, found in seen.items():
        first = [p for t, p in found if t == "response"]
        assert len(found) == len(texts[digest])
        if len(texts[digest][0][1]) >= 100:
            ids = [p for p, _ in texts[digest] if p is not None]
            assert first == [min(ids, default=None)]
        else:
            assert len(first) == len(found)


def test_packages_roll_over_and_none_for_no_pages(spark):
    df = spark.createDataFrame([(i, "u", str(i) * 500) for i in range(50)], "page_id long, url string, html string").coalesce(1)
    pages = df.selectExpr("page_id as row_id", "*")
    folder = W.fresh_path(spark, "warc-test")
    manifest = W.write_packages(W.with_record_types(pages), folder, max_package=2000)
    assert manifest.count() > 3 and manifest.groupBy().sum("records").first()[0] == 50
    assert W.read_records(W.read_index(manifest, folder), folder).count() == 50
    empty, folder = W.archive_pages(df.limit(0))
    assert W.read_records(W.read_index(empty, folder), folder).count() == 0
