import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cdrflow.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", "  \n", "It's we'll THE the the, the. (the).", "e\u0301té ÉTÉ étés, naïve—quoted “x”", "<|endoftext|> a<|startoftext|>b",
       "日本語 テスト ½ x\u3000y z\x85w\x1cq", "a" * 3000, "don't, stop.'s x's,'ll", "Σίσυφος ΣΑΣ", "word\u00d7two\u00f7three ÿ", "1,234.5 a1b2"]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_chunks_give_the_ids_of_the_text(tokenizer):
    encode = P.ChunkEncoder(PATH)
    for texts in (ODD, ODD[::-1]):
        for t, ids in zip(texts, encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, t


def test_level_minimises_the_sum_of_squares():
    rnd = random.Random(5)
    state = P.SumOfSquares(32)

    def total(counts):
        return int((counts[1:32] ** 2).sum())

    for _ in range(400):
        size = rnd.randint(1, 31)
        options = {}
        for h in [0, *[h for h in range(1, 33 - size) if state.counts[h]]]:
            after = state.counts.copy()
            after[h] -= h > 0
            after[h + size] += 1
            options[h] = total(after)
        chosen = state.level_for(size)
        assert options[chosen] == min(options.values())
        state.place(P.Piece(0, 0, b"\0\0\0\0" * size, size))
        assert sum(state.counts[1:32]) == sum(len(w) for w in state.windows.values())


def check(rows, docs, tokenizer, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(docs)
    for i, text in docs.items():
        ids, at = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for s in by_seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and at & (at - 1) == 0  # full, or cut at a power of two: no padding


def test_pieces_cover_every_document_once(spark, tokenizer):
    rnd = random.Random(6)
    docs = dict(enumerate(ODD))
    docs |= {100 + i: " ".join(rnd.choice(["alpha", "beta,", "Gamma"]) for _ in range(rnd.randint(0, 150))) for i in range(120)}
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs.items()], "doc_id long, text string, start int, length int").repartition(3)
    rows = P.with_checksums(P.pack_documents(df, PATH, 2, capacity=128)).collect()
    check(rows, docs, tokenizer, 128)
    assert sum(r.whole for r in rows) > 0.3 * len(docs)


def test_no_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert P.pack_documents(df.limit(0), PATH, 2).count() == 0
    assert sorted(r.doc_tokens for r in P.pack_documents(df, PATH, 2).collect() if r.start == 0) == [3, 3]


def test_nearly_all_is_placed_by_sum_of_squares(monkeypatch):
    """Of 1,000 documents as long as those of the tables, little is laid without level_for; no id is lost."""
    rnd = random.Random(8)
    sizes = [min(20_000, int(rnd.lognormvariate(6.2, 1.0)) + 1) for _ in range(1000)]
    placed = 0
    real = P.SumOfSquares.place

    def place(self, piece, new=True):
        nonlocal placed
        placed += len(piece)
        return real(self, piece, new)

    monkeypatch.setattr(P.SumOfSquares, "place", place)
    windows = list(P.pack((P.Piece(i, 0, b"\1\0\0\0" * n, n) for i, n in enumerate(sizes)), 4096))
    total = sum(sizes)
    assert sum(len(p) for w in windows for p in w) == total
    fill = [sum(map(len, w)) for w in windows]
    ends = [n for n in fill if n < 4096]
    assert sum(ends) < 4096 and all(n & (n - 1) == 0 for n in ends)
    whole = sum(4096 * (n // 4096) for n in sizes)  # windows that one document fills alone
    assert placed >= total - whole - 4096 and sum(ends) < 0.05 * total
    for i, n in enumerate(sizes):
        parts = sorted((p.start, len(p)) for w in windows for p in w if p.doc_id == i)
        assert [a for a, _ in parts] == [sum(m for _, m in parts[:k]) for k in range(len(parts))] and sum(m for _, m in parts) == n


def test_a_worker_keeps_what_it_learnt(tokenizer):
    encode = P.ChunkEncoder.of_worker(PATH)
    encode(["some words to learn"])
    assert P.ChunkEncoder.of_worker(PATH) is encode and b"learn" in encode.known


def test_letters_go_to_the_model_alone(tokenizer):
    """Runs of letters, ASCII and Latin-1 of either case, give the tokenizer's ids without its normalizer and patterns."""
    encode, asked = P.ChunkEncoder(PATH), []
    real = encode._encode
    encode._encode = lambda chunks: (asked.extend(chunks), real(chunks))[1]
    words = ["word", "ÉTÉS", "straße", "àíß", "ÀÍÞÿ", "a" * 300, "naïve"]
    words += [chr(c) + "x" + chr(c) for c in [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]]
    texts = [w + m for w in words for m in ("", ",", "?!")]
    for t, ids in zip(texts, encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t
    assert sorted(asked) == [b",", b"?!"]
