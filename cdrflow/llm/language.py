"""Language identification by compression with per-language dictionaries.

A sample of labelled documents of each language is a raw-content Zstandard
dictionary.  A text is compressed with each of them, in equal chunks so that
all its parts count alike; the one that leaves the fewest bytes names the
language, and the margin over the second says how sure that is.  Labelled
documents left out of the dictionaries tell what margin is typical of clean
texts of a language and length; much less than that is narrow.  The model is
the dictionaries, ``dict_bytes`` for each of ``max_languages`` at most, and a
few typical margins for each, however large the corpus is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import other_columns, ship

ship(__name__)

UNKNOWN = "und"
#: Labelled documents of each language at most, chosen by the hash of their id.
SAMPLE_DOCS = 100
#: Characters of a sampled document that go into the dictionary, from a place that a hash of the id chooses.
SAMPLE_CHARS = 2000
DICT_BYTES = 60_000
MAX_LANGUAGES = 200
LEVEL = 12
#: Bytes of letters in a chunk at most: in a longer frame the text's own history would stand in for the dictionary.
CHUNK = 2000
#: A margin is narrow if it is this share of the typical one or less.
NARROW = 0.25
#: One document in so many of a language's sample is left out of its dictionary, to learn the typical margins from.
LEAVE_OUT = 5
#: Such documents at most, of all languages together (two of each at least).
LEFT_OUT_DOCS = 1000
#: Bytes of letters from which a typical margin counts, up to the next one.
LENGTHS = (25, 50, 100, 200, 400, 800, 1600)
#: A typical margin needs so many left-out texts.
MIN_TEXTS = 5
#: Where too few are left out: the typical share of bytes saved, and the bytes of letters that a text needs to be judged by it.
UNMEASURED, MIN_JUDGED = 0.16, 200
SCHEMA_TAIL = "lang_pred string, score double, margin double, rejected boolean"


def letters(text: str | None) -> str:
    """Lower-case letters and marks of a text, with one space for each run of anything else; '' if it has no letter."""
    import regex

    if not text or not regex.search(r"\p{L}", text):
        return ""
    return regex.sub(r"[^\p{L}\p{M}]+", " ", text.lower()).strip()


class Model(dict):
    """{language: dictionary}; ``typical``: {language: its typical margins, see ``_typical``}."""

    def __init__(self, dictionaries: dict[str, bytes], typical: dict[str, list[float | None]] | None = None):
        super().__init__(dictionaries)
        self.typical = typical or {}

    def __reduce__(self):
        return Model, (dict(self), self.typical)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES, max_languages: int = MAX_LANGUAGES) -> Model:
    """{language: dictionary} of the most frequent labelled languages, and their typical margins.

    The sample is bounded (``sample_docs`` of a language) and deterministic:
    the smallest hashes of the id.  Rows of a language are counted by the
    length of that hash in bits, so only those short enough are ranked: about
    twice the sample, however many rows or tasks there are.  Rows without text
    or label are ignored; an empty table gives an empty model; repeated rows
    count as often as they are there.  The dictionary's end, which is cheapest
    to refer to, holds the most frequent words.
    """
    named = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"),
        F.xxhash64(F.col(id_col).cast("string"), F.lit(10)).alias("h"),
        F.xxhash64(F.col(id_col).cast("string"), F.lit(11)).alias("place"),
        F.col(text_col).alias("text"),
    )
    # of h as an unsigned number in the same order
    bits = F.length(F.bin(F.col("h").bitwiseXOR(F.lit(-(1 << 63)))))
    counts = (
        named.groupBy("lang", bits.alias("bits"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang")
        .agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("bits", "n"))).alias("by_bits"))
        .orderBy(F.desc("n"), "lang")
        .limit(max_languages)
    )
    cuts: dict[str, int] = {}
    for row in counts.collect():  # 64 numbers at most for each language
        below = accumulate(n for _, n in row["by_bits"])
        cuts[row["lang"]] = next((b for (b, _), n in zip(row["by_bits"], below) if n >= sample_docs), 64)
    if not cuts:
        return Model({})
    cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair])
    start = 1 + F.pmod("place", F.greatest(F.char_length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int")
    rank = Window.partitionBy("lang").orderBy("h", "text")
    sample = (
        named.filter(bits <= cut[F.col("lang")])
        .select("lang", "h", F.substring(F.col("text"), start, F.lit(SAMPLE_CHARS)).alias("text"))
        .withColumn("nr", F.row_number().over(rank))
        .filter(F.col("nr") <= sample_docs)
    )
    texts: dict[str, list[str]] = {lang: [] for lang in cuts}
    for row in sample.orderBy("lang", "nr").collect():  # sample_docs * max_languages short texts at most
        texts[row["lang"]].append(letters(row["text"]))
    learnt = {lang: [x for i, x in enumerate(t, 1) if i % LEAVE_OUT] for lang, t in texts.items()}
    dictionaries = {lang: _dictionary(t, dict_bytes) for lang, t in learnt.items() if any(t)}
    return Model(dictionaries, _typical(dictionaries, {lang: texts[lang][LEAVE_OUT - 1 :: LEAVE_OUT] for lang in dictionaries}))


def _dictionary(texts: list[str], size: int) -> bytes:
    """Running text, then the distinct words from rare to frequent, within ``size`` bytes."""
    from collections import Counter

    words = Counter(w for t in texts for w in t.split())
    by_use = sorted(words, key=lambda w: (-words[w], w))
    listed, used = [], 0
    for w in by_use:
        used += len(w.encode()) + 1
        if used > size // 2:
            break
        listed.append(w)
    tail = " ".join(reversed(listed))
    head = " ".join(texts).encode()[: max(0, size - len(tail.encode()) - 1)]
    return head + b" " + tail.encode() + b" "


def _typical(dictionaries: dict[str, bytes], left_out: dict[str, list[str]]) -> dict[str, list[float | None]]:
    """For each language and each of ``LENGTHS``: the median share of bytes that the label saves over the best other.

    It is 0 where clean texts can't be told from narrow ones by whole bytes, so
    that nothing is rejected there.  Too few texts of a language: those of all
    languages count; still too few: as for the length before; else None.
    """
    from statistics import median

    if len(dictionaries) < 2:
        return {}
    judge, each = Classifier(dictionaries), max(2, LEFT_OUT_DOCS // len(dictionaries))
    out: dict[str, list[float | None]] = {lang: [] for lang in dictionaries}
    for n in LENGTHS:
        found: dict[str, list[tuple[int, float]]] = {}
        for lang, texts in left_out.items():
            found[lang] = []
            for data in (t.encode()[:n] for t in texts[:each]):
                if len(data) == n:
                    sizes = dict(zip(judge.names, judge.sizes(data)))
                    own, other = sizes.pop(lang), min(sizes.values())
                    found[lang].append((other - own, (other - own) / max(other, own)))
        of_all = [x for v in found.values() for x in v]
        for lang, margins in out.items():
            used = found[lang] if len(found[lang]) >= MIN_TEXTS else of_all
            if len(used) < MIN_TEXTS:
                margins.append(margins[-1] if margins else None)
            else:
                margins.append(median(m for _, m in used) if NARROW * median(b for b, _ in used) >= 1 else 0.0)
    return out


def chunk_bytes(n: int) -> int:
    """Length of the equal chunks that a text of ``n`` bytes is cut into, so that none is a short rest."""
    return -(-n // max(1, -(-n // CHUNK))) or 1


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        import zstandard as zstd

        self.names = sorted(dictionaries)
        self.learnt = getattr(dictionaries, "typical", {})
        self.packers = []
        for name in self.names:
            d = zstd.ZstdCompressionDict(dictionaries[name], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.packers.append(
                zstd.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            )

    def sizes(self, data: bytes) -> list[int]:
        """Compressed bytes by each dictionary: the sum over all chunks."""
        step = chunk_bytes(len(data))
        chunks = [data[i : i + step] for i in range(0, len(data), step)]
        return [sum(len(p.compress(c)) for c in chunks) for p in self.packers]

    def typical(self, name: str, n: int) -> float:
        """The typical margin of texts of ``n`` bytes in a language; 0 if such texts are not to be judged."""
        if n < LENGTHS[0]:
            return 0.0
        known = [m for size, m in zip(LENGTHS, self.learnt.get(name, ())) if size <= chunk_bytes(n)]
        if known and known[-1] is not None:
            return known[-1]
        return UNMEASURED if n >= MIN_JUDGED else 0.0

    def __call__(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, margin, and whether the text is too short to be rejected by its margin.

        The margin is the share of bytes that the best saves over the second,
        in all chunks together, so it does not depend on the text's length; 1
        is typical of clean texts in that language.
        """
        plain = letters(text)
        if not plain or not self.names:
            return UNKNOWN, 0.0, 0.0, False
        order = sorted(zip(self.sizes(plain.encode()), self.names))
        best = order[0]
        n = len(plain.encode())
        if len(order) == 1:
            return best[1], 1.0, 1.0, n < MIN_JUDGED
        typical = self.typical(best[1], n)
        margin = (order[1][0] - best[0]) / order[1][0] / (typical or UNMEASURED)
        return best[1], min(1.0, 0.5 + margin / 2), margin, not typical


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", narrow: float = NARROW) -> DataFrame:
    """``docs`` plus lang_pred, score, margin and rejected.

    ``rejected``: no letter to judge by, or a margin of ``narrow`` or less (of
    the typical one) in a text long enough to be judged: whole bytes must tell
    clean texts of its length in that language from narrow ones.  Ties go to the first name.
    Null, empty and letterless texts are ``und`` with score 0; without any
    dictionary all texts are.  Every row gives one, repeated ones too; an empty
    table gives none.  Columns of ``docs`` stay as they are, whatever their
    names, but for those four: the result's take their place.
    """
    added = StructType.fromDDL(SCHEMA_TAIL)
    names = other_columns(docs.columns, added.names)
    rows = docs.select(*[docs[c] for c in names], *([] if text_col in names else [docs[text_col]]))
    at = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(dictionaries)
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                found = [judge(t) for t in part.column(at).to_pylist()]
                extra = pd.DataFrame(found, columns=["lang_pred", "score", "margin", "short"])
                rejected = (extra["lang_pred"] == UNKNOWN) | (~extra["short"] & (extra["margin"] <= narrow))
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[: len(names)],
                        pa.array(extra["lang_pred"], pa.string()),
                        pa.array(extra["score"], pa.float64()),
                        pa.array(extra["margin"], pa.float64()),
                        pa.array(rejected, pa.bool_()),
                    ],
                    names=[*part.schema.names[: len(names)], "lang_pred", "score", "margin", "rejected"],
                )

    return rows.mapInArrow(run, StructType([*rows.schema.fields[: len(names)], *added.fields]))
