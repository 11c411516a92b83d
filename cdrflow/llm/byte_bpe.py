"""Byte-level BPE encoding and decoding with SQL higher-order functions.

A text is cut into words by the vocabulary's pattern.  A word's bytes start as
one piece each; a fold merges, step by step, the adjacent pair whose joined
piece has the lowest rank, until no joined piece has one.  Of a short word the
state is an array of numbers, one for each piece, that tell its id and what it
joins to with the next one, found in a table of all pairs; of a long word it is
a text, so that a step merges all occurrences of a pair.

Words repeat, so the corpus' distinct words are counted and the most frequent
ones (``MAX_CACHED`` at most) are folded once.  Their ids are a table of
bounded size however large the corpus is: maps for the ``HOT`` ones, which are
most of a text, and a text for each bucket of the others.  Any other word is
folded where it stands, so the result never depends on the cache.  Documents
are not shuffled; only word counts are.

All these tables are values of scalar subqueries: the plan's text doesn't hold
them, and tasks get them as bytes.  Inside an expression a byte is the character
of the same number (ISO-8859-1), and ``EDGE`` characters, which no byte has,
stand around the pieces of a long word.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize

#: Words whose ids are kept, about 30 bytes each; tasks get them with their plan.
MAX_CACHED = 1 << 19
#: Of these, the most frequent ones, which have maps.
HOT = 1 << 15
#: Longer words (bytes) are folded where they stand, and all words that are kept have so many bytes together at most.
LONGEST_CACHED, MAX_CACHED_BYTES = 256, 1 << 23
#: Words up to so many bytes are folded as numbers: an id, the place of the piece above it, what it joins to on top.
SHORT = 64
ID_BITS, PLACE_BITS = 20, 20
NO_PAIR = 1 << ID_BITS
#: Counts above are one class when the cut-off is sought.
COUNT_LIMIT = 100_000
#: Entries of a lookup bucket on average.
PER_BUCKET = 6
OPEN, CLOSE = "Ā", "ā"
KEY, VALUE = "\x01", "\x02"

#: Unicode white space, as the pattern's ``\s`` means it; Java's ``\s`` is ASCII only.
SPACES = r"\t-\r \x85\xA0  -     　"


def java_pattern(pattern: str) -> str:
    """The vocabulary's word pattern with ``\\s`` and ``\\S`` spelt out for Java, its endings as one branch."""
    return (
        pattern.replace("'s|'t|'re|'ve|'m|'ll|'d", "'(?:[stmd]|re|ve|ll)")
        .replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")
    )


def _latin(piece: bytes) -> str:
    return piece.decode("latin-1")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _find(buckets: Column, n: int, key: Column) -> Column:
    """The value of ``key`` in a literal array of maps; null if it has none."""
    return F.get(buckets, F.pmod(F.crc32(key), F.lit(n)).cast("int"))[key]


def _shipped(spark: SparkSession, value: list, element: pa.DataType) -> Column:
    """A list as a scalar subquery's value (array).

    It may not stand in a higher-order function before the plan is optimized:
    let it be a column of its own, used once, as in ``with_tables``.
    """
    return spark.createDataFrame(pa.table({"value": pa.array([value], pa.list_(element))})).scalar()


def with_tables(df: DataFrame, tables: list[Column], result: str, body: Callable[..., Column]) -> DataFrame:
    """``df`` with the column ``result``, which ``body`` makes of the tables; rows do not carry these."""
    names = [f"table_{uuid.uuid4().hex}" for _ in tables]

    def bound(left: list[str], had: tuple[Column, ...]) -> Column:
        return _let(F.col(left[0]), lambda c: bound(left[1:], (*had, c))) if left else body(*had)

    return df.withColumns(dict(zip(names, tables))).withColumn(result, bound(names, ())).drop(*names)


@dataclass(frozen=True)
class Vocabulary:
    """Ranked pieces (rank = id) and the word pattern."""

    pieces: dict[bytes, int]
    pattern: str

    @staticmethod
    def load(path: str, pattern: str) -> Vocabulary:
        """A rank file: a base64 piece and its rank on each line."""
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        return Vocabulary({base64.b64decode(a): int(b) for a, b in rows}, pattern)

    @property
    def buckets(self) -> int:
        return max(1, len(self.pieces) // PER_BUCKET)

    @property
    def no_id(self) -> int:
        """No piece's id, but less than ``pair_base``."""
        return max(self.pieces.values(), default=-1) + 1

    @property
    def pair_base(self) -> int:
        """Ids a, b are the pair a * pair_base + b; odd, so that a pair's low bits depend on both."""
        return self.no_id + 1 | 1

    def ranks(self, spark: SparkSession) -> Column:
        maps: list[list] = [[] for _ in range(self.buckets)]
        for piece, rank in self.pieces.items():
            text = _latin(piece)
            maps[zlib.crc32(text.encode()) % len(maps)].append((text, rank))
        return _shipped(spark, maps, pa.map_(pa.string(), pa.int32()))

    def pairs(self, spark: SparkSession) -> Column:
        """The id of the joined piece for each two pieces that have one, in buckets by the pair's low bits."""
        if self.no_id >= NO_PAIR - 1 or any(bytes([i]) not in self.pieces for i in range(256)):
            raise ValueError(f"a vocabulary has all bytes, and ids below {NO_PAIR - 1}")
        found, base = [], self.pair_base
        for piece, rank in self.pieces.items():
            for k in range(1, len(piece)):
                a, b = self.pieces.get(piece[:k]), self.pieces.get(piece[k:])
                if a is not None and b is not None:
                    found.append((a * base + b, rank))
        maps: list[list] = [[] for _ in range(1 << len(found).bit_length())]
        for pair, rank in found:
            maps[pair & len(maps) - 1].append((pair, rank))
        return _shipped(spark, maps, pa.map_(pa.int64(), pa.int32()))

    def _by_id(self, value) -> Column:
        out = [""] * (max(self.pieces.values(), default=-1) + 1)
        for piece, i in self.pieces.items():
            out[i] = value(piece, i)
        return F.from_json(F.lit(json.dumps(out)), "array<string>")

    def hex_pieces(self) -> Column:
        return self._by_id(lambda piece, _: piece.hex())

    def hex_ids(self) -> Column:
        return self._by_id(lambda _, i: i.to_bytes(4, "little").hex())


def _short_fold(data: Column, pairs: Column, vocabulary: Vocabulary) -> Column:
    """The ids of a word by its pieces' numbers: what the piece joins to with the next, its place, its id.

    So the least number is the pair to merge, the first one of the lowest rank.
    A step merges one pair.
    """
    base, no_id = vocabulary.pair_base, F.lit(vocabulary.no_id).cast("long")
    rest = ID_BITS + PLACE_BITS
    place_mask, gone = ((1 << PLACE_BITS) - 1) << ID_BITS, F.lit(-1).cast("long")

    def id_of(number: Column) -> Column:
        return number.bitwiseAND(F.lit((1 << ID_BITS) - 1))

    def joined(a: Column, b: Column) -> Column:
        pair = a * F.lit(base) + b
        id_ = F.get(pairs, pair.bitwiseAND(F.size(pairs) - 1).cast("int"))[pair]
        return F.shiftleft(F.coalesce(id_, F.lit(NO_PAIR)).cast("long"), rest)

    def step(numbers: Column) -> Column:
        def merge(best: Column) -> Column:
            id_ = F.shiftright(best, rest)

            def after(number: Column, i: Column) -> Column:
                following = F.get(numbers, i + 1)
                merged = joined(id_, id_of(F.coalesce(F.get(numbers, i + 2), no_id)))
                return (
                    F.when(number == best, merged.bitwiseOR(best.bitwiseAND(F.lit(place_mask))).bitwiseOR(id_))
                    .when(following == best, joined(id_of(number), id_).bitwiseOR(number.bitwiseAND(F.lit((1 << rest) - 1))))
                    .when(F.get(numbers, i - 1) == best, gone)
                    .otherwise(number)
                )

            end = best >= F.lit(NO_PAIR << rest)
            return F.when(end, numbers).otherwise(F.array_remove(F.transform(numbers, after), gone))

        return _let(F.array_min(numbers), merge)

    def run(bytes_: Column) -> Column:
        first = F.transform(
            bytes_,
            lambda a, i: joined(a, F.coalesce(F.get(bytes_, i + 1), no_id))
            .bitwiseOR(F.shiftleft(i.cast("long"), ID_BITS))
            .bitwiseOR(a),
        )
        steps = F.sequence(F.lit(1), F.greatest(F.size(bytes_) - 1, F.lit(1)))
        return F.aggregate(steps, first, lambda s, _: step(s), lambda s: F.transform(s, lambda x: id_of(x).cast("int")))

    ids = F.from_json(F.lit(json.dumps([vocabulary.pieces.get(bytes([i])) for i in range(256)])), "array<bigint>")
    return _let(F.transform(F.split(data, ""), lambda c: F.get(ids, F.ascii(c))), run)


def _long_fold(data: Column, ranks: Column, n: int) -> Column:
    """The ids of a word by a text of its pieces.

    One step merges every occurrence of the best pair, left to right; a merged
    piece ranks after its parts, so this is the order of merging one by one.
    """

    def rank(piece: Column) -> Column:
        return _find(ranks, n, piece)

    def inside(s: Column) -> Column:
        """The pieces, without the first and the last edge."""
        return F.split(F.substring(s, F.lit(2), F.char_length(s) - 2), CLOSE + OPEN)

    def step(state: Column) -> Column:
        def merge(pieces: Column) -> Column:
            pairs = F.zip_with(
                pieces, F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), lambda a, b: rank(F.concat(a, b))
            )

            def best(r: Column) -> Column:
                at = F.array_position(r, F.array_min(r)).cast("int")
                a, b = F.get(pieces, at - 1), F.get(pieces, at)
                apart = F.concat(F.lit(OPEN), a, F.lit(CLOSE + OPEN), b, F.lit(CLOSE))
                merged = F.replace(state["s"], apart, F.concat(F.lit(OPEN), a, b, F.lit(CLOSE)))
                end = F.array_min(r).isNull()
                return F.struct(F.when(end, state["s"]).otherwise(merged).alias("s"), end.alias("end"))

            return _let(pairs, best)

        return F.when(state["end"], state).otherwise(_let(inside(state["s"]), merge))

    start = F.concat(F.lit(OPEN), F.array_join(F.split(data, ""), CLOSE + OPEN), F.lit(CLOSE))
    return F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.char_length(data) - 1, F.lit(1))),
        F.struct(start.alias("s"), (F.char_length(data) < 2).alias("end")),
        lambda state, _: step(state),
        lambda state: F.transform(inside(state["s"]), rank),
    )


def fold(word: Column, vocabulary: Vocabulary, ranks: Column, pairs: Column) -> Column:
    """The ids of a word (array<int>); empty for the empty word.  The last two are the vocabulary's tables."""

    def ids(data: Column) -> Column:
        whole = _let(_find(ranks, vocabulary.buckets, data), lambda r: F.when(r.isNotNull(), F.array(r)))
        short = F.when(F.char_length(data) <= SHORT, _short_fold(data, pairs, vocabulary))
        folded = F.coalesce(whole, short.otherwise(_long_fold(data, ranks, vocabulary.buckets)))
        return F.when(F.char_length(data) == 0, F.array().cast("array<int>")).otherwise(folded)

    return _let(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), ids)


def words_of(text: Column, vocabulary: Vocabulary) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(vocabulary.pattern)), F.lit(0))


@dataclass(frozen=True)
class Cache:
    """Ids of frequent words: a text for each bucket, ``KEY word VALUE id,id,id`` for each word, and maps of the hot ones."""

    texts: list[str]
    hot: list[list[tuple[str, list[int]]]] = field(default_factory=lambda: [[]])

    def tables(self, spark: SparkSession) -> list[Column]:
        maps = pa.map_(pa.string(), pa.list_(pa.int32()))
        return [_shipped(spark, self.hot, maps), _shipped(spark, self.texts, pa.string())]

    def find(self, hot: Column, buckets: Column, word: Column) -> Column:
        """The word's ids; null if it isn't there."""
        entry = F.concat(F.lit(KEY), word, F.lit(VALUE))

        def value(text: Column) -> Column:
            after = F.call_function("substring_index", text, entry, F.lit(-1))
            ids = F.split(F.substring_index(after, KEY, 1), ",").cast("array<int>")
            return F.when(F.contains(text, entry) & ~F.contains(word, F.lit(VALUE)), ids)

        at = F.get(buckets, F.pmod(F.crc32(word), F.lit(len(self.texts))).cast("int"))
        return F.coalesce(F.get(hot, F.hash(word).bitwiseAND(F.lit(len(self.hot) - 1)))[word], _let(at, value))


def cached_words(docs: DataFrame, text_col: str, vocabulary: Vocabulary, most: int = MAX_CACHED) -> Cache:
    """The ids of the corpus' frequent words, ``most`` and ``MAX_CACHED_BYTES`` at most, so of bounded size.

    All words of the corpus are counted; the cut-off is the lowest count that no
    more words and bytes reach.
    """
    spark = docs.sparkSession
    counts = materialize(
        docs.select(F.explode(words_of(docs[text_col], vocabulary)).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & (F.octet_length("word") <= LONGEST_CACHED)),
        "bpe-counts",
    ).withColumn("n", F.least("n", F.lit(COUNT_LIMIT)))
    per_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"), F.sum(F.octet_length("word")).alias("bytes"))
    cut, hot_cut, total, size = COUNT_LIMIT + 1, COUNT_LIMIT + 1, 0, 0
    for row in per_count.orderBy(F.desc("n")).collect():  # COUNT_LIMIT rows at most
        if total + row["words"] > most or size + row["bytes"] > MAX_CACHED_BYTES:
            break
        cut, total, size = row["n"], total + row["words"], size + row["bytes"]
        if total <= HOT:
            hot_cut = cut
    n = max(1, total // PER_BUCKET)
    folded = materialize(
        with_tables(
            counts.filter((F.col("n") >= cut) & ~F.contains("word", F.lit(KEY)) & ~F.contains("word", F.lit(VALUE))),
            [vocabulary.ranks(spark), vocabulary.pairs(spark)],
            "ids",
            lambda ranks, pairs: fold(F.col("word"), vocabulary, ranks, pairs),
        ),
        "bpe-words",
    )
    found = (
        folded.select(
            F.pmod(F.crc32("word"), F.lit(n)).cast("int").alias("bucket"),
            F.concat(F.lit(KEY), "word", F.lit(VALUE), F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("entry"),
        )
        .groupBy("bucket")
        .agg(F.concat_ws("", F.collect_list("entry")).alias("text"))
    )
    texts = [""] * n
    for row in found.collect():  # one row a bucket, with `most` words in all
        texts[row["bucket"]] = row["text"]
    hot: list[list] = [[] for _ in range(1 << HOT.bit_length())]
    place = F.hash("word").bitwiseAND(F.lit(len(hot) - 1))
    for row in folded.filter(F.col("n") >= hot_cut).select(place.alias("place"), "word", "ids").collect():  # HOT rows at most
        hot[row["place"]].append((row["word"], row["ids"]))
    return Cache(texts, hot)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", most_cached: int = MAX_CACHED) -> DataFrame:
    """``docs`` plus ``ids`` (array<int>) of each whole text; a null text counts as empty and has no ids.

    Every row gives one, repeated ones too; an empty table gives none.  Columns
    of ``docs`` stay as they are, whatever their names, but for one named
    ``ids``: the result's takes its place.
    """
    spark = docs.sparkSession
    cache = cached_words(docs, text_col, vocabulary, most_cached)

    def ids(hot: Column, known: Column, ranks: Column, pairs: Column) -> Column:
        return F.flatten(
            F.transform(
                words_of(docs[text_col], vocabulary),
                lambda w: F.coalesce(cache.find(hot, known, w), fold(w, vocabulary, ranks, pairs)),
            )
        )

    return with_tables(docs, [*cache.tables(spark), vocabulary.ranks(spark), vocabulary.pairs(spark)], "ids", ids)


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The text's bytes (binary): the pieces of the ids, one after the other."""
    pieces = vocabulary.hex_pieces()
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))


def packed(ids: Column, vocabulary: Vocabulary) -> Column:
    """The ids as little-endian unsigned 32-bit integers (binary)."""
    numbers = vocabulary.hex_ids()
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(numbers, i)), ""))
