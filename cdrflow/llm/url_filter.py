"""URL rules, and exact list membership by a cascade of Bloom filters.

Level 1 encodes the listed keys.  Level 2 encodes the unlisted keys of the
corpus that level 1 takes for listed, level 3 the listed ones that level 2
takes for unlisted, and so on until no key is wrong.  As the levels are built
over all keys of the corpus, the answer for each of them is exact: the first
level that does not hold a key decides.  Pages are judged by looking at a few
bits of literal arrays, without a join or a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

#: Bytes of one level at most; a longer list is looked up by a semi join instead.
MAX_LEVEL_BYTES = 8 << 20
#: Share of wrong answers aimed at by the levels after the first.
LATER_RATE = 1 / 16
MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and a path prefix, as in ``example.org/es/``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]

    def fits(self) -> Column:
        at = (F.col("host") == self.host) | F.col("host").endswith(f".{self.host}")
        return at & F.col("path").startswith(self.path)


def with_host_path(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty for a null url or one without ``://``."""
    rest = F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")
    rest = F.when(F.instr(F.col(url_col), "://") > 0, rest).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(raw) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return df.withColumns({"host": ascii_lower(raw), "path": path})


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``rule`` (the longest that fits, else null) and ``rule_verdict``."""
    ordered = sorted(rules, key=lambda r: -len(r.text))
    if not ordered:
        none = F.lit(None).cast("string")
        return df.withColumns({"rule": none, "rule_verdict": none})
    return df.withColumns(
        {
            "rule": F.coalesce(*[F.when(r.fits(), F.lit(r.text)) for r in ordered]),
            "rule_verdict": F.coalesce(*[F.when(r.fits(), F.lit(r.verdict)) for r in ordered]),
        }
    )


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``words`` is a one-row frame with its bits as an array of longs."""

    number: int
    bits: int
    hashes: int
    words: DataFrame

    def positions(self, key: Column) -> list[Column]:
        return _positions(key, self.number, self.bits, self.hashes)

    def holds(self, key: Column) -> Column:
        words = self.words.scalar()
        found = F.lit(True)
        for p in self.positions(key):
            word = F.get(words, F.call_function("shiftright", p, F.lit(6)).cast("int"))
            bit = F.call_function("shiftright", word, F.pmod(p, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("long"))
            found = found & (bit == 1)
        return found


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    m = F.lit(bits).cast("long")
    one = F.pmod(F.xxhash64(key, F.lit(level)), m)
    two = F.pmod(F.xxhash64(F.lit(-level), key), m)
    return [F.pmod(one + two * j + F.lit(j * j), m) for j in range(hashes)]


def _size(n: int, rate: float) -> tuple[int, int]:
    bits = max(64, math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 64) * 64)
    return bits, max(1, round(-math.log2(rate)))


def _encode(keys: DataFrame, number: int, n: int, rate: float) -> Level:
    bits, hashes = _size(n, rate)
    spark = keys.sparkSession
    set_bits = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("p")).select(
        F.expr("shiftright(p, 6)").alias("w"), F.expr("shiftleft(1L, cast(pmod(p, 64) as int))").alias("b")
    )
    filled = (
        set_bits.union(spark.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b")))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
    )
    words = filled.agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("words"))
    return Level(number, bits, hashes, materialize(words, f"bloom-level{number}"))


def build_cascade(keys: DataFrame, max_level_bytes: int = MAX_LEVEL_BYTES) -> list[Level] | None:
    """Levels for ``keys`` (key, listed), one row per key, of a written table.

    None if the first level would exceed ``max_level_bytes``.  No listed key: no
    level.
    """
    n = keys.agg(F.count_if("listed").alias("yes"), F.count_if(~F.col("listed")).alias("no")).first()
    if not n["yes"]:
        return []
    rate = min(0.5, max(1e-4, n["yes"] / (math.sqrt(2) * max(1, n["no"]))))
    if _size(n["yes"], rate)[0] > 8 * max_level_bytes or _size(n["no"], LATER_RATE)[0] * rate * 2 > 8 * max_level_bytes:
        return None
    levels: list[Level] = []
    here, other = keys.filter("listed").select("key"), keys.filter("not listed").select("key")
    count = n["yes"]
    while count:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end")
        levels.append(_encode(here, len(levels) + 1, count, rate))
        wrong = materialize(other.filter(levels[-1].holds(F.col("key"))), "bloom-wrong")
        here, other, count, rate = wrong, here, wrong.count(), LATER_RATE
    return levels


def is_listed(levels: list[Level], key: Column) -> Column:
    """Exact for every key of the corpus the cascade was built over."""
    out = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        out = F.when(~level.holds(key), F.lit(level.number % 2 == 0)).otherwise(out)
    return out


#: Columns that ``judge_urls`` gives; of the same names in its input they take the place.
VERDICT_COLUMNS = ("host", "path", "rule", "verdict", "on_list")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], max_level_bytes: int = MAX_LEVEL_BYTES) -> DataFrame:
    """``pages`` (with ``url``) plus host, path, rule, verdict and on_list.

    ``listed`` has the blocked keys (``key``: host followed by path).  The
    longest fitting rule decides; without one, listed keys are blocked.  Null
    and malformed urls have the key '' and are judged like any other.  Listed
    keys that no page has are ignored: they can match nothing.  Every row gives
    one, repeated ones too; an empty table gives none.  Columns of ``pages``
    stay as they are, whatever their names, but for those of the result.
    """
    nested = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("page"), pages["url"].alias("url"))
    keyed = with_host_path(nested).withColumn("key", F.concat("host", "path"))
    keys = materialize(
        keyed.select("key", F.lit(False).alias("l"), F.lit(True).alias("here"))
        .union(listed.select("key", F.lit(True), F.lit(False)))
        .groupBy("key")
        .agg(F.max("l").alias("listed"), F.max("here").alias("here"))
        .filter("here")
        .select("key", "listed"),
        "url-keys",
    )
    levels = build_cascade(keys, max_level_bytes)
    if levels is None:
        hits = keys.filter("listed").select("key", F.lit(True).alias("hit"))
        keyed = keyed.join(hits, "key", "left").withColumn("on_list", F.coalesce("hit", F.lit(False)))
    else:
        keyed = keyed.withColumn("on_list", is_listed(levels, F.col("key")))
    by_list = F.when(F.col("on_list"), F.lit("block")).otherwise(F.lit("allow"))
    judged = apply_rules(keyed, rules).withColumn("verdict", F.coalesce("rule_verdict", by_list))
    own = [F.col("page")[c].alias(c) for c in pages.columns if c not in VERDICT_COLUMNS]
    return judged.select(*own, *VERDICT_COLUMNS)
