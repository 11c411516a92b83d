"""Quality rules whose thresholds adapt to each language and source.

Every document gets whole-text counts (words, characters, symbols, repeated
lines, repeated 5-word windows).  A base rule rejects hopeless documents.  For
the others, three rates are summarised per (language, source) by a mergeable
quantile sketch: a log-linear histogram (exact below 128, then 7 significant
bits, so within 1/64 of the value), whose merge is the sum of its counts.
Repeated windows have no fence: the base rule is about them already.  The
sketches of small groups are replaced by the merged sketch of their language,
or of the whole corpus.  Fences around the quartiles are then joined back; where
one side of a group is far wider than the other, as with much junk, its fences
are held to those of most groups.

All of it is built-in SQL functions; nothing leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, materialize, other_columns

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Fence:
    """Accepted: from q25 - reach * spread (if ``lower``) to q75 + reach * spread.

    ``spread`` is the interquartile range, ``floor`` at least; in thousandths
    of the rate, so all arithmetic is on integers.  Texts of fewer than
    ``min_words`` words have no such rate: it would be mostly noise.
    """

    count: str
    floor: int
    reach: int = 6
    lower: bool = False
    min_words: int = 0

    @property
    def rate(self) -> Column:
        return F.expr(f"if(n_words >= {max(1, self.min_words)}, 1000 * {self.count} div n_words, null)")


#: Rates are 1000 * count div n_words.
FENCES = {
    "word_length": Fence("word_chars", floor=500, lower=True, min_words=50),
    "symbol_rate": Fence("n_symbols", floor=20),
    "dup_line_rate": Fence("n_dup_lines", floor=15),
}
#: A group's own sketch needs so many documents; below, the merged one is used.
MIN_GROUP = 200


def _without_symbols(text: Column) -> Column:
    """Each symbol is one byte, and searching for it is faster than mapping every character."""
    for s in SYMBOLS:
        text = F.replace(text, F.lit(s), F.lit(""))
    return text


def with_counts(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus the whole-text counts of ``COUNTS`` (long).

    A null text has no words, lines or symbols.  Every row gives one, repeated
    ones too; an empty table gives none.  Columns of the names in ``COUNTS`` are
    replaced.
    """
    keep = other_columns(df.columns if keep is None else keep, COUNTS)
    base = df.select(F.struct(*[df[c] for c in keep]).alias("row"), F.coalesce(df[text_col], F.lit("")).alias("t"))
    words = base.select(
        "row",
        F.expr(rf"filter(split(t, '{SPACE_CLASS}+'), w -> w <> '')".replace("\\", "\\\\")).alias("words"),
        (F.octet_length("t") - F.octet_length(_without_symbols(F.col("t")))).cast("long").alias("n_symbols"),
        F.expr(rf"filter(split(t, '\n'), l -> l rlike '[^\x20\x09-\x0D]')".replace("\\", "\\\\")).alias("lines"),
    )
    hashed = words.select(
        "row",
        "n_symbols",
        F.expr("aggregate(words, 0L, (a, w) -> a + char_length(w))").alias("word_chars"),
        F.size("words").alias("n"),
        F.expr("size(lines) - size(array_distinct(lines))").cast("long").alias("n_dup_lines"),
        F.expr("transform(words, w -> xxhash64(w))").alias("wh"),
    )
    windows = hashed.select(
        "row",
        "n_symbols",
        "word_chars",
        "n",
        "n_dup_lines",
        F.expr(
            "if(n < 5, cast(array() as array<bigint>),"
            " transform(sequence(0, n - 5), i -> xxhash64(wh[i], wh[i + 1], wh[i + 2], wh[i + 3], wh[i + 4])))"
        ).alias("wins"),
    )
    # sorted (hash, position) pairs put equal windows side by side; texts without a repeat skip the sort
    ranked = windows.select(
        "row",
        "n_symbols",
        "word_chars",
        "n",
        "n_dup_lines",
        F.expr(
            "if(size(array_distinct(wins)) = size(wins), null,"
            " sort_array(transform(wins, (h, i) -> named_struct('h', h, 'p', i))))"
        ).alias("s"),
    )
    repeated = ranked.select(
        "row",
        "n_symbols",
        "word_chars",
        "n",
        "n_dup_lines",
        F.expr(
            "if(s is null, cast(array() as array<int>), sort_array(transform("
            "filter(sequence(0, size(s) - 1), k ->"
            " (k > 0 and s[k].h = s[greatest(k - 1, 0)].h)"
            " or (k < size(s) - 1 and s[k].h = s[least(k + 1, size(s) - 1)].h)),"
            " k -> s[k].p)))"
        ).alias("at"),
    )
    # a window adds the words that the one before it did not cover
    return repeated.select(
        "row.*",
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.expr(
            "aggregate(at, named_struct('last', -5, 'total', 0L),"
            " (a, p) -> named_struct('last', p, 'total', a.total + least(5, p - a.last)), a -> a.total)"
        ).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def sketch(featured: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, metric, bin, n): the quantile sketch of each rate, as mergeable counts."""
    rates = featured.filter(~base_failed()).select(
        *groups,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), f.rate.alias("v"))
                    for m, f in FENCES.items()
                ]
            )
        ).alias("r"),
    ).filter("r.v is not null")
    shift = F.expr("greatest(length(bin(r.v)) - 7, 0)")
    return (
        rates.select(*groups, "r.metric", F.expr("r.v").alias("v"), shift.alias("s"))
        .select(*groups, "metric", F.expr("shiftleft(shiftright(v, s), s)").alias("bin"))
        .groupBy(*groups, "metric", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _quartiles(counts: DataFrame, groups: list[str]) -> DataFrame:
    """n, q25, q50 and q75 of each group and metric; a group has at most some thousand bins."""
    from pyspark.sql import Window

    w = Window.partitionBy(*groups, "metric")
    return (
        counts.withColumn("upto", F.sum("n").over(w.orderBy("bin")))
        .withColumn("total", F.sum("n").over(w))
        .groupBy(*groups, "metric")
        .agg(
            F.max("total").alias("n"),
            F.min(F.expr("if(4 * upto >= total, bin, null)")).alias("q25"),
            F.min(F.expr("if(2 * upto >= total, bin, null)")).alias("q50"),
            F.min(F.expr("if(4 * upto >= 3 * total, bin, null)")).alias("q75"),
        )
    )


def thresholds(counts: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per (lang, source): ``low_<metric>`` and ``high_<metric>``, in thousandths.

    A fence may lie beyond the one that the narrower side of the median gives
    (as for a symmetric distribution), but then not beyond the median of all
    groups' own fences, one vote for each (lang, source).  So up to half of a
    group can be junk without its fence giving way, while most groups are clean.
    """
    merged = counts.groupBy("lang", "metric", "bin").agg(F.sum("n").alias("n"))
    whole = merged.groupBy("metric", "bin").agg(F.sum("n").alias("n"))
    quartiles = F.struct("n", "q25", "q50", "q75")
    own = materialize(_quartiles(counts, ["lang", "source"]), "quality-quartiles")
    by_lang = _quartiles(merged, ["lang"]).select(
        F.col("lang").alias("l"), F.col("metric").alias("m"), quartiles.alias("of_lang")
    )
    of_all = _quartiles(whole, []).select(F.col("metric").alias("am"), quartiles.alias("of_all"))
    # of an even number of groups, the stricter of the two in the middle
    middle = "cast(percentile_disc(0.5) within group (order by {}) as bigint)"
    peers = (
        _fences(own)
        .groupBy(F.col("metric").alias("pm"))
        .agg(F.expr(middle.format("low desc")).alias("peer_low"), F.expr(middle.format("high")).alias("peer_high"))
    )
    used = (
        own.join(by_lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("metric") == F.col("m")))
        .join(of_all, F.col("metric") == F.col("am"))
        .join(peers, F.col("metric") == F.col("pm"))
        .select(
            "lang",
            "source",
            "metric",
            F.when(F.col("n") >= min_group, quartiles)
            .when(F.col("of_lang.n") >= min_group, F.col("of_lang"))
            .otherwise(F.col("of_all"))
            .alias("q"),
            "peer_low",
            "peer_high",
        )
        .select("lang", "source", "metric", "q.q25", "q.q50", "q.q75", "peer_low", "peer_high")
    )
    bounded = _fences(used).select(
        "lang",
        "source",
        "metric",
        F.expr("greatest(low, least(inner_low, peer_low))").alias("low"),
        F.expr("least(high, greatest(inner_high, peer_high))").alias("high"),
    )
    out = []
    for m, f in FENCES.items():
        low = "low" if f.lower else "cast(-1 as bigint)"
        out += [
            F.max(F.expr(f"if(metric = '{m}', {low}, null)")).alias(f"low_{m}"),
            F.max(F.expr(f"if(metric = '{m}', high, null)")).alias(f"high_{m}"),
        ]
    return bounded.groupBy("lang", "source").agg(*out)


def _fences(quartiles: DataFrame) -> DataFrame:
    """``quartiles`` plus the fences around them, and the ones that the narrower side of the median gives."""
    floor = "case metric " + " ".join(f"when '{m}' then {f.floor}" for m, f in FENCES.items()) + " end"
    reach = "case metric " + " ".join(f"when '{m}' then {f.reach}" for m, f in FENCES.items()) + " end"
    spread = f"({reach}) * greatest(q75 - q25, {floor})"
    # q75 + reach * spread, if the other side were as wide as the narrower one
    inner = f"(2 * ({reach}) + 1) * greatest(2 * least(q50 - q25, q75 - q50), {floor}) div 2"
    return quartiles.select(
        "*",
        F.expr(f"q25 - {spread}").alias("low"),
        F.expr(f"q75 + {spread}").alias("high"),
        F.expr(f"q50 - {inner}").alias("inner_low"),
        F.expr(f"q50 + {inner}").alias("inner_high"),
    )


#: Columns that ``judge`` gives.
VERDICT_COLUMNS = ("base_failed", "failed", "kept")


def judge(featured: DataFrame, lang_col: str = "lang", source_col: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """``featured`` plus ``base_failed``, ``kept`` and ``failed`` (the first fence a document breaks).

    ``featured`` must be stable on a second read (a written table): the fences
    come from it and are joined back to it.  Null language or source is a
    group of its own.  Every row gives one, repeated ones too (each counts in
    its group's sketch); an empty table gives none.  A rate on a fence is kept.
    Columns of ``featured`` stay as they are, whatever their names, but for
    those three: the result's take their place.
    """
    groups = featured.select(
        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), *COUNTS
    )
    limits = materialize(thresholds(sketch(groups, ["lang", "source"]), min_group), "quality-limits").select(
        F.col("lang").alias("lim_lang"), F.col("source").alias("lim_source"), F.struct("*").alias("lim")
    )
    broken = F.coalesce(
        *[
            F.when(
                (f.rate < F.col(f"lim.low_{m}")) | (f.rate > F.col(f"lim.high_{m}")), F.lit(m)
            )
            for m, f in FENCES.items()
        ]
    )
    own = other_columns(featured.columns, VERDICT_COLUMNS)
    rows = featured.select(
        F.struct(*[featured[c] for c in own]).alias("row"),
        featured[lang_col].alias("of_lang"),
        featured[source_col].alias("of_source"),
        *[featured[c] for c in COUNTS],
    )
    failed = F.when(base_failed(), F.lit("base")).otherwise(broken)
    # the limits are a written table: broadcast below the session's size threshold, else a join AQE can split
    return rows.join(
        limits,
        F.col("of_lang").eqNullSafe(F.col("lim_lang")) & F.col("of_source").eqNullSafe(F.col("lim_source")),
        "left",
    ).select(
        *[F.col("row")[c].alias(c) for c in own],
        base_failed().alias("base_failed"),
        failed.alias("failed"),
        failed.isNull().alias("kept"),
    )
