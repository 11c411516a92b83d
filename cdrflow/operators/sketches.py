"""Column statistics that merge: a distinct-count and a quantile sketch per day and column.

One aggregate over a day's rows gives a small row per column; any window's
statistics come from merging those rows, without reading the detail again.
Distinct counts are HyperLogLog estimates (2^14 registers: a standard error of
0.8 %), quantiles come from KLL sketches (k = 400: a rank error under 1 %).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_REGISTERS, KLL_K = 14, 400
#: What an estimate may be off: three standard errors (and one) of a distinct count, and so much of a rank.
DISTINCT_BOUND, RANK_BOUND = 0.025, 0.03


def daily_sketches(detail: DataFrame, columns: list[str], day: str = "START_DATE") -> DataFrame:
    """(DAY, COLUMN_NAME, ROW_COUNT, NULL_COUNT, DISTINCT_SKETCH, QUANTILE_SKETCH) in one pass over the rows.

    Text columns have no quantile sketch.  Rows without a date are the day NULL.
    """
    numeric = {f.name for f in detail.schema.fields if isinstance(f.dataType, T.NumericType)}
    sketched = []
    for c in columns:
        quantiles = F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(KLL_K)) if c in numeric else F.lit(None).cast("binary")
        sketched += [
            F.count_if(F.col(c).isNull()).alias(f"n_{c}"),
            F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LOG_REGISTERS)).alias(f"d_{c}"),
            quantiles.alias(f"q_{c}"),
        ]
    days = detail.groupBy(F.col(day).cast("date").alias("DAY")).agg(F.count(F.lit(1)).alias("ROW_COUNT"), *sketched)
    each = F.array(*[
        F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(f"n_{c}").alias("NULL_COUNT"), F.col(f"d_{c}").alias("DISTINCT_SKETCH"),
                 F.col(f"q_{c}").alias("QUANTILE_SKETCH")) for c in columns
    ])
    return days.select("DAY", "ROW_COUNT", F.explode(each).alias("c")).select("DAY", "c.COLUMN_NAME", "ROW_COUNT", "c.NULL_COUNT",
                                                                               "c.DISTINCT_SKETCH", "c.QUANTILE_SKETCH")


def window_statistics(sketches: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """(COLUMN_NAME, ROW_COUNT, NULL_COUNT, DISTINCT_ESTIMATE, MEDIAN_ESTIMATE, P95_ESTIMATE) of the days from first to last."""
    days = sketches.where(F.col("DAY").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    merged = days.groupBy("COLUMN_NAME").agg(
        F.sum("ROW_COUNT").alias("ROW_COUNT"),
        F.sum("NULL_COUNT").alias("NULL_COUNT"),
        F.hll_sketch_estimate(F.hll_union_agg("DISTINCT_SKETCH")).alias("DISTINCT_ESTIMATE"),
        F.kll_merge_agg_double("QUANTILE_SKETCH").alias("Q"),
        F.count("QUANTILE_SKETCH").alias("HAS_Q"),
    )
    held = F.when((F.col("HAS_Q") > 0) & (F.col("ROW_COUNT") > F.col("NULL_COUNT")), F.col("Q"))
    return merged.select(
        "COLUMN_NAME", "ROW_COUNT", "NULL_COUNT", "DISTINCT_ESTIMATE",
        F.kll_sketch_get_quantile_double(held, F.lit(0.5)).alias("MEDIAN_ESTIMATE"),
        F.kll_sketch_get_quantile_double(held, F.lit(0.95)).alias("P95_ESTIMATE"),
    )


def checked_statistics(detail: DataFrame, statistics: DataFrame, columns: list[str], first_day: str, last_day: str,
                       day: str = "START_DATE") -> DataFrame:
    """Exact counts of the window beside the estimates, and whether these keep their bounds.

    DISTINCT_OK: off by DISTINCT_BOUND of the exact count, or one, at most.
    MEDIAN_OK, P95_OK (NULL for text): the share of values below the estimate
    and that up to it enclose the rank, give or take RANK_BOUND.
    """
    numeric = {f.name for f in detail.schema.fields if isinstance(f.dataType, T.NumericType)}
    rows = detail.where(F.col(day).cast("date").between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date")))
    wide = [F.struct(F.lit(c).alias("COLUMN_NAME"), F.col(c).cast("string").alias("S"),
                     (F.col(c) if c in numeric else F.lit(None)).cast("double").alias("V")) for c in columns]
    values = rows.select(F.explode(F.array(*wide)).alias("c")).select("c.*")
    ranked = values.join(F.broadcast(statistics.select("COLUMN_NAME", "MEDIAN_ESTIMATE", "P95_ESTIMATE")), "COLUMN_NAME")  # a row per column
    exact = ranked.groupBy("COLUMN_NAME").agg(
        F.count_distinct("S").alias("DISTINCT_EXACT"),
        *[F.avg((F.col("V") < F.col(f"{q}_ESTIMATE")).cast("double")).alias(f"{q}_LOW") for q in ("MEDIAN", "P95")],
        *[F.avg((F.col("V") <= F.col(f"{q}_ESTIMATE")).cast("double")).alias(f"{q}_HIGH") for q in ("MEDIAN", "P95")],
    )

    def encloses(q: str, rank: float):
        return (F.col(f"{q}_LOW") <= rank + RANK_BOUND) & (F.col(f"{q}_HIGH") >= rank - RANK_BOUND)

    off = F.abs(F.col("DISTINCT_ESTIMATE") - F.col("DISTINCT_EXACT"))
    return statistics.join(exact, "COLUMN_NAME").select(
        "COLUMN_NAME", "ROW_COUNT", "NULL_COUNT", "DISTINCT_EXACT",
        (off <= F.greatest(F.lit(1.0), DISTINCT_BOUND * F.col("DISTINCT_EXACT"))).alias("DISTINCT_OK"),
        encloses("MEDIAN", 0.5).alias("MEDIAN_OK"),
        encloses("P95", 0.95).alias("P95_OK"),
    )
