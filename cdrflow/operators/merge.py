"""Insert-if-absent merge on the de-duplication key.

The target store is append-only parquet, so ``MERGE ... WHEN NOT MATCHED THEN
INSERT`` becomes: find, on narrow rows (key and place), the keys that need a
decision, because they are repeated or already loaded; then let the wide rows
through, with those keys' losers taken out.

Skew: a key (or a file) may hold a large share of the rows.  The narrow rows
are aggregated by key, so hot keys collapse map-side before the shuffle.  Wide
rows are in no aggregate: they meet the keys that need a decision in one join,
which Spark makes a broadcast join when those are few (its run-time size says
so), and then they are not shuffled at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrflow.mapping import DUPLICATE_POLICIES

FILE_KEYS = ["SOURCE_DIR", "SOURCE_FILE"]


def existing_keys(key_table: DataFrame, key_column: str, key: str = "DEDUP_KEY") -> DataFrame:
    return key_table.select(F.col(key_column).alias(key)).where(F.col(key).isNotNull())


def merge_insert_absent(
    src: DataFrame,
    key_table: DataFrame,
    key: str = "DEDUP_KEY",
    key_table_column: str | None = None,
    on_duplicate: str = "keep_first",
    order_by: tuple[str, ...] = ("SOURCE_FILE",),
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``src`` to insert, and the files that fail (``fail_file``).

    ``src`` holds valid rows with ``key`` and the file keys.  ``order_by``
    tells the rows of a file apart and gives "first" inside it (the line
    number); across files the first is taken by (SOURCE_FILE, SOURCE_DIR,
    *order_by).

    * ``keep_first``: one row per key, keys present in ``key_table`` dropped.
    * ``fail_file``: a file fails when it holds a new key (one not in
      ``key_table`` at batch start) two or more times; none of its rows are
      inserted; the other files then keep the first row per key.
    """
    if on_duplicate not in DUPLICATE_POLICIES:
        raise ValueError(f"on_duplicate must be one of {DUPLICATE_POLICIES}")
    within = [F.col(c) for c in order_by if c not in FILE_KEYS]
    place = F.struct(F.col("SOURCE_FILE"), F.col("SOURCE_DIR"), *within)
    keys = existing_keys(key_table, key_table_column or key, key)
    spark = src.sparkSession

    live = src.where(F.col(key).isNotNull())

    def first_per_key(rows: DataFrame) -> DataFrame:
        per_key = rows.select(key, place.alias("_AT")).groupBy(key).agg(
            F.min("_AT").alias("_FIRST"), F.count(F.lit(1)).alias("_N")
        )
        loaded = keys.groupBy(key).agg(F.lit(True).alias("_LOADED"))
        # a loaded key has no first row, so no place equals it
        decided = (
            per_key.join(loaded, key, "left")
            .where(F.col("_LOADED").isNotNull() | (F.col("_N") > 1))
            .select(key, F.lit(True).alias("_DECIDED"), F.when(F.col("_LOADED").isNull(), F.col("_FIRST")).alias("_FIRST"))
        )
        out = rows.join(decided, key, "left").where(F.col("_DECIDED").isNull() | (place == F.col("_FIRST")))
        return out.select(*src.columns)

    if on_duplicate == "keep_first":
        failed = spark.createDataFrame([], "SOURCE_DIR string, SOURCE_FILE string")
        return first_per_key(live), failed

    # fail_file: the failing files come from a narrow (file, key) count
    counts = live.groupBy(*FILE_KEYS, key).agg(F.count(F.lit(1)).alias("_N")).where(F.col("_N") > 1)
    failed = counts.join(keys, key, "left_anti").select(*FILE_KEYS).distinct()
    surviving = live.join(failed, FILE_KEYS, "left_anti")
    return first_per_key(surviving), failed
