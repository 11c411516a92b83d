"""Staging -> detail transform: mapping compiler, reject flags, stats.

One projection computes every typed column, the de-duplication key and the
array of reject reasons; the valid / rejected split and the per-file stats all
derive from that single frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.functions import cleaning as C
from cdrflow.mapping import OCC_DEDUP_KEYS, OCC_MAPPING, TECHNICAL_COLUMNS, ColumnSpec, detail_schema

FILE_KEYS = ["SOURCE_DIR", "SOURCE_FILE"]

# Reject reason prefixes (fixed vocabulary of the reject report).
REQUIRED_BLANK = "REQUIRED_BLANK"
EMPTY_AFTER_CLEAN = "EMPTY_AFTER_CLEAN"
BAD_TIMESTAMP = "BAD_TIMESTAMP"
NO_DEDUP_KEY = "NO_DEDUP_KEY"


def _timestamp_spec(mapping) -> ColumnSpec | None:
    return next((s for s in mapping if s.kind == "timestamp"), None)


def _key_max_length(mapping, keys) -> int | None:
    first = next((s for s in mapping if keys and s.source == keys[0]), None)
    return first.max_length if first is not None else None


def source_text(spec: ColumnSpec) -> Column:
    """The source text that a number or timestamp entry converts, after the user's ``extra`` function."""
    src = F.col(spec.source)
    return spec.extra(src) if spec.extra is not None else src


def column_expr(spec: ColumnSpec, unit: str = "seconds") -> Column:
    """Typed detail value of one mapping entry."""
    src = F.col(spec.source)
    if spec.kind == "number":
        return C.safe_number(source_text(spec), spec.precision or 38, spec.scale or 0)
    if spec.kind == "timestamp":
        return C.epoch_to_ntz(C.apply_transform(source_text(spec), spec.transform), unit)
    if spec.kind == "string":
        return C.clean_string(src, spec)
    raise ValueError(f"unknown column type {spec.kind!r}")


def compile_mapping(mapping=OCC_MAPPING, unit: str = "seconds") -> list[Column]:
    """Mapping -> ordered select list of the detail columns.

    Entries without a target are skipped; START_HOUR and the trace column
    ORIG_START_TIME (trimmed source text) are appended.
    """
    if not mapping:
        raise NotImplementedError("no mapping defined for this feed: transform not implemented")
    cols: list[Column] = []
    targets: list[str] = []
    for spec in mapping:
        if spec.target is None:
            continue
        cols.append(column_expr(spec, unit).alias(spec.target))
        targets.append(spec.target)
    ts = _timestamp_spec(mapping)
    if ts is not None:
        cols.append(C.start_hour(column_expr(ts, unit)).alias("START_HOUR"))
        if "ORIG_START_TIME" not in targets:
            cols.append(C.blank_to_null(F.trim(F.col(ts.source))).alias("ORIG_START_TIME"))
    else:
        cols.append(F.lit(None).cast(T.IntegerType()).alias("START_HOUR"))
    return cols


def reject_reasons(mapping=OCC_MAPPING, dedup_keys=OCC_DEDUP_KEYS, unit: str = "seconds") -> Column:
    """Array of every reason a staging row is rejected (empty = valid).

    * required column blank (NULL / empty / blanks only);
    * required column emptied by its transform (e.g. a TAB-only number);
    * timestamp not digits only, not a bigint, or past year 9999;
    * no non-blank de-duplication key.
    """
    checks: list[Column] = []
    for spec in mapping:
        src = F.col(spec.source)
        if spec.required:
            checks.append(F.when(C.is_blank(src), F.lit(f"{REQUIRED_BLANK}:{spec.source}")))
            if spec.kind == "string" and spec.target is not None:
                checks.append(
                    F.when(
                        ~C.is_blank(src) & C.clean_string(src, spec).isNull(),
                        F.lit(f"{EMPTY_AFTER_CLEAN}:{spec.source}"),
                    )
                )
        if spec.kind == "timestamp":
            checks.append(F.when(~C.valid_epoch(source_text(spec), unit), F.lit(f"{BAD_TIMESTAMP}:{spec.source}")))
    if dedup_keys:
        checks.append(F.when(C.dedup_key(dedup_keys).isNull(), F.lit(NO_DEDUP_KEY)))
    return _non_null_array(checks)


def _non_null_array(items: list[Column]) -> Column:
    """Array of the non-NULL items, in order.

    Built as ``concat_ws`` + ``split`` (both code-generated) instead of a
    lambda ``filter``, which Spark evaluates row by row in interpreted mode.
    The items never contain the separator.
    """
    text = F.concat_ws("\u0001", *items)
    return F.when(text == "", F.array().cast(T.ArrayType(T.StringType()))).otherwise(F.split(text, "\u0001"))


def constraint_violations(mapping=OCC_MAPPING) -> Column:
    """Number columns whose value overflows the detail DECIMAL(p, s)."""
    checks = [
        F.when(C.overflows(source_text(s), s.precision or 38, s.scale or 0), F.lit(s.target))
        for s in mapping
        if s.kind == "number" and s.target is not None
    ]
    if not checks:
        return F.array().cast(T.ArrayType(T.StringType()))
    return _non_null_array(checks)


def flag(
    staging: DataFrame,
    mapping=OCC_MAPPING,
    dedup_keys=OCC_DEDUP_KEYS,
    unit: str = "seconds",
    keep: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """One pass over staging: technical + ``keep`` columns, DEDUP_KEY, typed
    detail columns, REJECT_REASONS and CONSTRAINT_VIOLATIONS."""
    passthrough = [c for c in TECHNICAL_COLUMNS if c in staging.columns]
    passthrough += [c for c in keep if c not in passthrough]
    key = C.dedup_key(dedup_keys, _key_max_length(mapping, dedup_keys)) if dedup_keys else F.lit(None)
    # Filters on the flags (valid / rejected split) must read the computed
    # column, not be pushed below this projection with every check inlined
    # (that evaluates each check twice per row).  A nondeterministic identity
    # on the reasons (spark_partition_id() >= 0 is always true) keeps them
    # above; it sits on the column those filters read, so pruning keeps it.
    # Filters on files belong before this step, where they prune partitions.
    reasons = F.when(F.spark_partition_id() >= 0, reject_reasons(mapping, dedup_keys, unit))
    return staging.select(
        *passthrough,
        key.cast(T.StringType()).alias("DEDUP_KEY"),
        *compile_mapping(mapping, unit),
        reasons.alias("REJECT_REASONS"),
        constraint_violations(mapping).alias("CONSTRAINT_VIOLATIONS"),
    )


def is_valid() -> Column:
    return F.size("REJECT_REASONS") == 0


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(is_valid())


def detail_projection(mapping=OCC_MAPPING, dedup_keys=OCC_DEDUP_KEYS) -> list[Column]:
    """Detail column list; the key column receives DEDUP_KEY."""
    from cdrflow.mapping import detail_columns

    key_col = dedup_keys[0] if dedup_keys else None
    out = []
    for c in detail_columns(mapping):
        out.append(F.col("DEDUP_KEY").alias(c) if c == key_col else F.col(c))
    return out


def transform(
    staging: DataFrame, mapping=OCC_MAPPING, dedup_keys=OCC_DEDUP_KEYS, unit: str = "seconds"
) -> DataFrame:
    """Valid rows only, as detail columns (no de-duplication)."""
    flagged = flag(staging, mapping, dedup_keys, unit)
    return valid_rows(flagged).select(*detail_projection(mapping, dedup_keys))


def rejects(flagged: DataFrame) -> DataFrame:
    """One row per rejected staging row, with all its reasons."""
    return flagged.where(~is_valid())


def reject_rows(flagged: DataFrame) -> DataFrame:
    """Rejected rows as a table to read: file, line and the reasons, ``; `` between them."""
    return rejects(flagged).select(*FILE_KEYS, "SOURCE_LINE", F.array_join("REJECT_REASONS", "; ").alias("REASONS"))


def reject_report(flagged: DataFrame) -> DataFrame:
    """Counts of rejected rows per file and reason (a row may count under
    several reasons)."""
    return (
        rejects(flagged)
        .select(*FILE_KEYS, F.explode_outer("REJECT_REASONS").alias("REASON"))
        .groupBy(*FILE_KEYS, "REASON")
        .agg(F.count(F.lit(1)).alias("REJECTED_ROWS"))
    )


def null_violations(typed: DataFrame, mapping=OCC_MAPPING) -> DataFrame:
    """Per file and NOT NULL detail column: rows whose typed value is NULL.

    ``typed`` has the detail columns and the file keys.  For valid rows of a
    plain mapping there are none; an ``extra`` function may empty a value.
    """
    needed = [f.name for f in detail_schema(mapping).fields if not f.nullable and f.name in typed.columns]
    counts = typed.groupBy(*FILE_KEYS).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in needed])
    return counts.unpivot(FILE_KEYS, needed, "COLUMN_NAME", "NULLS").where("NULLS > 0")


def check_constraints(flagged: DataFrame) -> DataFrame:
    """Per file and column: count of values that overflow the detail type."""
    return (
        flagged.where(F.size("CONSTRAINT_VIOLATIONS") > 0)
        .select(*FILE_KEYS, F.explode_outer("CONSTRAINT_VIOLATIONS").alias("COLUMN_NAME"))
        .groupBy(*FILE_KEYS, "COLUMN_NAME")
        .agg(F.count(F.lit(1)).alias("VIOLATIONS"))
    )


def file_counts(flagged: DataFrame) -> DataFrame:
    """tmpRows / valid / rejected per file (partial aggregation map-side)."""
    return flagged.groupBy(*FILE_KEYS).agg(
        F.count(F.lit(1)).alias("TMP_ROWS"),
        F.count_if(is_valid()).alias("VALID_ROWS"),
        F.count_if(~is_valid()).alias("REJECTED_ROWS"),
        F.count_if(F.size("CONSTRAINT_VIOLATIONS") > 0).alias("OVERFLOW_ROWS"),
    )


def transform_stats(flagged: DataFrame, inserted: DataFrame, failed_files: DataFrame | None = None) -> DataFrame:
    """Per file: TMP_ROWS, VALID_ROWS, INSERTED, DUPLICATES, REJECTED_ROWS, FAILED.

    ``inserted`` holds the rows actually written (one per key).  For a file
    that did not fail, TMP_ROWS = INSERTED + DUPLICATES + REJECTED_ROWS.
    """
    counts = file_counts(flagged)
    ins = inserted.groupBy(*FILE_KEYS).agg(F.count(F.lit(1)).alias("INSERTED"))
    out = counts.join(ins, FILE_KEYS, "left")
    if failed_files is not None:
        out = out.join(failed_files.select(*FILE_KEYS).withColumn("_F", F.lit(True)), FILE_KEYS, "left")
        failed = F.coalesce(F.col("_F"), F.lit(False))
    else:
        failed = F.lit(False)
    inserted_n = F.when(failed, F.lit(0)).otherwise(F.coalesce(F.col("INSERTED"), F.lit(0))).cast("bigint")
    return out.select(
        *FILE_KEYS,
        "TMP_ROWS",
        "VALID_ROWS",
        inserted_n.alias("INSERTED"),
        F.when(failed, F.lit(0)).otherwise(F.col("VALID_ROWS") - inserted_n).cast("bigint").alias("DUPLICATES"),
        "REJECTED_ROWS",
        failed.alias("FAILED"),
    )
