"""Exact duplicates by a 128-bit content hash, with the bytes compared inside each group.

Plan: one aggregate by (hash, text), whose grouping keys are compared byte by
byte, finds the hashes that different texts share: hardly ever any.  One scan
writes a narrow table (row id, doc id, 128-bit hash, SHA-256 for the report) to
the shared folder, with the text itself beside it for a shared hash only, so
such a group is split by its distinct texts.  The classes are a partial
aggregate of that table, so a group of copies that holds a third of all rows
collapses before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize


def normalise(text: Column) -> Column:
    """Null counts as empty; only A-Z are lower-cased."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per input row: id, keep id, group size, kept, text hash and row id.

    ``keep`` names which id of a group stays ("smallest" or "largest").  A null
    id stays only when the whole group has none.  When rows repeat both id and
    text, exactly one of them is kept (the first by row id).  An empty table
    gives an empty result; other columns of the input are not read, so their
    names cannot clash.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    norm = normalise(F.col(text_col))
    content = F.unhex(F.md5(norm))
    texts = docs.select(content.alias("content"), norm.alias("norm")).groupBy("content", "norm").count()
    shared = materialize(
        texts.groupBy("content").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("content"), "exact-shared"
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("doc_id"),
        content.alias("content"),
        F.sha2(norm, 256).alias("text_sha256"),
        norm.alias("norm"),
    )
    if shared.isEmpty():
        rows = rows.withColumn("part", F.lit(""))
    else:
        split = rows.join(shared.withColumn("split", F.lit(True)), "content", "left")
        rows = split.withColumn("part", F.when(F.col("split"), F.col("norm")).otherwise(F.lit("")))
    rows = materialize(rows.select("row_id", "doc_id", "content", "text_sha256", "part"), "exact-rows")
    if keep == "largest":
        best = F.max(F.struct("doc_id", (-F.col("row_id")).alias("r")))
    else:
        best = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", F.col("row_id").alias("r")))
    classes = rows.groupBy("content", "part").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    named = classes.select(
        F.hex("content").alias("content_hex"), "part", F.col("best.doc_id").alias("keep_id"), F.abs("best.r").alias("keep_row"), "group_size"
    )
    # joined on a derived key, so both sides are exchanged and a hot group can be split by AQE
    return (
        rows.withColumn("content_hex", F.hex("content"))
        .join(named, ["content_hex", "part"])
        .select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), "text_sha256", "row_id")
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` without its exact copies, all columns as they were.

    The rows are numbered once and written, so the row id that the decision
    names is the row that stays, whatever the scan does on a second read.
    """
    numbered = materialize(
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("nr")),
        "exact-docs",
    )
    flat = numbered.select("nr", F.col("doc")[id_col].alias("doc_id"), F.col("doc")[text_col].alias("text"))
    # the id together with the row's number is unique; a null id comes last in either order
    first = [F.col("doc_id").isNull().alias("none")] if keep == "smallest" else []
    unique = F.struct(*first, F.col("doc_id").alias("id"), F.col("nr").alias("nr")).alias("doc_id")
    verdict = exact_duplicates(flat.select(unique, "text"), keep=keep)
    kept = verdict.filter("kept").select(F.col("doc_id.nr").alias("nr"))
    return numbered.join(kept, "nr", "left_semi").select("doc.*")
