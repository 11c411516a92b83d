"""The corpus pipeline: quality rules, language, exact and near duplicates, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's ``docs``.  All stages but the last return the columns of
``documents``, whatever they are, and work on all that the one before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdrflow.llm import exact_dedup, language, packing, quality, simhash
from cdrflow.llm.common import materialize, table


def _nested(docs: DataFrame) -> DataFrame:
    """The row as one column, so that no column of ``docs`` can clash with one that a stage adds."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break the base rule or a fence of their language and source go."""
    rows = _nested(docs).select("doc", *[F.col("doc")[c].alias(c) for c in ("text", "lang", "source")])
    counts = materialize(quality.with_counts(rows, keep=["doc", "lang", "source"]), "quality-docs")
    return quality.judge(counts).filter("kept").select("doc.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or too much like two languages, go; the model is fitted on their labels."""
    model = language.fit(docs.select("doc_id", "text", "lang"))
    rows = _nested(docs).select("doc", F.col("doc")["text"].alias("text"))
    return language.identify(rows, model).filter("not rejected").select("doc.*")


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in either case), the one with the smallest id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by near-equal SimHash fingerprints, the one with the smallest id stays."""
    return simhash.drop_near_duplicates(docs, words=4, tau=4)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: a row per piece of a document."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)
    return packing.with_checksums(pieces)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("packing", pack),
]

#: Compression, SimHash components and online packing have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
