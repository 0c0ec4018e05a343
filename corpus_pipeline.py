"""A corpus from raw documents to packed sequences, in stages that each take all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrid.llm import decontamination, host_quality, line_dedup, packing, simhash
from filmgrid.llm.common import table, words
from filmgrid.session import fresh_path, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's verdict keep. Rows that repeat an id are judged each by its own text and host.

    Null and empty texts have no words and go; rows without an id are judged like others; an empty table gives an empty one.
    """
    verdicts = host_quality.judge_documents(_told_apart(docs, "source"))
    return _where(docs, verdicts.where("kept"), "left_semi", "source")


def line_dedup_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; the number of characters follows the text.

    The documents come into the index in two batches. Rows without an id count as documents after all others. One of
    which no text is left is a copy and goes. Null and empty texts stay as empty ones; an empty table gives an empty one.
    """
    index = line_dedup.LineIndex(spark, fresh_path(spark, "pipeline-lines"))
    named = docs.select(_name().alias("doc_id"), "text")
    late = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    index.insert(named.where(~late))
    index.insert(named.where(late))
    kept_as = "_real"
    while kept_as in docs.columns:
        kept_as += "_"
    real = F.struct("doc_id", _blank().alias("blank")).alias(kept_as)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "doc_id"]
    cleaned = index.clean(docs.select(_name().alias("doc_id"), real, *others), counts=False)
    cleaned = cleaned.where(F.col(f"{kept_as}.doc_id").isNotNull() | F.col(f"{kept_as}.blank") | ~_blank())
    cleaned = cleaned.select(*[F.col(f"{kept_as}.doc_id") if c == "doc_id" else F.col(f"`{c}`") for c in docs.columns])
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies, before any without an id.

    Of rows that repeat an id with unlike texts each is a document; the smaller digest comes first. Of rows equal in id
    and text the one with the smallest other columns stays.
    """
    classes = simhash.near_duplicates(_told_apart(docs)).where("doc_id = component_id").select("doc_id").distinct()
    kept = _where(docs, classes, "left_semi")
    rows = kept.select(F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"), _row_name().alias("name"))
    return rows.groupBy("name").agg(F.min("row").alias("row")).select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; an empty table on either side takes nothing away."""
    found = decontamination.contaminated(_told_apart(docs), table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return _where(docs, found, "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of all that is left, rows without an id included; null and empty texts are a piece of one token."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _blank() -> Column:
    return F.size(words(F.col("text"))) == 0


def _name() -> Column:
    """The id; without one, a number above all ids that follows from the text, so that such rows are judged by their texts."""
    unnamed = F.lit(2**62).cast("long") + F.shiftrightunsigned(F.xxhash64("text"), 2)
    return F.coalesce(F.col("doc_id").cast("long"), unnamed)


def _row_name(*others: str) -> Column:
    """The id with a digest of the text, and other columns that decide: an id may repeat with unlike texts. Null and empty texts differ."""
    digest = F.coalesce(F.unhex(F.md5("text")), F.lit(b""))
    return F.struct(_name().alias("id"), digest.alias("digest"), *others)


def _told_apart(docs: DataFrame, *others: str) -> DataFrame:
    return docs.select(_row_name(*others).alias("doc_id"), "text", *others)


def _where(docs: DataFrame, names: DataFrame, how: str, *others: str) -> DataFrame:
    """The rows whose name is (``left_semi``) or is not (``left_anti``) among the names, with their columns as they are."""
    return docs.join(names.select(F.col("doc_id").alias("found")).alias("names"), _row_name(*others) == F.col("names.found"), how)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup_),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: fingerprints, tiles and tokens have no SQL; the tests compare with a brute-force version
ORACLE_SQL = None
