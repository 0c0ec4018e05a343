"""Token counts of whole texts through a digest cache.

A stored count belongs to a digest of the content and a digest of the tokenizer. A run joins the digests of its texts
to the stored counts, encodes one text for every digest that is missing, and appends what it counted to the cache; its
own counts are then read from the cache like all others. A run that is repeated encodes nothing.

The content is normalised to the bytes that the tokenizer sees: null becomes the empty text, nothing else changes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmgrid.session import written

CACHE = "content binary, tokenizer string, n_tokens long"
LIMIT = 4096


def tokenizer_version(model_file: str) -> str:
    """Digest of the model and of the library that applies it."""
    seen = hashlib.sha256(f"sentencepiece {sentencepiece.__version__}\n".encode())
    with open(model_file, "rb") as file:
        while block := file.read(1 << 20):
            seen.update(block)
    return seen.hexdigest()


@lru_cache(maxsize=4)
def _processor(model_file: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def _encoded(model_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _processor(model_file)
        for batch in batches:
            counts = [len(model.encode(text.as_py())) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    return run


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The cache at a path, made if there is none."""
    spark.createDataFrame([], CACHE).write.mode("ignore").parquet(path)
    return spark.read.schema(CACHE).parquet(path)


def count_tokens(docs: DataFrame, cache_path: str, model_file: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, a row per row of ``docs``.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and equal texts are encoded once. Null ids stay
    null. An empty table gives an empty result and adds nothing to the cache. Other columns are not looked at. Runs at
    the same time may both store a digest; equal entries count once.
    """
    spark = docs.sparkSession
    version = tokenizer_version(model_file)
    whole = F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(whole.cast("binary"), 256))
    # the null id needs a name too, since one row of every digest is chosen by its id
    name = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63)).cast("long"))
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(whole).cast("long").alias("n_bytes"), digest.alias("content"), name.alias("row"))
    # the digests are needed before and after the encoding; a short row each, so that texts are read for them once
    keyed = written(keyed, "token-digests")
    known = open_cache(spark, cache_path).where(F.col("tokenizer") == version).select("content")
    misses = keyed.groupBy("content").agg(F.min("row").alias("row")).join(known, "content", "left_anti")
    # rows that repeat in full are one before they are shuffled, and one when they are encoded
    texts = docs.groupBy(digest.alias("content"), name.alias("row")).agg(F.first(whole).alias("text"))
    texts = texts.join(misses, ["content", "row"], "left_semi")
    counted = texts.select("content", "text").mapInArrow(_encoded(model_file), "content binary, n_tokens long")
    stored = counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens")
    stored.write.mode("append").parquet(cache_path)

    counts = open_cache(spark, cache_path).where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    found = keyed.join(counts, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    # Spark takes reads of one folder for equal, so two results in one plan could share the listing of the earlier run
    return written(found, "token-counts")
