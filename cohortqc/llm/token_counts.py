"""Token counts with a digest cache: texts meet stored counts by digest, only distinct misses are encoded, and their
counts are appended to the cache.

The key is the SHA-256 of the content and the SHA-256 of the tokenizer file with the library's version, so a changed
tokenizer never reads old counts. Normalised content is the text with null as empty, in UTF-8, and nothing more: any
further folding could change its tokens. Copies of a text are combined on the map side and encoded once.

The cache is a plain Parquet table; appending is a write of new rows, and a row that two runs both append is the same
row (reads take one per key). A run that dies before its append leaves the cache as it was. Where counts are stored, digests
alone meet them first, and only the texts of digests they lack are shuffled. The registered query keeps its cache in one
folder below ``spark.checkpoint.dir``, so a second run encodes nothing.

Defined results: a null text counts as empty (0 tokens). Repeated rows each get their count. An empty table gives an
empty result and appends nothing.
"""
from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortqc.llm.common import whole
from cohortqc.session import path_exists

LIMIT = 4096
TEXTS_AT_ONCE = 64
CACHE = "content binary, tokenizer binary, n_tokens long"


def tokenizer_digest(path: str) -> bytes:
    """Version of a tokenizer: its file and the library that reads it."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as file:
        content = file.read()
    name = f"{library.__name__} {library.__version__} {os.path.splitext(path)[1]}"
    return hashlib.sha256(name.encode() + b"\0" + content).digest()


_COUNTERS: dict[str, object] = {}


def _counter(path: str):
    """Counts of a list of texts; a worker keeps its tokenizer from task to task."""
    if path not in _COUNTERS:
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _COUNTERS[path] = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.no_truncation(), model.no_padding()
            _COUNTERS[path] = lambda texts: [
                len(e.ids) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
    return _COUNTERS[path]


def _encode(path: str):
    def run(batches):
        count = _counter(path)
        for batch in batches:
            texts, found = batch.column("text").to_pylist(), []
            for low in range(0, len(texts), TEXTS_AT_ONCE):
                found += count(texts[low:low + TEXTS_AT_ONCE])
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(found, pa.int64())],
                                             names=["content", "n_tokens"])
    return run


def cached_counts(spark: SparkSession, cache: str, version: bytes) -> DataFrame:
    """content, n_tokens: what the cache holds for one tokenizer version."""
    if not path_exists(spark, cache):
        return spark.createDataFrame([], CACHE).select("content", "n_tokens")
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == F.lit(version))
    return stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_misses(spark: SparkSession, docs: DataFrame, path: str, cache: str) -> None:
    """Encodes every distinct text the cache lacks and appends the counts."""
    version = tokenizer_digest(path)
    text = whole("text")
    keyed = docs.select(F.unhex(F.sha2(text, 256)).alias("content"), text.alias("text"))
    if path_exists(spark, cache):
        lacking = keyed.select("content").distinct().join(cached_counts(spark, cache, version), "content", "left_anti")
        keyed = keyed.join(lacking, "content", "left_semi")
    distinct = keyed.groupBy("content").agg(F.first("text").alias("text"))
    counted = distinct.mapInArrow(_encode(path), "content binary, n_tokens long")
    counted.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)


def token_counts(spark: SparkSession, docs: DataFrame, path: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row for each row of ``docs``."""
    count_misses(spark, docs, path, cache)
    text = whole("text")
    keyed = docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"),
                        F.unhex(F.sha2(text, 256)).alias("content"))
    known = cached_counts(spark, cache, tokenizer_digest(path))
    return keyed.join(known, "content").select("doc_id", "n_bytes", "n_tokens",
                                               (F.col("n_tokens") > limit).alias("over_limit"))
