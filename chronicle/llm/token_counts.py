"""Token counts that are computed once per distinct content and kept in a cache."""

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronicle.llm.pieces import MARK, counter, read_model
from chronicle.shared import staged

CACHE = "digest binary, tokenizer string, n_tokens long"


def tokenizer_digest(model: bytes) -> str:
    """Names the tokenizer's version: another model file never shares counts."""
    return hashlib.sha256(model).hexdigest()


def _normal(text):
    """Content up to what the tokenizer itself treats alike: null as empty, marks as blanks."""
    return F.translate(F.coalesce(text, F.lit("")), MARK, " ")


def read_cache(spark, path: str, tokenizer: str) -> DataFrame:
    """``digest`` and ``n_tokens`` of one tokenizer, each digest once, however often it was appended.

    A tokenizer has a folder of its own in the cache, so counts of others are not read.
    """
    rows = spark.read.schema(CACHE).parquet(path).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _create(spark, path: str) -> None:
    """An empty cache where there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([], CACHE).write.mode("append").partitionBy("tokenizer").parquet(path)


def count_tokens(docs: DataFrame, model_path: str, cache_path: str) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row of ``docs`` (``doc_id``, ``text``).

    Counts are looked up in the cache by the digests of content and tokenizer.
    Of the content that is missing one row each is encoded, and its count is
    appended to the cache; two jobs that append the same digest do no harm.
    A cache that does not exist is created. Null texts count as empty ones,
    which have no tokens; rows may repeat, and ``doc_id`` may be null.
    """
    spark = docs.sparkSession
    model = read_model(model_path)
    version = tokenizer_digest(model)
    _create(spark, cache_path)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.unhex(F.sha2(_normal(F.col("text")), 256))
    keyed = staged(texts.select("doc_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    missing = (
        keyed.groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"))
        .join(read_cache(spark, cache_path, version), "digest", "left_anti")
        .select(F.col("doc_id").alias("one"), F.col("digest").alias("wanted"))
    )
    missing = staged(missing, "missing-digests")
    if not missing.isEmpty():
        # Only the chosen rows' texts get past this join.
        chosen = texts.join(missing, F.col("doc_id").eqNullSafe(F.col("one")) & (digest == F.col("wanted")))
        fresh = (
            chosen.select(F.col("wanted").alias("digest"), F.lit(version).alias("tokenizer"), counter(model)(F.col("text")).alias("n_tokens"))
            .groupBy("digest", "tokenizer")
            .agg(F.max("n_tokens").alias("n_tokens"))
        )
        fresh.write.mode("append").partitionBy("tokenizer").parquet(cache_path)
    # Read as a table, the counts leave Spark free to split a digest that many rows share.
    counts = staged(read_cache(spark, cache_path, version), "counts")
    return keyed.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
