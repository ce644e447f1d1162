"""From raw documents to token ids: the stages of a small training corpus."""

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronicle.llm import decontaminate, pieces, pii, simhash, toxicity  # noqa: E402
from chronicle.llm.queries import model_path, table, toxic_labels  # noqa: E402
from chronicle.shared import fresh_folder, remove_folder, staging, stored  # noqa: E402


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    model = toxicity.fit(docs, toxic_labels(spark, sf_dir))
    return toxicity.scored(docs, model).where("predicted = 0").select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    covered = pii.with_redacted(docs, pii.fit(docs), spans="_spans", hidden="text")
    return covered.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def as_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's token ids, and whether they decode to its text."""
    coded = pieces.round_trip(docs, model_path())
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_dedup", without_copies),
    ("decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("sentencepiece", as_ids),
]

#: Trained scores and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next one.

    What a stage has staged on its way goes when it is written, and its own
    table when the next one is; the last table stays.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_folder(spark, f"corpus-{name}")
        with staging(spark):
            docs = stored(stage(spark, docs, sf_dir), path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs
