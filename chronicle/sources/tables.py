"""Reading tables of pages and histories."""

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

from chronicle.schemas import HISTORY, PAGE

_HISTORY_TEXT = "person_id long, name string, state string, city string, valid_from string, valid_to string"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Collected pages: id, URL and markup."""
    return spark.read.schema(PAGE).parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """A stored history table."""
    return spark.read.schema(HISTORY).parquet(path)


def history_from_rows(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """A small history given as Python rows with text dates, for tests and
    examples; large histories are read from storage."""
    from chronicle.operators.records import typed_history

    names = [f.split()[0] for f in _HISTORY_TEXT.split(", ")]
    values = [tuple(r.get(n) for n in names) for r in rows]
    return typed_history(spark.createDataFrame(values, _HISTORY_TEXT))


def rows(df: DataFrame) -> Iterator[dict]:
    """All result rows as dicts, fetched a partition at a time."""
    return (r.asDict() for r in df.toLocalIterator())
