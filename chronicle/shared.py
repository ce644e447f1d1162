"""Storage that every executor can reach, used to cut lineage and to stage
tables that several jobs read."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_ONE_MACHINE = re.compile(r"local(\[.*\])?")
_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on a single machine may leave the setting out; it then gets
    a temporary folder, recorded on the session so that it is made once.
    """
    context = spark.sparkContext
    named = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not _ONE_MACHINE.fullmatch(context.master):
        raise ValueError(f"{_SETTING} must name a folder that all executors share")
    root = getattr(spark, "_chronicle_root", None)
    if root is None:
        root = "file://" + tempfile.mkdtemp(prefix="chronicle-")
        spark._chronicle_root = root
    return root


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, on any file system that Spark can write; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def put_mark(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``, on any file system that Spark can write."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True).close()


def has_mark(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block belong to it and are removed at its end,
    also when it fails. Write results that read them before the block ends.

    Blocks nest; tables staged in another thread are not meant.
    """
    own: list[str] = []
    token = _owned.set(own)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in own:
            remove_folder(spark, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Readers of the result never recompute the plan behind it, also when
    executors are lost, and still get column pruning and filter pushdown. Inside
    a ``staging`` block the table goes when the block ends; otherwise it stays.
    """
    path = fresh_folder(df.sparkSession, label)
    own = _owned.get()
    if own is not None:
        own.append(path)
    return stored(df, path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a table at ``path``, replacing what is there, and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
