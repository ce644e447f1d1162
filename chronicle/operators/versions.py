"""Numbering the versions of each key from the oldest and from the newest."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronicle.shared import staged

_IN_PARTITION = (1 << 33) - 1


def _place(df: DataFrame, order: str, tie: str) -> list:
    """From oldest to newest, unknown times last; equal rows are told apart by a hash."""
    return [F.col(order).isNull(), F.col(order), F.col(tie), F.xxhash64(*df.columns)]


def _ranked(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with their rank in ``order`` over all rows, from 0.

    The rows are cut into ranges of the order, so a key of any size spreads
    over as many tasks as it needs; only a row count per range meets the driver.
    """
    sort = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    placed = staged(
        sort.select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND(_IN_PARTITION).alias("_at")), "ranges"
    )
    before, ahead = 0, []
    for r in placed.groupBy("_part").agg((F.max("_at") + 1).alias("n")).orderBy("_part").collect():
        ahead.append((r._part, before))
        before += r.n
    # One row for each partition of the range shuffle.
    ahead = F.broadcast(rows.sparkSession.createDataFrame(ahead, "_part long, _ahead long"))
    return placed.join(ahead, "_part").withColumn("_rank", F.col("_ahead") + F.col("_at")).drop("_part", "_at", "_ahead")


def number_versions(df: DataFrame, key: str, order: str, tie: str, split_above: int = 4_000_000) -> DataFrame:
    """Add ``rn_asc`` (oldest first) and ``rn_desc`` (newest first).

    ``order`` is a date or timestamp, ``tie`` a whole number. Unknown times come
    last in both directions, unknown ties first among the oldest; rows that
    agree in all of it are numbered by a hash of their columns.

    A window puts a whole key into one task. Rows of keys with more than
    ``split_above`` rows are therefore ranked by ranges of (key, time, tie), and a
    row's number is its distance from its key's first rank. Either way the
    numbers are the same. The newest-first number follows from the key's counts:
    known and unknown times are each counted from their other end.
    """
    sizes = df.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count(order).alias("_known")
    )
    large = staged(sizes.where(F.col("_rows") > split_above), "large-keys")
    same_key = F.col(key).eqNullSafe(F.col("_key"))
    place = _place(df, order, tie)

    def numbered(rows: DataFrame, ascending) -> DataFrame:
        end = F.when(F.col(order).isNull(), F.col("_rows") + F.col("_known")).otherwise(F.col("_known"))
        rows = rows.withColumn("rn_asc", ascending.cast("long"))
        return rows.select(*df.columns, "rn_asc", (end - F.col("rn_asc") + 1).alias("rn_desc"))

    in_key = Window.partitionBy(key)
    small = df if large.isEmpty() else df.join(large, same_key, "left_anti")
    small = small.select(
        "*", F.count(F.lit(1)).over(in_key).alias("_rows"), F.count(order).over(in_key).alias("_known")
    )
    small = numbered(small, F.row_number().over(in_key.orderBy(*place)))
    if large.isEmpty():
        return small
    ranked = _ranked(df.join(large, same_key, "left_semi"), [F.col(key), *place])
    firsts = ranked.groupBy(F.col(key).alias("_key")).agg(
        F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_rows"), F.count(order).alias("_known")
    )
    split = ranked.join(firsts, same_key)
    return small.unionByName(numbered(split, F.col("_rank") - F.col("_first") + 1))
