"""Keeping a given number of rows without bringing them together."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronicle.shared import staged


def _cut_off(rows: DataFrame, column: str, n: int):
    """``(value, below, equal)``: the value that the ``n``-th row has in the order
    of ``column`` (nulls first), how many rows have a smaller one, and how many
    have it; null when there are no more than ``n`` rows.

    Rows are combined to one per value. The values are put in ranges, of which
    a sum each reaches the driver, and only the range of the cut is looked into.
    """
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranges = staged(counts.repartitionByRange(F.asc_nulls_first(column)).withColumn("_range", F.spark_partition_id()), "cap-values")
    below = 0
    for r in ranges.groupBy("_range").agg(F.sum("_n").alias("n")).orderBy("_range").collect():
        if below + r.n >= n:
            break
        below += r.n
    else:
        return None
    upto = F.sum("_n").over(Window.partitionBy("_range").orderBy(F.asc_nulls_first(column)))
    within = ranges.where(F.col("_range") == r["_range"]).select(F.col(column).alias("value"), F.col("_n"), (upto + below).alias("_upto"))
    cut = within.where(F.col("_upto") >= n).orderBy("_upto").first()
    return cut["value"], cut["_upto"] - cut["_n"], cut["_n"]


def _smaller(column: str, value) -> Column:
    """Before ``value`` where nulls come first."""
    if value is None:
        return F.lit(False)
    return F.col(column).isNull() | F.coalesce(F.col(column) < F.lit(value), F.lit(False))


def capped(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the order of ``order`` and then of all other columns, nulls first.

    ``df`` must be a stored table, as it is read several times. A cut-off value
    is found for one column after the other, among the rows that are equal in
    those before, until the cut does not go through equal rows; what is kept is
    a filter on the cut-offs. Unlike a limit over an order, this moves counts
    of values instead of rows, and the result keeps the table's partitions.
    """
    if n <= 0:
        return df.limit(0)
    kept, tied, left = F.lit(False), F.lit(True), n
    for column in [*order, *(c for c in df.columns if c not in order)]:
        cut = _cut_off(df.where(tied), column, left)
        if cut is None:  # there are fewer rows than asked for
            return df
        value, below, equal = cut
        kept = kept | (tied & _smaller(column, value))
        tied = tied & F.col(column).eqNullSafe(F.lit(value))
        left -= below
        if left == equal:
            return df.where(kept | tied)
    # What is tied now are copies of one row.
    copies = df.where(tied).limit(1).select(*df.columns, F.explode(F.sequence(F.lit(1), F.lit(left)))).drop("col")
    return df.where(kept).unionByName(copies)
