"""Connected components of a link table of any size."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronicle.shared import staged


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (``a``, ``b``, both long).

    Large stars and small stars in turn: each step hangs neighbours on the
    smallest node they know, until every component is one star around its
    smallest node. A hub's links are combined before they are shuffled, and its
    join is split by Spark's skew handling. Each step reads a written table, so
    that lost executors cost one step only. Self links and links with a null
    end are left out; an empty table gives an empty result.
    """
    links = staged(
        links.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select("a", "b")
        .distinct(),
        "links",
    )
    state = _state(links)
    while state[0]:
        ways = _both_ways(links)
        least = ways.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = staged(
            ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
            "links",
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        links = staged(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        before, state = state, _state(links)
        if before == state:
            break
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)
