"""Shards of nearly equal bytes by a histogram sort.

Rows are ordered by a hash of their text, so equal texts stand together. Exact
byte counts below candidate boundaries are taken over all partitions, probes
close in on the splitters, and only then the rows are exchanged, once.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronicle.shared import staged

#: How far a boundary may lie from its ideal place, as a share of a shard.
TOLERANCE = 0.005
#: Candidate boundaries that a round counts between the two known ones around a splitter.
PROBES = 512
#: Bytes that one task puts in order after the exchange.
PART_BYTES = 64 << 20
LAW = "bytes"

_KEYS = 1 << 63


@dataclass(frozen=True)
class _Range:
    """Keys from ``lo`` to below ``hi``: text hashes, or places among the rows of the hash ``within``."""

    lo: int
    hi: int
    within: int | None = None

    @property
    def step(self) -> int:
        return -(-(self.hi - self.lo) // PROBES)

    def key(self) -> Column:
        return F.col("h" if self.within is None else "place")

    def holds(self) -> Column:
        inside = (self.key() >= self.lo) & (self.key() <= self.hi - 1)
        return inside if self.within is None else inside & (F.col("h") == self.within)


@dataclass(frozen=True)
class Splitter:
    """Rows before it: those with a smaller hash, or with the hash ``within`` and a smaller place."""

    at: int
    within: int | None = None

    def reached(self) -> Column:
        """True for rows at or behind the splitter."""
        if self.within is None:
            return F.col("h") > self.at - 1
        return (F.col("h") > self.within) | ((F.col("h") == self.within) & (F.col("place") > self.at - 1))


def keyed(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Each row's columns ``keep`` as ``row`` with its ``size``, checksum and sort key, stored once, as places must
    stay as they are."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return staged(
        docs.select(
            F.struct(*keep).alias("row"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text).alias("crc"),
            F.shiftrightunsigned(F.xxhash64(text), 1).alias("h"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "shard-keys",
    )


def _histogram(keys: DataFrame, ranges: list[_Range]) -> list[list]:
    """Per range its non-empty buckets in order, each with exact bytes, rows and outermost keys.

    At most ``PROBES`` rows a range reach the driver.
    """
    bucket, key = F.lit(None).cast("long"), F.lit(None).cast("long")
    for i, r in enumerate(ranges):
        # Divided as whole numbers, so that no key is rounded over an edge.
        slot = F.call_function("div", r.key() - r.lo, F.lit(r.step)) if r.step > 1 else r.key() - r.lo
        bucket = F.when(r.holds(), slot + i * PROBES).otherwise(bucket)
        key = F.when(r.holds(), r.key()).otherwise(key)
    rows = (
        keys.select(bucket.alias("bucket"), key.alias("key"), "size")
        .where("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.min("key").alias("first"), F.max("key").alias("last"))
        .collect()
    )
    found = [[] for _ in ranges]
    for row in sorted(rows, key=lambda r: r.bucket):
        found[row.bucket // PROBES].append(row)
    return found


def _narrowed(at: _Range, below: int, buckets: list, aim: float, slack: float):
    """The splitter for ``aim`` bytes, or a smaller range around it and the bytes below that."""
    for b in buckets:
        if below + b.bytes <= aim:
            below += b.bytes
            continue
        edges = sorted([(aim - below, b.first), (below + b.bytes - aim, b.last + 1)])
        one_row, one_text = b.rows == 1, at.within is None and b.first == b.last
        if edges[0][0] <= slack or one_row:
            return Splitter(edges[0][1], at.within), None
        return None, (_Range(0, _KEYS, b.first) if one_text else _Range(b.first, b.last + 1, at.within), below)
    return Splitter(at.hi, at.within), None


def find_splitters(keys: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> tuple[list[Splitter], int]:
    """``n_shards`` - 1 splitters in order, and the bytes of all rows.

    A splitter is final when the bytes before it are within ``tolerance`` of a
    shard from its ideal, or when a single row lies across the ideal. Equal
    texts are cut only where no edge of their group is that near; then the
    search goes on among the places of that group's rows.
    """
    whole = _Range(0, _KEYS)
    (first,) = _histogram(keys, [whole])
    total = sum(b.bytes for b in first)
    aims = [total * j / n_shards for j in range(1, n_shards)]
    slack = tolerance * total / n_shards
    done: dict[int, Splitter] = {}
    open_: dict[int, tuple[_Range, int]] = {}

    def sort_out(j: int, at: _Range, below: int, buckets: list) -> None:
        splitter, left = _narrowed(at, below, buckets, aims[j], slack)
        if splitter:
            done[j] = splitter
        else:
            open_[j] = left

    for j in range(n_shards - 1):
        sort_out(j, whole, 0, first)
    while open_:
        asked, open_ = open_, {}
        ranges = list(dict.fromkeys(at for at, _ in asked.values()))
        found = dict(zip(ranges, _histogram(keys, ranges)))
        for j, (at, below) in asked.items():
            sort_out(j, at, below, found[at])
    return [done[j] for j in range(n_shards - 1)], total


def shards(
    docs: DataFrame,
    n_shards: int = 8,
    tolerance: float = TOLERANCE,
    part_bytes: int = PART_BYTES,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The rows of ``docs`` (of their columns ``keep``, all by default) with ``size`` (bytes of ``text`` plus 1),
    ``text_crc32``, ``law``, ``shard`` and ``slot``.

    Shards are ranges of the text hash, so equal texts lie together unless
    their group is larger than the balance allows; slots count from 0 in each
    shard without gaps. Null texts count as empty; rows with null or repeated
    ids, and rows equal in all columns, each get their own slot. Columns of
    ``docs`` with a result's name are replaced. No rows give no rows.

    The driver sees sums of at most ``PROBES`` buckets a splitter and round. A
    shard is put in order in parts of about ``part_bytes``, whose first slots
    follow from exact counts.
    """
    keep = docs.columns if keep is None else keep
    keys = keyed(docs, keep)
    splitters, total = find_splitters(keys, n_shards, tolerance)
    parts = max(1, -(-total // (n_shards * part_bytes)))
    shard = F.lit(0)
    for s in splitters:
        shard = shard + s.reached().cast("int")
    dealt = keys.withColumns({"shard": shard, "part": F.pmod(F.xxhash64("h", "place"), F.lit(parts)).cast("int")})
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    first = staged(counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "shard-parts")
    own = Window.partitionBy("shard", "part").orderBy("h", "place")
    placed = dealt.withColumn("nth", F.row_number().over(own)).join(first, ["shard", "part"])
    results = {
        "size": F.col("size"),
        "text_crc32": F.col("crc"),
        "law": F.lit(LAW),
        "shard": F.col("shard"),
        "slot": F.col("first") + F.col("nth") - 1,
    }
    kept = [F.col("row")[c].alias(c) for c in keep if c not in results]
    return placed.select(*kept, *[value.alias(name) for name, value in results.items()])


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, **options) -> None:
    """Write :func:`shards` as Parquet, a ``shard=`` folder each; a folder's files hold its slots."""
    shards(docs, n_shards, **options).write.mode("overwrite").partitionBy("shard").parquet(path)
