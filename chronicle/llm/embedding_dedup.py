"""Near-duplicate vectors by sorted projection passes.

Each pass gives every vector the signs of 63 random projections of its own, sorts
by them and compares every vector with its neighbours in that order. The signs
that a vector shares with the ends of its window tell how crowded its place is:
vectors in crowded places get further passes among themselves, or are compared
in full where that moves less. Verified pairs of all passes are united. What a
window cannot hold, the dense groups, is then compared in full, group by group
and in blocks.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronicle.llm.components import connected_components
from chronicle.llm.kernels import roots_of
from chronicle.shared import staged

THRESHOLD = 0.9
WINDOW = 32
#: Chance with which the passes are to find a pair right at the threshold among evenly spread vectors.
RECALL = 0.95
BLOCK_ROWS = 2048
#: Members of a group that one task compares with as many others.
CHUNK_ROWS = 512
BUCKET_ROWS = 8192
#: Crowded vectors that one task compares with as many others.
CROWD_ROWS = 2048
_HASHES = 63
_ONE_PARTITION = (1 << 33) - 1


def _units(lists: pa.Array, size: int) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, size)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _agree(threshold: float) -> float:
    """Chance that two vectors at ``threshold`` have the same sign in a projection."""
    return 1 - math.acos(min(1.0, threshold)) / math.pi


def n_passes(n: int, threshold: float, window: int, recall: float) -> int:
    """Passes until a pair at ``threshold`` of evenly spread vectors is found with chance ``recall``.

    Sorting puts two of ``n`` such vectors within the window when they agree in
    about log2(n / window) signs; crowded ones need more.
    """
    chance = _agree(threshold) ** max(0.0, math.log2(max(n, 1) / window))
    return 1 if chance >= 1 else max(2, math.ceil(math.log(1 - recall) / math.log(1 - chance)))


def _hashed(passes: range, seed: int):
    def keys(batches):
        """The sort key of every vector in every pass."""
        planes = {}
        powers = (1 << np.arange(_HASHES, dtype=np.int64))[::-1]
        for batch in batches:
            node, lists = batch["node"].to_numpy(), batch["embedding"]
            sizes = lists.value_lengths().to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                units = _units(lists.take(pa.array(at)), size)
                for k in passes:
                    if (size, k) not in planes:
                        planes[size, k] = np.random.default_rng([seed, int(size), k]).standard_normal((size, _HASHES))
                    key = (units @ planes[size, k] > 0) @ powers
                    columns = [np.full(len(at), k, np.int32), np.full(len(at), size, np.int32), key, node[at]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["pass", "dim", "key", "node"])

    return keys


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: Links have no depth; other rows are a vector, a pass and the signs that surely bring a neighbour into the window.
_SEEN = pa.schema([*_LINKS, ("depth", pa.int32())])


def _stars(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Links of the places ``a`` and ``b`` in ``names`` as stars of names."""
    root = roots_of(len(names), a, b)
    moved = np.flatnonzero(root != np.arange(len(names)))
    return [names[moved], names[root[moved]]]


def _depths(key: np.ndarray, window: int) -> np.ndarray:
    """Leading signs that put a vector within the window of each one: one more than the window's ends share with it."""
    depth = np.zeros(len(key), np.int32)
    if len(key) > window:
        # frexp gives the length of the differing rest; halves are exact where a long is not.
        apart = key[:-window] ^ key[window:]
        high, low = np.frexp((apart >> 32).astype(float))[1], np.frexp((apart & 0xFFFFFFFF).astype(float))[1]
        shared = _HASHES - np.where(high > 0, high + 32, low)
        depth[:-window] = shared + 1
        depth[window:] = np.maximum(depth[window:], shared + 1)
    return depth


def _window_links(threshold: float, window: int):
    def links(table: pa.Table) -> pa.Table:
        """Pairs of one block within the window and the threshold, as stars, and the depths of its vectors."""
        table = table.sort_by("rank").combine_chunks()
        turn, dims, key = table["pass"].to_numpy(), table["dim"].to_numpy(), table["key"].to_numpy()
        lists = table["embedding"].combine_chunks()
        names, at = np.unique(table["node"].to_numpy(), return_inverse=True)
        found, depth = [(np.zeros(0, np.int64),) * 2], []
        cuts = np.flatnonzero((np.diff(turn) != 0) | (np.diff(dims) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(turn)]):
            units, own = _units(lists.slice(lo, hi - lo), int(dims[lo])), at[lo:hi]
            depth.append(_depths(key[lo:hi], window))
            for step in range(1, min(window, hi - lo - 1) + 1):
                near = np.flatnonzero(np.einsum("ij,ij->i", units[:-step], units[step:]) >= threshold)
                found.append((own[near], own[near + step]))
        a, b = _stars(names, *map(np.concatenate, zip(*found)))
        columns = [np.concatenate((a, names[at])), np.concatenate((b, turn))]
        depth = pa.concat_arrays([pa.nulls(len(a), pa.int32()), pa.array(np.concatenate(depth))])
        return pa.table([*columns, depth], schema=_SEEN)

    return links


def _crowd_links(threshold: float):
    def links(table: pa.Table) -> pa.Table:
        """Pairs at the threshold between two chunks of crowded vectors, as stars."""
        table = table.sort_by([("side", "ascending"), ("node", "ascending")]).combine_chunks()
        side, lists = table["side"].to_numpy(), table["embedding"].combine_chunks()
        units = _units(lists, len(lists[0]))
        mid = int(np.searchsorted(side, 1))
        if table["low"][0].as_py() == table["high"][0].as_py():
            a, b = np.nonzero(np.triu(units @ units.T >= threshold, 1))
        else:
            a, b = np.nonzero(units[:mid] @ units[mid:].T >= threshold)
            b = b + mid
        return pa.table(_stars(table["node"].to_numpy(), a, b), schema=_LINKS)

    return links


def _link_counts(threshold: float):
    def counts(table: pa.Table) -> pa.Table:
        """How many vectors each one links with, over the tasks of one bucket."""
        table = table.sort_by([("component", "ascending"), ("low", "ascending"), ("high", "ascending"), ("side", "ascending")])
        component, low, high, side = (table[c].to_numpy() for c in ("component", "low", "high", "side"))
        node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
        lists = table["embedding"].combine_chunks()
        total = np.zeros(len(node), np.int64)
        change = (np.diff(component) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)
        cuts = np.flatnonzero(change) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(node)]):
            part = lists.slice(lo, hi - lo)
            units = _units(part, len(part[0]))
            if low[lo] == high[lo]:
                near = units @ units.T >= threshold
                np.fill_diagonal(near, False)
                total[lo:hi] = near @ copies[lo:hi]
            else:
                mid = int(np.searchsorted(side[lo:hi], 1))
                near = units[:mid] @ units[mid:].T >= threshold
                total[lo : lo + mid] = near @ copies[lo + mid : hi]
                total[lo + mid : hi] = near.T @ copies[lo : lo + mid]
        return pa.table({"node": node, "links": total})

    return counts


def _passes(classes: DataFrame, passes: range, threshold: float, window: int, seed: int) -> DataFrame:
    """Links ``(a, b)`` found in the passes, and rows of node, pass and depth."""
    order = ["pass", "dim", "key", "node"]
    keys = staged(classes.mapInArrow(_hashed(passes, seed), "pass int, dim int, key long, node long"), "projection-keys")
    placed = keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = staged(placed.select(*order, F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(_ONE_PARTITION).alias("at")), "projection-order")
    sizes = placed.groupBy("part").agg((F.max("at") + 1).alias("n")).orderBy("part").collect()  # one row per partition
    ahead, total = [], 0
    for r in sizes:
        ahead.append((r.part, total))
        total += r.n
    ahead = classes.sparkSession.createDataFrame(ahead, "part long, ahead long")
    ranked = placed.join(F.broadcast(ahead), "part").select(*order, (F.col("at") + F.col("ahead")).alias("rank"))
    block = F.floor(F.col("rank") / BLOCK_ROWS)
    shared = (F.col("rank") % BLOCK_ROWS < window) & (block > 0)
    dealt = ranked.withColumn("block", F.explode(F.when(shared, F.array(block, block - 1)).otherwise(F.array(block))))
    dealt = dealt.join(classes.select("node", "embedding"), "node")
    return staged(dealt.groupBy("block").applyInArrow(_window_links(threshold, window), "a long, b long, depth int"), "seen")


def crowded(seen: DataFrame, threshold: float, recall: float, before: DataFrame | None = None) -> DataFrame:
    """``node``, ``missed`` and ``need`` of the vectors whose pairs all passes so far find with less than ``recall``.

    ``before`` is this table as it was ahead of the passes of ``seen``.
    ``missed`` is the logarithm of the chance that the passes miss a pair at the threshold, ``need``
    how many more it takes if they are like the last ones.
    """
    depth = seen.where("depth IS NOT NULL").groupBy(F.col("a").alias("node"), F.col("b").alias("pass")).agg(F.max("depth").alias("depth"))
    chance = F.when(F.col("depth") > _HASHES, F.lit(0.0)).otherwise(F.least(F.pow(F.lit(_agree(threshold)), "depth"), F.lit(1 - 1e-9)))
    missed = depth.groupBy("node").agg(F.sum(F.log1p(-chance)).alias("missed"), F.greatest(F.avg(chance), F.lit(1e-9)).alias("chance"))
    if before is not None:
        missed = missed.join(before.select("node", F.col("missed").alias("earlier")), "node")
        missed = missed.select("node", (F.col("missed") + F.col("earlier")).alias("missed"), "chance")
    wanted = F.lit(math.log(max(1 - recall, 1e-9)))
    need = F.ceil((wanted - F.col("missed")) / F.log1p(-F.col("chance")))
    return missed.where(F.col("missed") > wanted).select("node", "missed", need.alias("need"))


def crowd_links(classes: DataFrame, crowd: DataFrame, threshold: float) -> DataFrame:
    """Links ``(a, b)`` between the vectors of ``crowd`` (``node``), every pair of one length compared in blocks."""
    members = crowd.join(classes, "node").select("node", F.size("embedding").alias("dim"))
    members = staged(members, "crowd")
    sizes = members.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / CROWD_ROWS).alias("chunks"))
    own = F.pmod(F.xxhash64("node"), F.col("chunks"))
    members = members.join(sizes, "dim").withColumn("own", own)
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(
        "dim",
        "node",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    dealt = dealt.join(classes.select("node", "embedding"), "node")
    return dealt.groupBy("dim", "low", "high").applyInArrow(_crowd_links(threshold), "a long, b long")


def projection_links(classes: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL, seed: int = 42) -> DataFrame:
    """Links ``(a, b)`` between the ``node`` ids of different vectors.

    A pair is found by the less crowded of the two: a vector that has reached
    ``recall`` has been compared in enough passes with all others that were
    still there. So each round of further passes takes only the vectors that
    have not reached it, as many passes at most as there were before. A pass
    moves a vector once and a full comparison once per chunk: when even the
    least crowded of the rest needs more passes than that, the rest is
    compared in full.
    """
    done = n_passes(classes.count(), threshold, window, recall)
    seen = _passes(classes, range(done), threshold, window, seed)
    links = seen.where("depth IS NULL").select("a", "b")
    crowd = staged(crowded(seen, threshold, recall), "crowded")
    while True:
        left = crowd.agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("least"), F.max("need").alias("most")).first()
        chunks = math.ceil(left.n / CROWD_ROWS)
        if not left.n:
            return links
        if left.least > chunks:
            return links.unionByName(crowd_links(classes, crowd.select("node"), threshold))
        turn = range(done, done + min(done, left.most, chunks))
        seen = _passes(classes.join(crowd.select("node"), "node"), turn, threshold, window, seed)
        links = links.unionByName(seen.where("depth IS NULL").select("a", "b"))
        crowd = staged(crowded(seen, threshold, recall, crowd), "crowded")
        done = turn.stop


def link_counts(classes: DataFrame, found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(node, links)``: how many rows each vector of a group links with, by comparing each group in full.

    A group of ``m`` vectors is dealt into chunks, and every pair of chunks is a
    task of bounded size; pairs of vectors are counted there, not written.
    """
    sizes = found.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).alias("chunks"))
    members = found.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")))
    members = staged(members, "members")
    rows = members.agg(F.coalesce(F.sum("chunks"), F.lit(0))).first()[0]
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).select(
        "component",
        "node",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    bucket = F.pmod(F.xxhash64("component", "low", "high"), F.lit(max(1, math.ceil(rows / BUCKET_ROWS))))
    dealt = dealt.join(classes, "node").withColumn("bucket", bucket)
    counted = dealt.groupBy("bucket").applyInArrow(_link_counts(threshold), "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL, seed: int = 42) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every ``vec_id`` of ``vectors``.

    Two vectors link at a cosine of ``threshold`` or more, in double precision.
    Null or zero vectors and those with a null, NaN or infinite component link
    with nothing, nor do vectors of different lengths. Equal vectors are one
    point with copies, so that a group of copies costs one row. Rows that
    repeat a ``vec_id`` count once, with the smallest of its vectors; a null
    ``vec_id`` cannot be named in a result and its rows are left out.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").where("vec_id IS NOT NULL")
    rows = staged(rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "vectors")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = rows.where(F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0))
    classes = staged(usable.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "classes")
    found = staged(connected_components(projection_links(classes, threshold, window, recall, seed)), "groups")
    nodes = classes.join(found, "node", "left").join(link_counts(classes, found, threshold), "node", "left")
    nodes = nodes.select(
        "embedding",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.join(nodes, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (component == F.col("vec_id")).alias("kept"),
    )
