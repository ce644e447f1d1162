"""SimHash near-duplicates by a self-join of the trie of fingerprints.

Two fingerprints within three bits agree in one of four 16-bit blocks. Each
rotation of the fingerprint brings another block to the top of a binary trie,
so the pairs of trie nodes worth traversing start out as a node of depth 16
with itself. From there both sides go down together, differing bits add up,
and a node pair is pruned once they exceed the budget.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronicle.llm.components import connected_components
from chronicle.llm.kernels import filled, roots_of
from chronicle.shared import staged

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints of one node pair that a task may traverse alone; larger pairs are split first.
NODE_ROWS = 512
#: Fingerprints traversed by one call.
BUCKET_ROWS = 8192
_STEP = 8
_BLOCK = 1 << 16


def fingerprint_of(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of one text in UTF-8; words are separated by ASCII white space."""
    parts = text.lower().split()  # on bytes this touches A-Z only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(parts))
    first, last = starts[: len(parts) - k + 1], ends[k - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(first), _BLOCK):
        pairs = zip(first[at : at + _BLOCK].tolist(), last[at : at + _BLOCK].tolist())
        hashes = np.array([digest(joined[s:e], seed) for s, e in pairs], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` (``text``) with ``fp``, the 64 bits as a long; a null text counts as empty."""

    @F.arrow_udf("long")
    def fp(texts: pa.Array) -> pa.Array:
        values = [fingerprint_of(t.as_buffer().to_pybytes(), words, seed) for t in filled(texts)]
        return pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())

    return docs.withColumn("fp", fp("text"))


def _below(lo, hi, ones):
    """Where the set bit begins in each sorted range."""
    return hi - (ones[hi] - ones[lo])


def trie_pairs(keys: np.ndarray, own: np.ndarray, cross: np.ndarray, depth: int, budget: int):
    """Index pairs within ``budget`` bits, by going down node pairs together.

    ``keys`` is sorted within every range; ``own`` has rows (lo, hi) of nodes
    paired with themselves, ``cross`` rows (lo, hi, lo2, hi2, bits so far).
    """
    for bit in range(63 - depth, -1, -1):
        ones = np.concatenate(([0], np.cumsum((keys >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)))
        lo, hi = own.T
        mid = _below(lo, hi, ones)
        fresh = np.stack([lo, mid, mid, hi, np.ones_like(lo)], 1)
        own = np.concatenate((np.stack([lo, mid], 1), np.stack([mid, hi], 1)))
        own = own[own[:, 1] - own[:, 0] > 1]
        a, b, c, d, e = cross.T
        m, n = _below(a, b, ones), _below(c, d, ones)
        sides = [(a, m, c, n, e), (m, b, n, d, e), (a, m, n, d, e + 1), (m, b, c, n, e + 1)]
        cross = np.concatenate([fresh, *(np.stack(s, 1) for s in sides)])
        cross = cross[(cross[:, 4] <= budget) & (cross[:, 1] > cross[:, 0]) & (cross[:, 3] > cross[:, 2])]
    return cross[:, 0], cross[:, 2]


def _bucket_links(budget):
    def links(table: pa.Table) -> pa.Table:
        """Links of one bucket of node pairs, as stars: each group's members to its smallest one."""
        task = table["task"].to_numpy()
        side = table["side"].to_numpy()
        keys = table["rot"].to_numpy().view(np.uint64)
        order = np.lexsort((keys, side, task))
        task, side, keys = task[order], side[order], keys[order]
        node = table["node"].to_numpy()[order]
        depths, bits = table["depth"].to_numpy()[order], table["bits"].to_numpy()[order]
        change = np.flatnonzero(np.concatenate(([True], (task[1:] != task[:-1]) | (side[1:] != side[:-1]))))
        ends = np.append(change[1:], len(task))
        found = [(np.zeros(0, np.int64),) * 2]
        first, second = side[change] == 0, side[change] == 1
        second[:-1] &= task[change[1:]] == task[change[:-1]]
        second[-1:] = False
        for depth in np.unique(depths):
            here = depths[change] == depth
            own, low = np.flatnonzero(first & here), np.flatnonzero(second & here)
            own = np.stack([change[own], ends[own]], 1)
            cross = np.stack([change[low], ends[low], change[low + 1], ends[low + 1], bits[change[low]]], 1)
            for at in range(0, max(len(own), len(cross)), 4096):
                part = own[at : at + 4096], cross[at : at + 4096]
                found.append(trie_pairs(keys, *part, int(depth), budget))
        names, at = np.unique(node, return_inverse=True)
        root = roots_of(len(names), *(at[np.concatenate(x)] for x in zip(*found)))
        moved = np.flatnonzero(root != np.arange(len(names)))
        return pa.table({"a": names[moved], "b": names[root[moved]]}, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return links


def _prefix(depth):
    return F.shiftrightunsigned("rot", 64 - depth) if depth < 64 else F.col("rot")


def fingerprint_links(points: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that connect all of ``points`` (``fp``, ``node``) within ``budget`` bits.

    Every pair within the budget ends up connected; a clique is returned as a
    star, not as all its pairs. ``fp`` values are distinct. ``budget`` + 1 must
    divide 64.
    """
    blocks = budget + 1
    if 64 % blocks:
        raise ValueError("the bit budget plus one must divide 64")
    width = 64 // blocks
    turned = [F.col("fp") if not r else F.shiftleft("fp", r * width).bitwiseOR(F.shiftrightunsigned("fp", 64 - r * width)) for r in range(blocks)]
    rows = points.select("node", F.posexplode(F.array(*turned)).alias("r", "rot"))
    nodes = rows.groupBy("r", _prefix(width).alias("p")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = nodes.select("r", F.col("p").alias("p1"), F.col("p").alias("p2"), F.lit(0).alias("bits"), F.col("n").alias("n1"), F.col("n").alias("n2"))
    sent, depth, total = [], width, 0
    while True:
        both = F.col("n1") + F.when(F.expr("p1 = p2"), 0).otherwise(F.col("n2"))
        pairs = staged(pairs.withColumn("own", F.expr("p1 = p2")).withColumn("size", both), "trie-pairs")
        heavy, wide = pairs.agg(F.count_if(F.col("size") > NODE_ROWS), F.sum("size")).first()
        total += wide or 0
        whole = pairs.where(F.col("size") <= NODE_ROWS).withColumn("task", F.xxhash64(F.lit(depth), "r", "p1", "p2"))
        ends = whole.select("r", F.col("p1").alias("p"), "task", F.when(F.col("own"), 0).otherwise(1).alias("side"), "bits")
        ends = ends.unionByName(whole.where("NOT own").select("r", F.col("p2").alias("p"), "task", F.lit(2).alias("side"), "bits"))
        sent.append(
            rows.withColumn("p", _prefix(depth))
            .join(ends, ["r", "p"])
            .select("task", "side", F.lit(depth).alias("depth"), "bits", "rot", "node")
        )
        if not heavy:
            break
        over = pairs.where(F.col("size") > NODE_ROWS)
        step = min(_STEP, 64 - depth)
        parents = over.select("r", F.col("p1").alias("p")).unionByName(over.select("r", F.col("p2").alias("p"))).distinct()
        depth += step
        children = (
            rows.withColumn("p", F.shiftrightunsigned("rot", 64 - depth + step))
            .join(parents, ["r", "p"], "left_semi")
            .groupBy("r", "p", _prefix(depth).alias("c"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        children = staged(children, "trie-nodes")
        one = children.select("r", F.col("p").alias("p1"), F.col("c").alias("c1"), F.col("n").alias("m1"))
        two = children.select("r", F.col("p").alias("p2"), F.col("c").alias("c2"), F.col("n").alias("m2"))
        pairs = (
            over.drop("n1", "n2", "size")
            .join(one, ["r", "p1"])
            .join(two, ["r", "p2"])
            .withColumn("bits", (F.col("bits") + F.bit_count(F.col("c1").bitwiseXOR(F.col("c2")).bitwiseAND(F.lit((1 << step) - 1)))).cast("int"))
            .where(f"bits <= {budget} AND (NOT own OR c1 <= c2) AND NOT (c1 = c2 AND m1 < 2)")
            .select("r", F.col("c1").alias("p1"), F.col("c2").alias("p2"), "bits", F.col("m1").alias("n1"), F.col("m2").alias("n2"))
        )
    work = sent[0]
    for more in sent[1:]:
        work = work.unionByName(more)
    buckets = max(1, math.ceil(total / BUCKET_ROWS))
    return (
        work.withColumn("bucket", F.pmod(F.xxhash64("task"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(_bucket_links(budget), "a long, b long")
    )


def _grouped(prints: DataFrame, budget: int) -> DataFrame:
    """``fp`` and ``grp``, the smallest fingerprint that each distinct one of ``prints`` reaches."""
    points = staged(prints.select("fp").distinct(), "points")
    found = connected_components(fingerprint_links(points.select("fp", F.col("fp").alias("node")), budget))
    return points.join(found, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("grp"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, budget: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` and ``kept`` for every row.

    Rows link at ``budget`` or fewer differing bits, over any chain of links;
    ``component_id`` is the smallest ``doc_id`` reached. Texts without words,
    null ones included, have fingerprint zero and link like any other. Rows
    without a ``doc_id`` link, too, but are never ``kept``; a group of such rows
    alone has no ``component_id``. Rows with equal ids are linked by their texts
    only. Repeated rows are each returned. Equal fingerprints are one point,
    however many rows share them.
    """
    prints = staged(fingerprints(docs.select("doc_id", "text"), words).select("doc_id", "fp"), "fingerprints")
    groups = _grouped(prints, budget)
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = staged(groups.join(least, "fp"), "groups")
    smallest = named.groupBy("grp").agg(F.min("least").alias("component_id"))
    named = staged(named.join(smallest, "grp").select("fp", "component_id"), "named-groups")
    return prints.join(named, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, budget: int = MAX_BITS) -> DataFrame:
    """One row of each group of ``docs``, unchanged: the one with the smallest ``doc_id``, of rows with equal ids the
    one whose columns hash lowest. A row without an id stays only where its group has none with one.

    Groups are made of texts alone: rows that share an id but not their text
    both stay, and so does one of several copies without ids.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    own = F.xxhash64(*names), F.xxhash64(F.lit("again"), *names)
    prints = fingerprints(docs.select("doc_id", "text", own[0].alias("h1"), own[1].alias("h2")), words)
    prints = staged(prints.select("doc_id", "fp", "h1", "h2"), "fingerprints")
    groups = staged(_grouped(prints, budget), "groups")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "h1", "h2"))
    first = prints.groupBy("fp").agg(best.alias("row")).join(groups, "fp").groupBy("grp").agg(F.min("row").alias("row"))
    stays = staged(first.select(F.col("row.h1").alias("_h1"), F.col("row.h2").alias("_h2")), "stays")
    same = (own[0] == F.col("_h1")) & (own[1] == F.col("_h2"))
    # Rows that are equal in all columns hash alike; such winners are few and one copy of each is taken.
    copies = prints.join(stays, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("n"))
    copies = staged(copies.where("n > 1").select("_h1", "_h2"), "copies")
    if copies.isEmpty():
        return docs.join(stays, same, "left_semi")
    alone = docs.join(stays.join(copies, ["_h1", "_h2"], "left_anti"), same, "left_semi")
    once = docs.select(F.struct(*names).alias("row"), own[0].alias("_h1"), own[1].alias("_h2")).join(copies, ["_h1", "_h2"], "left_semi")
    once = once.groupBy("_h1", "_h2").agg(F.first("row").alias("row"))
    return alone.unionByName(once.select(*[F.col("row")[c].alias(c) for c in docs.columns]))
