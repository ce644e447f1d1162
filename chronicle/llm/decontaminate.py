"""Benchmark passages inside documents, found by greedy string tiling.

Word windows are the seeds. Those of documents pass a filter of fixed size
built from the items' windows. Rare seeds join texts to items; each text that is
joined is tiled with its items by running Karp-Rabin hashes, in time that
follows from the text and the item, not from the pairs of equal places.
"""

import heapq
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronicle.llm.kernels import Runs, Words, filled, mixed, slices, windows
from chronicle.shared import staged

#: Shortest tile in words, also the size of a seed; an item with fewer words is a single seed of all its words.
MIN_MATCH = 5
#: Share of an item's words that tiles must cover.
MIN_COVERAGE = 0.8
#: The filter has 2 to this power bits: 8 MB, whatever the size of the benchmark. It saves work and decides nothing.
FILTER_BITS = 26
#: Items that a task tiles with a text at a time; a text with more of them is sent to several.
GROUP_ITEMS = 1024

_OTHER = np.uint64(0xD6E8FEB86659FD93)
_SEEDS = [("hash", pa.list_(pa.int64())), ("check", pa.list_(pa.int64())), ("place", pa.list_(pa.int32()))]
_SEED = "hash array<long>,check array<long>"


def _seeds(words: Words, size: int):
    """Row, two 64-bit hashes and first word of every window of ``size`` words."""
    hash_, first = windows(words, size)
    row = words.rows[first]
    plain, words.hashes = words.hashes, mixed(words.hashes ^ _OTHER)
    check, _ = windows(words, size)
    words.hashes = plain
    return row, mixed(hash_ + np.uint64(size * int(_OTHER) % (1 << 64))), check, first - words.row_starts[row]


def _lists(rows: int, row: np.ndarray, columns: list[np.ndarray]) -> list[pa.Array]:
    """A list per row of each column, in the order of the columns."""
    order = np.argsort(row, kind="stable")
    ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows)))), pa.int32())
    return [pa.ListArray.from_arrays(ends, pa.array(c[order])) for c in columns]


def _seeder(sizes: tuple[int, ...], passed: np.ndarray, bits: int):
    """The UDF: the seeds of each text, of all ``sizes``, that ``passed`` lets through."""

    @F.arrow_udf(f"struct<{_SEED},place:array<int>>")
    def seeds(texts: pa.Array) -> pa.Array:
        parts = [[pa.array([], kind)] for _, kind in _SEEDS]
        for part in slices(filled(texts)):
            words = Words(part, characters=True)
            row, hash_, check, place = (np.concatenate(c) for c in zip(*(_seeds(words, size) for size in sizes)))
            slot = hash_ & np.uint64((1 << bits) - 1)
            at = np.flatnonzero((passed[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1))
            columns = [hash_[at].view(np.int64), check[at].view(np.int64), place[at].astype(np.int32)]
            for own, found in zip(parts, _lists(len(part), row[at], columns)):
                own.append(found)
        return pa.StructArray.from_arrays([pa.concat_arrays(p) for p in parts], [name for name, _ in _SEEDS])

    # A filter on the result of a deterministic function would run it a second time, in another worker; so below.
    return seeds.asNondeterministic()


def _item_windows(size: int):
    """The UDF: each item's number of words and its windows, one at every place."""

    @F.arrow_udf(f"struct<length:int,{_SEED}>")
    def found(texts: pa.Array) -> pa.Array:
        words = Words(filled(texts), characters=True)
        columns = []
        for own in range(1, size + 1):
            row, hash_, check, _ = _seeds(words, own)
            fits = words.counts[row] == own if own < size else words.counts[row] >= size
            columns.append((row[fits], hash_[fits].view(np.int64), check[fits].view(np.int64)))
        row, hash_, check = (np.concatenate(c) for c in zip(*columns))
        lists = _lists(len(texts), row, [hash_, check])
        return pa.StructArray.from_arrays([pa.array(words.counts, pa.int32()), *lists], ["length", "hash", "check"])

    return found.asNondeterministic()


def seed_filter(seeds: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit for every hash of ``seeds`` (``hash``), in 2 ** (``bits`` - 6) words."""
    slot = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    # At most one row for each word of the filter.
    rows = seeds.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("set")).toArrow()
    passed = np.zeros(1 << max(bits - 6, 0), np.uint64)
    passed[rows["word"].to_numpy().astype(np.int64)] = rows["set"].to_numpy().view(np.uint64)
    return passed


class _Free:
    """The unmarked words of a row of ``n``."""

    def __init__(self, n: int):
        self.starts, self.ends = np.array([n]), np.array([n])

    def ahead(self, places):
        """How many unmarked words stand from each place on."""
        k = np.searchsorted(self.starts, places, "right")
        return np.where((k > 0) & (self.ends[k - 1] > places), 0, self.starts[k] - places)

    def mark(self, start: int, n: int) -> None:
        k = np.searchsorted(self.starts, start)
        self.starts, self.ends = np.insert(self.starts, k, start), np.insert(self.ends, k, start + n)


def _run_lengths(there: np.ndarray) -> np.ndarray:
    """For each place how many places in a row, from it on, are true."""
    stops = np.append(np.flatnonzero(~there), len(there))
    return stops[np.searchsorted(stops, np.arange(len(there)))] - np.arange(len(there))


def greedy_tiles(item: np.ndarray, text: np.ndarray, places: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy tiles ``(place in text, place in item, words)``, longest first.

    ``item`` numbers the window at each place of the item, -1 where the text
    lacks it; ``text`` has the numbers of the text's windows at ``places``, in
    order. In each step the longest match without marked words is marked on both
    sides; of equally long ones the first in the item, then in the text.

    A place of the item waits under the length that its match can have at most.
    When its turn comes, that length is looked for among the text's places by
    Karp-Rabin hashes; where it is not found, the place waits again under the
    length that is.
    """
    by_number = np.argsort(text, kind="stable")
    first = np.searchsorted(text[by_number], np.arange(item.max(initial=-1) + 2))
    in_item, in_text = Runs(item + 1), Runs(text + 1)
    chain = _run_lengths(np.append(np.diff(places) == 1, False)) + 1
    longest = np.zeros(len(first), np.int64)
    np.maximum.at(longest, text, chain)
    bound = np.minimum(_run_lengths(item >= 0), np.where(item >= 0, longest[item], 0))
    heap = [(-b, i) for i, b in enumerate(bound.tolist()) if b]
    heapq.heapify(heap)
    free_item, free_text = _Free(len(item) + size - 1), _Free(int(places[-1]) + size if len(places) else 0)

    def fitting(at: np.ndarray, i: int, w: int) -> np.ndarray:
        at = at[(chain[at] >= w) & (free_text.ahead(places[at]) >= w + size - 1)]
        return at[in_text.hash(at, w) == in_item.hash(np.array([i]), w)]

    def found(at: np.ndarray, i: int, w: int) -> int | None:
        step = 1024
        while len(at):
            for k in fitting(at[:step], i, w).tolist():
                if np.array_equal(text[k : k + w], item[i : i + w]):
                    return k
            at, step = at[step:], 4 * step
        return None

    def shorter(at: np.ndarray, i: int, w: int) -> int:
        low, at = 1, fitting(at, i, 1)
        high = w
        while len(at) and low + 1 < high:
            middle = min(2 * low, (low + high + 1) // 2)
            kept = fitting(at, i, middle)
            if len(kept):
                low, at = middle, kept
            else:
                high = middle
        return low if len(at) else 0

    chosen = []
    while heap:
        w, i = heapq.heappop(heap)
        room = int(free_item.ahead(i)) - size + 1
        if room <= 0:
            continue
        if room < -w:
            heapq.heappush(heap, (-room, i))
            continue
        at = by_number[first[item[i]] : first[item[i] + 1]]
        k = found(at, i, -w)
        if k is not None:
            free_item.mark(i, size - 1 - w)
            free_text.mark(int(places[k]), size - 1 - w)
            chosen.append((int(places[k]), i, size - 1 - w))
        elif less := shorter(at, i, -w):
            heapq.heappush(heap, (-less, i))
    return chosen


class _TextSeeds:
    """The seeds of one text, sorted for look-ups."""

    def __init__(self, hash_: np.ndarray, check: np.ndarray, place: np.ndarray):
        order = np.lexsort((check, hash_))
        self.hash, self.check, self.place = hash_[order], check[order], place[order].astype(np.int64)

    def tiles(self, hash_: np.ndarray, check: np.ndarray, length: int, size: int, share: float):
        """Coverage and number of tiles of an item, zero where no tiles could cover enough."""
        order = np.lexsort((check, hash_))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (hash_[order][1:] != hash_[order][:-1]) | (check[order][1:] != check[order][:-1])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1
        distinct = order[fresh]
        low, high = np.searchsorted(self.hash, hash_[distinct]), np.searchsorted(self.hash, hash_[distinct], "right")
        n = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        text = np.repeat(np.arange(len(distinct)), n)
        same = self.check[at] == check[distinct][text]
        at, text = at[same], text[same]
        there = np.zeros(len(distinct), bool)
        there[text] = True
        item = np.where(there[number], number, -1)
        covered = np.zeros(length + 1, np.int64)
        np.add.at(covered, np.flatnonzero(item >= 0), 1)
        np.add.at(covered, np.flatnonzero(item >= 0) + size, -1)
        if np.count_nonzero(np.cumsum(covered)) < share * length:
            return 0.0, 0
        in_order = np.argsort(self.place[at], kind="stable")
        found = greedy_tiles(item, text[in_order], self.place[at][in_order], size)
        return sum(t[2] for t in found) / length, len(found)


def _tiler(size: int, share: float):
    @F.arrow_udf("array<struct<item:binary,coverage:double,n_tiles:int>>")
    def tiled(hashes: pa.Array, checks: pa.Array, places: pa.Array, items: pa.Array) -> pa.Array:
        rows = []
        for own_hash, own_check, own_place, others in zip(hashes, checks, places, items):
            text = _TextSeeds(*(c.values.to_numpy() for c in (own_hash, own_check, own_place)))
            found, others = [], others.values
            for name, length, hash_, check in zip(*(others.field(f) for f in ("item", "length", "hash", "check"))):
                length = length.as_py()
                coverage, n = text.tiles(hash_.values.to_numpy(), check.values.to_numpy(), length, min(size, length), share)
                if coverage >= share:
                    found.append({"item": name.as_py(), "coverage": coverage, "n_tiles": n})
            rows.append(found)
        return pa.array(rows, pa.list_(pa.struct([("item", pa.binary()), ("coverage", pa.float64()), ("n_tiles", pa.int32())])))

    return tiled


def _key_picker(size: int, share: float):
    """The UDF: an item's seeds but for the commonest ones, as far as these cannot cover ``share`` of it by
    themselves. Whatever covers that much of the item then holds a seed that is left."""

    @F.arrow_udf("array<struct<hash:long,check:long>>")
    def keys(lengths: pa.Array, hashes: pa.Array, checks: pa.Array, shared: pa.Array) -> pa.Array:
        rows = []
        for length, own_hash, own_check, common in zip(lengths.to_pylist(), hashes.to_pylist(), checks.to_pylist(), shared.to_pylist()):
            places, need, covered = {}, ceil(share * length - 1e-9), np.zeros(length, bool)
            for i, seed in enumerate(zip(own_hash, own_check)):
                places.setdefault(seed, []).append(i)
            for seed in sorted(((-c["n"], c["hash"], c["check"]) for c in common or () if c["n"] > 1)):
                before = covered.copy()
                for i in places[seed[1:]]:
                    covered[i : i + min(size, length)] = True
                if np.count_nonzero(covered) < need:
                    del places[seed[1:]]
                else:
                    covered = before
            rows.append([{"hash": h, "check": c} for h, c in places])
        return pa.array(rows, pa.list_(pa.struct([("hash", pa.int64()), ("check", pa.int64())])))

    return keys.asNondeterministic()


def _digest(text: str):
    """Names a text, so that copies are looked at once and rows need no id."""
    return F.unhex(F.sha2(text, 256))


def benchmark_items(benchmark: DataFrame, size: int = MIN_MATCH) -> tuple[DataFrame, DataFrame]:
    """``item, length, hash, check`` of the different sequences of words, and ``item_id, item``.

    Items without words or without an id are left out; items with the same words are one ``item``.
    """
    texts = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    found = texts.distinct().select("item_id", _item_windows(size)("text").alias("w")).select("item_id", "w.*").where("length > 0")
    parts = [F.col(c).cast("array<string>") for c in ("hash", "check")]
    item = F.unhex(F.sha2(F.concat_ws(",", F.col("length").cast("string"), *parts), 256))
    found = staged(found.withColumn("item", item), "benchmark-windows")
    items = found.groupBy("item").agg(*[F.first(c).alias(c) for c in ("length", "hash", "check")])
    return staged(items, "benchmark-items"), found.select("item_id", "item").distinct()


def item_index(items: DataFrame, size: int = MIN_MATCH, share: float = MIN_COVERAGE) -> DataFrame:
    """``hash, check, item``: the seeds by which texts find items. A seed that many items
    share is none of them where the item's other seeds do."""
    pairs = F.explode(F.array_distinct(F.arrays_zip("hash", "check")))
    seeds = items.select("item", pairs.alias("s")).select("item", "s.*")
    common = seeds.groupBy("hash", "check").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = seeds.join(common, ["hash", "check"]).groupBy("item").agg(F.collect_list(F.struct("hash", "check", "n")).alias("shared"))
    keyed = items.join(shared, "item", "left").select("item", _key_picker(size, share)("length", "hash", "check", "shared").alias("keys"))
    return keyed.select("item", F.inline("keys")).select("hash", "check", "item")


def leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = MIN_MATCH, share: float = MIN_COVERAGE, bits: int = FILTER_BITS
) -> DataFrame:
    """``digest``, ``item_id``, ``coverage`` and ``n_tiles``, a row per distinct text of ``docs`` and item in it.

    Words are compared in lower case without punctuation; each character of a
    script without blanks is a word. Windows of ``size`` words shared by item
    and text are seeds; the longest matches are marked one after the other
    without overlap on either side, so a passage counts in whatever order its
    parts stand; ``share`` of the item's words must be covered. An item of fewer
    than ``size`` words must stand in the text as a whole. One without words, a
    null text or a null id matches nothing. An item id with several texts
    yields a row for each text found.

    Of a document only seeds that pass the filter are kept, and of equal texts
    one. Texts meet items by the items' rare seeds, so that a phrase of all
    items joins nothing by itself, and each pair once.
    """
    items, names = benchmark_items(benchmark, size)
    passed = seed_filter(items.select(F.explode("hash").alias("hash")), bits)
    # At most ``size`` - 1 rows.
    short = items.where(F.col("length") < size).select("length").distinct().collect()
    sizes = (*sorted(r.length for r in short), size)
    texts = docs.select("text").where("text IS NOT NULL")
    texts = texts.select(_digest("text").alias("digest"), _seeder(sizes, passed, bits)("text").alias("seeds"))
    texts = staged(texts.where(F.size("seeds.hash") > 0).groupBy("digest").agg(F.first("seeds").alias("seeds")), "seeded-texts")
    index = staged(item_index(items, size, share), "item-index")
    own = texts.select("digest", F.explode(F.array_distinct(F.arrays_zip("seeds.hash", "seeds.check"))).alias("s"))
    met = staged(own.select("digest", "s.*").join(index, ["hash", "check"]).select("digest", "item").distinct(), "texts-and-items")
    number = met.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
    group = F.pmod(F.xxhash64("item"), 1 + F.expr(f"n div {GROUP_ITEMS}"))
    met = met.join(number, "digest").select("digest", "item", group.alias("group"))
    sent = met.join(items, "item").groupBy("digest", "group").agg(F.collect_list(F.struct("item", "length", "hash", "check")).alias("items"))
    tiled = _tiler(size, share)("seeds.hash", "seeds.check", "seeds.place", "items")
    found = sent.join(texts, "digest").select("digest", F.inline(tiled))
    return staged(found.join(names, "item").select("digest", "item_id", "coverage", "n_tiles"), "leaks")


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``item_id``, ``coverage``, ``n_tiles`` and ``contaminated`` (true), a row for each leak of each row.

    Repeated rows and rows without a ``doc_id`` are each returned.
    """
    found = docs.select("doc_id", _digest("text").alias("digest")).join(leaks(docs, benchmark, **options), "digest")
    return found.select("doc_id", "item_id", "coverage", "n_tiles", F.lit(True).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found, unchanged; null texts stay."""
    dirty = leaks(docs, benchmark, **options).select(F.col("digest").alias("_digest")).distinct()
    return docs.join(dirty, _digest("text") == F.col("_digest"), "left_anti")
