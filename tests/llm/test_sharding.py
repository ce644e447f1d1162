"""Shards: balance, slots, groups, and every row once."""

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from chronicle.llm import queries, sharding

from .conftest import ODD_TEXTS


def checked(rows, n_shards=8, tolerance=sharding.TOLERANCE):
    """Sizes, checksums and slots are right, and shards are balanced as well as single rows allow."""
    bytes_, slots, places = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "bytes")
        bytes_[r.shard] += r.size
        slots[r.shard].append(r.slot)
        places[r.text or ""].add(r.shard)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    assert set(bytes_) <= set(range(n_shards))
    total, largest = sum(bytes_.values()), max((r.size for r in rows), default=0)
    before = 0
    for j in range(n_shards):
        before += bytes_[j]
        assert abs(before - total * (j + 1) / n_shards) <= max(tolerance * total / n_shards, largest / 2) + 1
    return places


@pytest.mark.parametrize("n_shards", [1, 3, 8])
def test_odd_rows(spark, docs, n_shards):
    rows = [*enumerate(ODD_TEXTS), (3, "again"), (3, "again"), (None, None), (None, "no id"), (None, "no id")]
    clashing = docs(*rows).withColumns({c: F.lit(9) for c in ("shard", "slot", "h", "place", "row", "part", "first", "n", "nth", "size")})
    found = sharding.shards(clashing, n_shards)
    assert found.columns.count("shard") == 1 and "place" in found.columns
    result = found.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in result) == sorted((i is None, i or 0, t or "") for i, t in rows)
    checked(result, n_shards)


def test_hot_group_is_cut_and_others_are_not(spark, docs):
    """Equal rows make up a third; other groups of copies stay together."""
    rows = [(None, "copy " * 20)] * 1500 + [(i, f"text {i // 3} " + "x" * (i // 3 * 7919 % 300)) for i in range(3000)]
    places = checked(sharding.shards(docs(*rows).repartition(7)).collect())
    assert len(places.pop("copy " * 20)) >= 3
    assert sum(len(p) > 1 for p in places.values()) <= 7


def test_small_parts_and_few_probes(spark, docs, monkeypatch):
    """Many rounds and many parts give the same law."""
    monkeypatch.setattr(sharding, "PROBES", 3)
    rows = [(i, f"{i} " * (1 + i % 50)) for i in range(2000)]
    found = sharding.shards(docs(*rows), part_bytes=1000).collect()
    assert sorted(r.doc_id for r in found) == list(range(2000))
    checked(found)


def test_no_rows(spark, docs):
    assert sharding.shards(docs()).collect() == []


def test_written_shards(spark, docs, tmp_path):
    sharding.write_shards(docs(*[(i, f"text {i}") for i in range(200)]), f"file://{tmp_path}/shards", 4)
    back = spark.read.parquet(f"file://{tmp_path}/shards")
    assert sorted(r.doc_id for r in back.collect()) == list(range(200))
    checked(back.collect(), 4)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = queries.queries()["op13_sharding"](spark, sf_dir)
    assert found.dtypes == [
        ("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")
    ]
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = found.join(texts, "doc_id").collect()
    assert len(rows) == texts.count()
    checked(rows)
