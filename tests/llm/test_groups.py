"""SimHash, vectors and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronicle.llm import components, embedding_dedup, simhash
from chronicle.llm.kernels import roots_of

from .conftest import ODD_TEXTS


def grouped(n, links):
    root = roots_of(n, *np.array(sorted(links) or [(0, 0)]).T)
    return root.tolist()


def test_components(spark):
    random.seed(2)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(7, i) for i in range(200, 400)]
    links = chain + star + [(5, 5), (None, 3), (3, 3)] + [(random.randint(500, 900), random.randint(500, 900)) for _ in range(300)]
    got = components.connected_components(spark.createDataFrame(links * 2, "a long, b long")).collect()
    plain = [(a, b) for a, b in links if a is not None and a != b]
    root = grouped(1000, plain)
    assert {(r.node, r.component) for r in got} == {(n, root[n]) for p in plain for n in p}
    assert len(got) == len({n for p in plain for n in p})
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, docs):
    rows = docs(*enumerate(t for t in ODD_TEXTS if t is None or len(t) < 9000), (90, "A b C"), (91, "a B c"), (92, "ÄB c d e"))
    for r in simhash.fingerprints(rows).collect():
        assert r.fp % (1 << 64) == plain_fingerprint(r.text)


@pytest.mark.parametrize("rows_in_task", [4, 512])
def test_fingerprint_links(spark, monkeypatch, rows_in_task):
    """Clusters around a few centres; with small tasks every hot node is split again and again."""
    monkeypatch.setattr(simhash, "NODE_ROWS", rows_in_task)
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 64)
    rng = random.Random(4)
    prints = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            p = centre
            for _ in range(rng.randint(0, 4)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    prints = sorted(prints)
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    points = [(p - (1 << 64) if p >> 63 else p, n) for n, p in enumerate(prints)]
    found = simhash.fingerprint_links(spark.createDataFrame(points, "fp long, node long"))
    got = [(r.a, r.b) for r in found.collect()]
    assert grouped(len(prints), got) == grouped(len(prints), links)
    assert set(grouped(len(prints), links)) != set(range(len(prints)))


def test_near_duplicate_documents(spark, docs):
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w77 ", "z77 ")
    rows = docs(
        (5, base), (3, base.upper()), (9, near), (4, "other text"), (8, None), (2, ""), (None, base), (None, "lonely one"), (4, "other text")
    ).withColumn("fp", F.lit("clash")).withColumn("node", F.lit(1))
    got = [(r.doc_id, r.component_id, r.kept) for r in simhash.near_duplicates(rows).collect()]
    bits = (plain_fingerprint(base) ^ plain_fingerprint(near)).bit_count()
    nine = 3 if bits <= 3 else 9
    expected = [(5, 3, False), (3, 3, True), (9, nine, nine == 9), (4, 4, True), (8, 2, False), (2, 2, True), (None, 3, False), (None, None, False), (4, 4, True)]
    assert sorted(got, key=str) == sorted(expected, key=str)
    stays = simhash.one_of_each(rows)
    assert stays.columns == rows.columns
    assert sorted((r.doc_id for r in stays.collect()), key=str) == sorted({3, 4, 2, nine} - {None} | ({9} if nine == 9 else set()), key=str) + [None]
    assert simhash.one_of_each(docs().limit(0)).count() == 0


def brute_vectors(rows):
    usable = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[i] = np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    ids = sorted({i for i, _ in rows})
    links = [(a, b) for a in usable for b in usable if a != b and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= 0.9]
    root = grouped(max(ids) + 1, links)
    return {(i, sum(a == i for a, _ in links), root[i], root[i] == i) for i in ids}


def test_vectors(spark, monkeypatch):
    """Copies, a dense group larger than window, chunk and block, odd vectors and lengths."""
    monkeypatch.setattr(embedding_dedup, "CHUNK_ROWS", 40)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 100)
    monkeypatch.setattr(embedding_dedup, "BUCKET_ROWS", 200)
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(16)
    dense = [centre + 0.1 * rng.standard_normal(16) for _ in range(150)]
    spread = list(rng.standard_normal((200, 16)))
    copies = [spread[0]] * 60
    rows = [(n, [float(np.float32(x)) for x in v]) for n, v in enumerate(dense + spread + copies, 10)]
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [float("nan")] * 16), (5, [float("inf")] + [1.0] * 15), (6, [None] + [1.0] * 15), (7, [1.0, 2.0]), (8, [2.0, 4.0])]
    frame = spark.createDataFrame(rows + [rows[0], (None, [1.0] * 16)], "vec_id long, embedding array<float>").withColumn("node", F.lit(0))
    got = embedding_dedup.near_duplicates(frame, window=8).collect()
    assert {tuple(r) for r in got} == brute_vectors(rows) and len(got) == len(rows)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_duplicates(none).count() == 0


def test_passes_grow_with_the_table():
    assert embedding_dedup.n_passes(10, 0.9, 32, 0.95) == 1
    assert 5 < embedding_dedup.n_passes(10_000, 0.9, 32, 0.95) < embedding_dedup.n_passes(10**9, 0.9, 32, 0.95)


@pytest.mark.parametrize("crowd_rows", [300, 8])
def test_pairs_in_a_crowded_cone(spark, monkeypatch, crowd_rows):
    """A third of the vectors is similar below the threshold; with chunks of 8 further passes are the cheaper way."""
    monkeypatch.setattr(embedding_dedup, "CROWD_ROWS", crowd_rows)
    rng = np.random.default_rng(5)

    def unit(v):
        return v / np.linalg.norm(v, axis=-1, keepdims=True)

    centre = unit(rng.standard_normal(64))
    away = rng.standard_normal((1000, 64))
    away = unit(away - (away @ centre)[:, None] * centre)
    cone = 0.78**0.5 * centre + 0.22**0.5 * away
    beside = rng.standard_normal((100, 64))
    beside = unit(beside - np.sum(beside * cone[:100], 1, keepdims=True) * cone[:100])
    vectors = np.concatenate((unit(rng.standard_normal((2000, 64))), cone, 0.93 * cone[:100] + (1 - 0.93**2) ** 0.5 * beside)).astype(np.float32)
    near = np.argwhere(np.triu(unit(vectors.astype(np.float64)) @ unit(vectors.astype(np.float64)).T >= 0.9, 1))
    assert 100 <= len(near) < 300
    rows = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.component_id for r in embedding_dedup.near_duplicates(rows).collect()}
    assert sum(got[a] == got[b] for a, b in near.tolist()) >= embedding_dedup.RECALL * len(near)


def test_only_crowded_vectors_take_further_passes(spark, monkeypatch):
    """Cones of different width: each round takes what the rounds before it have left, and never more passes than those."""
    monkeypatch.setattr(embedding_dedup, "CROWD_ROWS", 2)
    rounds, plain = [], embedding_dedup._passes

    def passes(classes, turn, *rest):
        rounds.append((turn, {r.node for r in classes.select("node").collect()}))
        return plain(classes, turn, *rest)

    monkeypatch.setattr(embedding_dedup, "_passes", passes)
    rng = np.random.default_rng(8)
    vectors, near = list(rng.standard_normal((600, 48))), []
    for cosine in (0.5, 0.75, 0.87):
        centre = rng.standard_normal(48)
        centre /= np.linalg.norm(centre)
        away = rng.standard_normal((250, 48))
        away /= np.linalg.norm(away, axis=1, keepdims=True)
        vectors += list(cosine**0.5 * centre + (1 - cosine) ** 0.5 * away)
    for n in range(600, len(vectors), 10):
        near.append((n, len(vectors)))
        vectors.append(vectors[n] + 0.3 * np.linalg.norm(vectors[n]) / 48**0.5 * rng.standard_normal(48))
    classes = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(vectors)], "node long, embedding array<double>")
    found = {(r.a, r.b) for r in embedding_dedup.projection_links(classes).collect()}
    root = grouped(len(vectors), found)
    units = np.array([v / np.linalg.norm(v) for v in vectors])
    near = [(a, b) for a, b in near if units[a] @ units[b] >= 0.9]
    assert len(near) > 60 and sum(root[a] == root[b] for a, b in near) >= embedding_dedup.RECALL * len(near)
    assert len(rounds) > 2
    for (turn, rows), (later, fewer) in zip(rounds, rounds[1:]):
        assert later.start == turn.stop and len(later) <= turn.stop and fewer < rows


def test_depths_are_shared_signs():
    keys = np.sort(np.array([0, 1, 5, (1 << 62) + 3, (1 << 62) + 2, (1 << 62) + (1 << 31), 5], np.int64))
    shared = [63 - (int(a) ^ int(b)).bit_length() for a, b in zip(keys, keys[2:])]
    assert embedding_dedup._depths(keys, 2).tolist() == [1 + max(a, b) for a, b in zip([*shared, 0, 0], [0, 0, *shared])]
    assert embedding_dedup._depths(keys, 7).tolist() == [0] * 7


def test_one_row_of_each_group(spark, docs):
    """No text is lost to a shared id, and copies fall together whatever their ids."""
    rows = [(1, "a b c d e"), (1, "p q r s t"), (2, "v w x y z"), (None, "k l m n o"), (None, "k l m n o"), (None, "K  l m n o")]
    rows += [(5, "a b c d e"), (0, "v w x y z"), (6, "once more"), (6, "once more"), (7, None), (None, "")]
    frame = docs(*rows).withColumns({"fp": F.lit(1), "grp": F.lit(2), "row": F.lit("x"), "h1": F.lit(3)})
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1, (r.text or "").lower().replace("  ", " ")) for r in kept.collect())
    assert got == [(-1, "k l m n o"), (0, "v w x y z"), (1, "a b c d e"), (1, "p q r s t"), (6, "once more"), (7, "")]
    groups = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(frame).collect()}
    assert sorted({c for (i, _), c in groups.items() if i == 1}) == [1] and {c for (i, _), c in groups.items() if i in (2, 0)} == {0}
    assert simhash.one_of_each(frame.limit(0)).count() == 0
