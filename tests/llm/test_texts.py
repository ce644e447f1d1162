"""Toxic passages, benchmark passages, personal data and quality."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronicle.llm import decontaminate, pii, quality, toxicity
from chronicle.llm.kernels import Words

from .conftest import ODD_TEXTS

SF = "/root/testdata/sf0.01"


def test_words():
    texts = [None, "", "Ein Wort, zwei—WÖRTER…", "a·b\u00a0c", "x"]
    words = Words(pa.array(texts, pa.string()))
    assert words.counts.tolist() == [0, 0, 4, 3, 1]
    assert words.words().to_pylist() == ["ein", "wort", "zwei", "wörter", "a", "b", "c", "x"]
    assert len(set(words.hashes.tolist())) == 8
    again = Words(pa.array(["b x"]))
    assert again.hashes.tolist() == [words.hashes[5], words.hashes[7]]


def maximal_runs(scores):
    """By definition: runs whose proper prefixes and suffixes all sum above zero, and that lie in no longer such run."""
    good = []
    for a, b in itertools.combinations(range(len(scores) + 1), 2):
        run = scores[a:b]
        ahead, behind = list(itertools.accumulate(run)), list(itertools.accumulate(run[::-1]))
        if min(ahead) > 0 and min(behind) > 0:
            good.append((a, b - 1, sum(run)))
    return [x for x in good if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in good)]


def test_all_segments_against_the_definition():
    """Ties, zeros and negative scores of any size; several texts in one slice."""
    rng = random.Random(3)
    for _ in range(300):
        texts = [[rng.choice([3.0, 1.5, 0.5, 0.0, -0.5, -1.0, -2.5]) for _ in range(rng.randint(0, 14))] for _ in range(4)]
        row_starts = np.cumsum([0] + [len(t) for t in texts])
        columns = toxicity.stretches(np.array(sum(texts, [])), row_starts)
        bounds = np.searchsorted(columns[0], row_starts)
        for row, scores in enumerate(texts):
            own = [c[bounds[row] : bounds[row + 1]].tolist() for c in columns]
            found = [(a - row_starts[row], b - row_starts[row], s) for a, b, s in toxicity.segments(*own)]
            assert found == maximal_runs(scores)


def test_scores_against_brute_force(spark, docs):
    """Passages and scores of whole texts, from the model's log-odds by the definition alone."""
    rows, labels = labelled(spark)
    model = toxicity.fit(docs(*rows), labels)
    odds = dict(zip(model.words.to_pylist(), model.odds.tolist()))
    assert min(odds.values()) < 0 < max(odds.values())
    for r in toxicity.scored(docs(*rows[:24], (-1, None), (-2, "")), model).collect():
        words = (r.text or "").split()
        base = math.log(model.scale * max(len(words), 1))
        runs = maximal_runs([odds.get(w, 0.0) - model.drift for w in words])
        runs = [x for x in runs if 1 - math.exp(-math.exp(base - model.rate * x[2])) <= toxicity.SIGNIFICANCE]
        assert [(p.first, p.last) for p in r.passages] == [x[:2] for x in runs]
        evidence = sum(model.rate * x[2] - base for x in runs)
        assert r.score == pytest.approx(1 / (1 + math.exp(-model.intercept - model.slope * math.log1p(evidence))))


def labelled(spark, n=120):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(5, 200))]
        if i % 4 == 0:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "rotten"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return rows, spark.createDataFrame(labels, "doc_id long, label int")


def test_toxicity(spark, docs):
    rows, labels = labelled(spark)
    model = toxicity.fit(docs(*rows), labels)
    assert sorted(w for w, x in zip(model.words.to_pylist(), model.odds) if x > model.drift + 0.5) == ["rotten", "vile"]
    odd = docs(*enumerate(ODD_TEXTS, 1000), (None, "a vile rotten vile thing"), (7, "vile rotten vile"), (7, "vile rotten vile"))
    odd = odd.withColumnRenamed("lang", "score")
    got = toxicity.scored(odd, model).collect()
    assert len(got) == len(ODD_TEXTS) + 3
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.predicted == int("vile" in (r.text or "")) and bool(r.passages) == bool(r.predicted)
    named = next(r for r in got if r.doc_id is None)
    assert [(p.first, p.last) for p in named.passages] == [(1, 3)]
    empty = toxicity.fit(docs().limit(0), labels.limit(0))
    assert {r.score for r in toxicity.scored(odd, empty).collect()} == {0.5}


def test_toxicity_on_held_out_documents(spark):
    from chronicle.llm import queries

    got = queries.op4_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    toxic, clean = got[got.toxic == 1].score.values, got[got.toxic == 0].score.values
    assert np.mean(toxic[:, None] > clean) + np.mean(toxic[:, None] == clean) / 2 > 0.75


def passages(n=6, words=24):
    rng = random.Random(9)
    return [[f"b{rng.randint(0, 4000)}" for _ in range(words)] for _ in range(n)]


def test_benchmark_passages(spark, docs):
    items = passages()
    filler = [f"f{i}" for i in range(300)]
    swapped = items[1][12:] + filler[:20] + items[1][:12]
    partly = items[2][:15] + filler[:9]
    rows = docs(
        (1, " ".join(filler[:50] + items[0] + filler[50:])),
        (2, " ".join(filler + swapped)),
        (3, " ".join(partly)),
        (4, " ".join(filler)),
        (5, ", ".join(w.upper() for w in items[3]) + "!"),
        (6, " ".join((items[4] + filler[:3]) * 40)),
        (7, "just three words"),
        (8, "more than just three words"),
        (None, " ".join(items[5])),
        (1, " ".join(items[0])),
        *enumerate(ODD_TEXTS, 100),
    ).withColumn("leak", F.lit(1))
    texts = [(i, " ".join(w)) for i, w in enumerate(items)] + [(50, "Just three words."), (51, None), (52, ""), (None, "x")]
    benchmark = spark.createDataFrame(texts, "item_id long, text string")
    got = decontaminate.contaminated_pairs(rows, benchmark)
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.n_tiles) for r in got.collect())
    assert found == [(-1, 5, 1), (1, 0, 1), (1, 0, 1), (2, 1, 2), (5, 3, 1), (6, 4, 1), (7, 50, 1), (8, 50, 1)]
    small = decontaminate.contaminated_pairs(rows, benchmark, bits=6)  # a filter that lets nearly all through
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.n_tiles) for r in small.collect()) == found
    clean = decontaminate.clean_documents(rows, benchmark)
    assert clean.columns == rows.columns and clean.count() == rows.count() - len(found)
    assert decontaminate.clean_documents(rows, benchmark.limit(0)).count() == rows.count()
    assert decontaminate.contaminated_pairs(docs().limit(0), benchmark).count() == 0


PATTERNS = [
    re.compile(p)
    for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def plain_luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == 0
                or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                or kind == 2 and 13 <= len(digits) <= 19 and plain_luhn(digits)
                or kind == 3 and 9 <= len(digits) <= 15
            ):
                found.append((kind, *m.span()))
    return found


def test_base_spans_against_plain_patterns():
    rng = random.Random(3)
    for alphabet, n in (("a@.-+1 ", 30), ("a@.b", 20), ("1. 2", 40), ("4 -0+()", 60), ("+1234567890 -().", 40)):
        for _ in range(4000):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, n)))
            assert pii.base_spans(text) == plain_spans(text), text
    long = "1" * 200_000 + "@" + "a." * 100_000
    assert pii.base_spans(long) is not None  # linear on long runs


def test_personal_data(spark, docs):
    good, other = "4539578763621486", "4539-5787-6362-1486"
    rows = docs(
        *((i, f"mail a{i}@b.com card {good} or {i}.2.3.4 call +49 30 1234567{i}") for i in range(40)),
        (90, f"ref 4539.5787.6362.1486 and {good} end"),
        (None, "me@x.org"),
        (91, other),
        *enumerate(ODD_TEXTS, 100),
    ).withColumn("base", F.lit(1))
    field = pii.fit(rows)
    got = pii.with_spans(rows, field)
    by_id = {r.doc_id: r for r in got.collect()}
    for r in by_id.values():
        kinds = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.spans if s.base]
        assert kinds == plain_spans(r.text or "") and kinds == sorted(kinds)
    added = [(s.kind, by_id[90].text[s.start : s.end]) for s in by_id[90].spans if not s.base]
    assert added == [("card", "4539.5787.6362.1486")]
    hidden = {r.doc_id: r.hidden for r in got.select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("hidden")).collect()}
    assert hidden[90] == "ref [CARD] and [CARD] end" and hidden[None] == "[EMAIL]" and hidden[100] is None and hidden[101] == ""
    assert pii.with_spans(docs().limit(0), pii.fit(docs().limit(0))).count() == 0


def test_rare_shapes_keep_their_counts(spark, docs):
    """A field that holds one shape itself finds what one that holds them all does."""
    cards = [n for n in range(4539578763621400, 4539578763621900) if pii.luhn(str(n))][:40]
    rows = docs(
        *((i, f"in 19{i} and 18{i} and 17{i} card {n} of {i}") for i, n in enumerate(cards, 10)),
        (1, "card 4539578763621487 or x-1-2-3-4"),
        (1, "card 4539578763621487 or x-1-2-3-4"),
        (None, "card 4539578763621489"),
        (2, "plain 1999"),
        *enumerate(ODD_TEXTS, 100),
    ).withColumn("digest", F.lit("clash")).withColumn("a.b", F.lit(1))
    whole, small = pii.fit(rows), pii.fit(rows, max_shapes=1)
    assert whole.rare is None and len(small.shapes) == 1
    assert (whole.chain, whole.skip, whole.unseen.tolist()) == (small.chain, small.skip, small.unseen.tolist())
    expected, got = pii.with_spans(rows, whole), pii.with_spans(rows, small)
    assert got.columns == expected.columns and got.schema.simpleString() == expected.schema.simpleString()
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)
    added = [(r.doc_id, s.kind) for r in got.collect() for s in r.spans if not s.base]
    assert sorted(added, key=str) == [(1, "card"), (1, "card"), (None, "card")]


def test_data_is_covered_where_it_is_found(spark, docs):
    """The pipeline's stage finds and covers in one Python worker a task, with what the two operators by themselves give."""
    import corpus_pipeline as p

    cards = [n for n in range(4539578763621400, 4539578763621900) if pii.luhn(str(n))][:40]
    rows = docs(
        *((i, f"in 19{i} and 18{i} and 17{i} card {n} of {i}") for i, n in enumerate(cards, 10)),
        (1, "card 4539578763621487, mail a@b.com.a@b.com or x-1-2-3-4"),
        (1, "card 4539578763621487, mail a@b.com.a@b.com or x-1-2-3-4"),
        (None, "日本語 4539578763621489 " * 30000),
        *enumerate(ODD_TEXTS, 100),
    )
    for field in (pii.fit(rows), pii.fit(rows, max_shapes=1)):
        expected = pii.with_spans(rows, field).withColumn("hidden", pii.redacted(F.col("text"), F.col("spans")))
        got = pii.with_redacted(rows, field)
        assert got.schema.simpleString() == expected.schema.simpleString()
        assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)
        instead = pii.with_redacted(rows, field, hidden="text").select(*rows.columns)
        assert sorted(r.text or "" for r in instead.collect()) == sorted(r.hidden or "" for r in expected.collect())
    stage = p.without_personal_data(spark, rows, None)
    assert stage._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert stage.columns == rows.columns and all(r.n_chars == (None if r.text is None else len(r.text)) for r in stage.collect())


def test_marginals_on_a_tree_are_exact():
    rng = np.random.default_rng(0)
    unary, edges, gains = rng.standard_normal((4, 3)), [(0, 1), (1, 2), (1, 3)], np.array([1.0, 0.5, 2.0])
    total = np.zeros((4, 3))
    for labels in itertools.product(range(3), repeat=4):
        weight = np.exp(sum(unary[i, x] for i, x in enumerate(labels)) + sum(g for (a, b), g in zip(edges, gains) if labels[a] == labels[b]))
        for i, x in enumerate(labels):
            total[i, x] += weight
    assert np.allclose(pii.marginals(unary, edges, gains, 200), total / total.sum(axis=1, keepdims=True), atol=1e-3)


def test_evidence_crosses_a_long_text():
    """Along a chain, against sums over all labels of the tokens before and after."""
    unary = np.zeros((60, 5))
    unary[:, 0] = 0.001
    unary[0] = [-20, -20, -20, 0, -20]
    edge = np.ones((5, 5)) + np.eye(5) * np.expm1(6.0)
    ahead, behind = [np.ones(5)], [np.ones(5)]
    for near in range(59):
        ahead.append(edge @ (np.exp(unary[near]) * ahead[-1]))
        behind.append(edge @ (np.exp(unary[59 - near]) * behind[-1]))
    exact = np.exp(unary) * [a / a.sum() for a in ahead] * [b / b.sum() for b in behind[::-1]]
    exact /= exact.sum(axis=1, keepdims=True)
    got = pii.marginals(unary, [(i, i + 1) for i in range(59)], np.full(59, 6.0))
    assert np.allclose(got, exact, atol=0.01) and got[59].argmax() == 3


def test_messages_settle_on_loops():
    rng = np.random.default_rng(1)
    edges = [(i, j) for i in range(12) for j in range(i)]
    got = pii.marginals(rng.standard_normal((12, 5)), edges, np.full(len(edges), 6.0))
    assert np.isfinite(got).all() and np.allclose(got.sum(axis=1), 1)


def test_long_shapes_differ_behind_their_first_signs():
    long = "1-" * 50
    assert len(pii.shape(long + "1")) <= 64 and pii.shape(long + "22") == pii.shape(long + "33")
    assert len({pii.shape(long + end) for end in ("1", "22", "a", "@")}) == 4


def test_quality(spark, docs):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(200):
        bad = i % 5 == 0
        words = [f"w{rng.randint(0, 500)}" for _ in range(60)]
        rows.append((i, " $$$ ".join(words) if bad else " ".join(words)))
        labels.append((i, int(not bad)))
    frame = docs(*rows, *enumerate(ODD_TEXTS, 1000), (None, "plain words here"), (3, "again")).select("doc_id", "text", F.col("source").alias("host"), "lang")
    frame = frame.withColumn("path", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))).withColumn("evidence", F.lit("clash"))
    marks = spark.createDataFrame(labels, "doc_id long, good int")
    got = quality.scored(frame, marks).collect()
    assert len(got) == 200 + len(ODD_TEXTS) + 2 and all(0 <= r.score <= 1 and r.keep == (r.score >= 0.5) for r in got)
    known = {r.doc_id: r.keep for r in got if r.doc_id is not None and r.doc_id < 200 and r.doc_id != 3}
    assert all(known[i] == (i % 5 != 0) for i in known)
    assert {r.score for r in quality.scored(frame, marks.limit(0)).collect()} == {0.5}
    assert quality.scored(frame.limit(0), marks).count() == 0


def plain_measures(text):
    words, lines = re.findall("[a-z0-9]+", text.lower()), [x for x in text.split("\n") if x.strip()]
    signs = sum(not c.isalnum() and not c.isspace() for c in text)
    n = max(len(words), 1)
    repeats, top = sum(a == b for a, b in zip(words, words[1:])), max(map(words.count, words), default=0)
    return len(words), signs / max(len(text), 1), repeats / n, top / n, 1 - len(set(lines)) / len(lines) if lines else 0.0


def plain_strength(groups):
    """``groups`` are (good, n, expected rate): what the prior is worth, from the variance beyond chance."""
    over = sum((g - n * p) ** 2 - n * p * (1 - p) for g, n, p in groups)
    rho = min(max(over / sum(n * (n - 1) * p * (1 - p) for _, n, p in groups), 1e-6), 0.5)
    return 1 / rho - 1


def test_quality_against_brute_force(spark):
    """Bins, evidence and shrunk rates of a small table by plain loops; unlabelled sites and sections included."""
    rng = random.Random(11)
    rows, good = [], {}
    for i in range(160):
        host, path = f"h{i % 5}", f"p{rng.randint(0, 2)}"
        fine = rng.random() < 0.9 - 0.2 * (i % 5)
        words = [f"w{rng.randint(0, 40)}" for _ in range(rng.randint(1, 50))]
        text = (" " if fine else " # ").join(words) + ("" if fine else "\nsame line\nsame line")
        rows.append((i, text, host, path))
        if i % 4:
            good[i] = int(fine)
    rows += [(200, "not seen before", "other", "p0"), (201, "a new section", "h0", "p9"), (202, "", "h1", "p0")]
    got = quality.scored(
        spark.createDataFrame(rows, "doc_id long, text string, host string, path string"),
        spark.createDataFrame(list(good.items()), "doc_id long, good int"),
    )
    known = {i: (plain_measures(t), host, path) for i, t, host, path in rows}
    evidence = dict.fromkeys(known, 0.0)
    for m in range(5):
        values = sorted(known[i][0][m] for i in good)
        cuts = sorted({values[math.ceil(k * len(values) / 20) - 1] for k in range(1, 20)})
        bins = {i: sum(known[i][0][m] > c for c in cuts) for i in known}
        for i in known:
            same = [good[j] for j in good if bins[j] == bins[i]]
            if same:
                total, n = sum(good.values()), len(good)
                evidence[i] += math.log((sum(same) + 0.5) / (total + 10)) - math.log((len(same) - sum(same) + 0.5) / (n - total + 10))
    overall = (sum(good.values()) + 1) / (len(good) + 2)
    by_host, by_path = {}, {}
    for i, g in good.items():
        by_host.setdefault(known[i][1], []).append(g)
        by_path.setdefault(known[i][1:], []).append(g)
    worth = plain_strength([(sum(x), len(x), overall) for x in by_host.values()])
    hosts = {h: (sum(x) + worth * overall) / (len(x) + worth) for h, x in by_host.items()}
    worth = plain_strength([(sum(x), len(x), hosts[h]) for (h, _), x in by_path.items()])
    paths = {k: (sum(x) + worth * hosts[k[0]]) / (len(x) + worth) for k, x in by_path.items()}
    for r in got.collect():
        rate = paths.get(known[r.doc_id][1:], hosts.get(known[r.doc_id][1], overall))
        assert r.site_rate == pytest.approx(rate)
        assert r.evidence == pytest.approx(evidence[r.doc_id])
        assert r.score == pytest.approx(1 / (1 + math.exp(-evidence[r.doc_id]) * (1 - rate) / rate))
    assert got.count() == len(rows)


def test_sites_with_little_data_take_the_rate_above(spark):
    rows = [("big", "a", int(i % 10 > 0)) for i in range(1000)] + [("poor", "a", int(i % 10 == 0)) for i in range(1000)] + [("big", "new", 0)]
    hosts, paths, overall = quality.site_rates(spark.createDataFrame(rows, "host string, path string, good int"))
    hosts = {r.host: r.host_rate for r in hosts.collect()}
    paths = {(r.host, r.path): r.path_rate for r in paths.collect()}
    assert hosts["big"] > 0.85 and hosts["poor"] < 0.15 and 0.45 < overall < 0.55
    assert 0 < paths["big", "new"] < hosts["big"] and abs(paths["big", "a"] - 0.9) < 0.01
