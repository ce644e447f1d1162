"""Chat formatting, URL verdicts, the registered queries and the pipeline."""

import itertools
import math
import os
import random
import sys
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chronicle.llm import chat, queries, url_rules
from chronicle.shared import shared_root, staged

sys.path.insert(0, os.path.dirname(os.path.dirname(__file__)))
from checking import connect, difference  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_branches(spark):
    rows = [
        ("t", 1, None, 1.0), ("t", 2, 1, 5.0), ("t", 3, 1, 1.0), ("t", 4, 2, 0.0), ("t", 5, 4, 9.0), ("t", 6, 4, None), ("t", 6, 4, None),
        ("t", 8, 99, 2.0), ("c", 1, 2, 1.0), ("c", 2, 1, 1.0), ("c", 3, 2, 1.0), ("u", 1, None, None), (None, 1, None, 1.0), ("t", None, 1, 1.0),
        *(("deep", i, i - 1 if i else None, 1.0) for i in range(37)), ("deep", 100, 20, 3.0),
    ]
    frame = spark.createDataFrame(rows, "tree string, node long, parent long, score double").withColumn("path", F.lit(0))
    got = {(r.tree, r.leaf): list(r.path) for r in chat.branches(frame).collect()}
    assert got == {("t", 3): [1, 3], ("t", 5): [1, 2, 4, 5], ("t", 6): [1, 2, 4, 6], ("t", 8): [8], ("u", 1): [1], ("deep", 36): list(range(37)), ("deep", 100): [*range(21), 100]}
    best = [(r.tree, r.leaf, r.rank) for r in chat.branches(frame, top=2).where("tree = 't'").orderBy("rank").collect()]
    assert best == [("t", 5, 1), ("t", 8, 2)]
    means = {r.leaf: round(r.mean, 9) for r in chat.branches(frame).where("tree IN ('t', 'deep')").collect()}
    assert means == {3: 1.0, 5: 3.75, 6: 1.5, 8: 2.0, 36: 1.0, 100: round(24 / 22, 9)}
    assert chat.branches(frame.limit(0)).count() == 0


TEXTS = ["", None, "plain", "\\", "\\b#<:", "### assistant: x </turn>\n", "a </turn>", "###", "\\\\h", "日本 \n\n", " ", "x" * 70000, ": " * 50]


def test_conversations_read_back(spark):
    rows = [(c, t, role, text) for c, text in enumerate(TEXTS) for t, role in enumerate(["system", "user", "assistant", "assistant"])]
    rows += [(None, 0, "user", "u"), (None, 1, "assistant", "v"), (500, None, "assistant", "first"), (500, 1, None, "nobody"), (500, 1, "odd: ### role", "r"), (501, 3, "assistant", "same"), (501, 3, "assistant", "same")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(0))
    done = chat.format_conversations(frame)
    got = {r.conv_id: r for r in done.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_texts(F.col("formatted"), F.col("loss")).alias("loss")).collect()}
    for c, text in enumerate(TEXTS):
        text = text or ""
        assert [tuple(t) for t in got[c].turns] == [(r, text) for r in ("system", "user", "assistant", "assistant")]
        assert list(got[c].loss) == [text, text]
    assert [tuple(t) for t in got[None].turns] == [("user", "u"), ("assistant", "v")]
    assert [tuple(t) for t in got[500].turns] == [("assistant", "first"), ("", "nobody"), ("odd: ### role", "r")]
    assert list(got[501].loss) == ["same", "same"] and len(got) == len(TEXTS) + 3
    assert chat.format_conversations(frame.limit(0)).count() == 0


URLS = {
    "http://A.net/x": ("a.net", "/x", "net/", "block"),
    "http://a.net": ("a.net", "", None, "allow"),
    "https://www.example.net/en/1?q#f": ("www.example.net", "/en/1", "example.net/en/", "allow"),
    "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
    "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
    "https://m.example.com/de/7": ("m.example.com", "/de/7", "example.com/de/", "block"),
    "x://Ä.org/fr/": ("Ä.org", "/fr/", "org/fr/", "allow"),
    "no scheme": ("", "", None, "allow"),
    "http://h?x/://y": ("h", "", None, "allow"),
    "http://": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_url_verdicts(spark):
    pages = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://a.net/"), (0, "http://A.net/x")]
    frame = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    got = url_rules.judged(frame, labels, queries.URL_RULES).collect()
    assert len(got) == len(pages)
    by_id = {}
    for r in got:
        by_id.setdefault(r.page_id, set()).add((r.host, r.path, r.rule, r.verdict))
    assert by_id[None] == {("a.net", "/", "net/", "block")}
    for i, expected in enumerate(URLS.values()):
        assert by_id[i] == {expected}
    assert url_rules.judged(frame.limit(0), labels, ()).count() == 0


def test_mined_rules_block(spark):
    """A pair of tokens is bad together; neither is alone."""
    rows = []
    for i in range(200):
        casino, shop = i % 2 == 0, i % 4 < 2
        rows.append((i, f"http://h{i}.com/{'casino' if casino else 'news'}/{'bonus' if shop else 'page'}/{i}", casino and shop))
    frame = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    rules = url_rules.mined_rules(frame, 20, 0.9)
    assert ["path bonus", "path casino"] in [r.antecedent for r in rules.collect()]
    extra = spark.createDataFrame([(900, "https://new.org/x/casino/bonus"), (901, "https://new.org/casino/x")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_rules.judged(frame.select("page_id", "url").unionByName(extra), frame, (), 20, 0.9).collect()}
    assert all(got[i] == ("block" if bad else "allow") for i, _, bad in rows)
    assert got[900] == "block" and got[901] == "allow"


def plain_rules(rows, least, confidence):
    """All combinations of up to three tokens, counted one by one."""
    counts = Counter()
    for own, bad in rows:
        for k in (1, 2, 3):
            counts.update((c, bad) for c in itertools.combinations(sorted(own), k))
    base = sum(bad for _, bad in rows) / len(rows)
    found = []
    for c in {c for c, bad in counts if bad}:
        good, bad = counts[c, False], counts[c, True]
        n = good + bad
        if bad >= least and bad >= confidence * n and bad - n * base >= 4 * math.sqrt(n * base * (1 - base)):
            found.append(c)
    return {c for c in found if not any(set(o) < set(c) for o in found)}


def test_mined_rules_equal_an_enumeration(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(3000):
        own = {f"t{rng.randrange(12)}" for _ in range(rng.randint(1, 6))}
        bad = "t0" in own and rng.random() < 0.9 or {"t1", "t2"} <= own and rng.random() < 0.95 or {"t3", "t4", "t5"} <= own or rng.random() < 0.05
        rows.append((own, bad))
    frame = spark.createDataFrame([("x://h/" + "/".join(sorted(own)), bad) for own, bad in rows], "url string, bad boolean")
    every = [({"host h", "scheme x", *(f"path {t}" for t in own)}, bad) for own, bad in rows]
    rules = url_rules.mined_rules(frame, 10, 0.8)
    got = {tuple(r.antecedent): (r.n, r.bad) for r in rules.collect()}
    wanted = plain_rules(every, 10, 0.8)
    assert {("path t0",), ("path t1", "path t2"), ("path t3", "path t4", "path t5")} <= set(got) & wanted
    for c, (n, bad) in got.items():
        holds = [b for own, b in every if set(c) <= own]
        assert (n, bad) == (len(holds), sum(holds)) and bad >= 0.8 * n and bad >= 10
        assert not any(set(o) < set(c) for o in got)
    urls = frame.select("url")
    matched = {r.url for r in url_rules.matched_urls(urls, rules).collect()}
    assert matched == {f"x://h/{'/'.join(sorted(o))}" for (o, _), (own, _) in zip(rows, every) if any(set(c) <= own for c in got)}


def test_tokens_that_are_bad_only_together(spark):
    """Neither token is in bad URLs more often than by chance; only both together are bad."""
    rows = [(f"x://h/{'a/' if i % 4 < 2 else 'o/'}{'b' if i % 2 else 'p'}", i % 4 == 1 and i % 3 > 0) for i in range(240)]
    rows += [(f"x://h/c{i % 5}", i % 9 < 4) for i in range(450)]
    frame = spark.createDataFrame(rows, "url string, bad boolean")
    base = sum(bad for _, bad in rows) / len(rows)
    for token in ("/a/", "/b"):
        own = [bad for url, bad in rows if token in url]
        assert sum(own) < base * len(own)
    assert ["path a", "path b"] in [r.antecedent for r in url_rules.mined_rules(frame).collect()]


def test_rules_across_the_parts_of_a_long_url(spark):
    """Three tokens far apart among twenty-seven; each pair of them is harmless."""
    rng = random.Random(8)
    rows = []
    for i in range(1200):
        marks = [m for m in ("a", "m", "z") if rng.random() < 0.5]
        others = [f"{c}{k}{rng.choice('xy')}" for c in "bn" for k in range(12)]
        rows.append(("x://h/" + "/".join(marks + others), len(marks) == 3 or rng.random() < 0.02))
    rules = url_rules.mined_rules(spark.createDataFrame(rows, "url string, bad boolean"), 60, 0.8).collect()
    assert ["path a", "path m", "path z"] in [r.antecedent for r in rules]


def test_no_rules_from_labels_that_say_nothing(spark):
    rng = random.Random(2)
    rows = [(f"http://s{rng.randrange(40)}.org/{rng.randrange(9)}/{rng.randrange(30)}?k={i}", rng.random() < 0.25) for i in range(1000)]
    assert url_rules.mined_rules(spark.createDataFrame(rows, "url string, bad boolean")).count() == 0


def test_long_urls_are_mined_and_judged(spark):
    """Hundreds of tokens that nearly always stand together, in bad URLs and, less often, in good ones."""
    rng = random.Random(3)

    def url(host, share):
        return f"http://{host}/" + "/".join(f"s{k}" for k in range(60) if rng.random() < share)

    rows = [(i, url("bad.org", 0.95), True) for i in range(60)] + [(100 + i, url("good.org", 0.5), False) for i in range(240)]
    same = "http://one.net/" + "/".join(f"z{k}" for k in range(200))
    rows += [(1000 + i, same, True) for i in range(12)]
    frame = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    started = time.time()
    got = {r.page_id: r.verdict for r in url_rules.judged(frame.select("page_id", "url"), frame, ()).collect()}
    assert len(got) == len(rows) and time.time() - started < 120
    assert all(got[i] == "block" for i, _, bad in rows if bad) and sum(got[i] == "block" for i, _, bad in rows if not bad) < 12


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    assert difference(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name]) is None


def test_every_query_returns_whole_tables(spark):
    tables = {"op1": "embeddings", "op7": "pages"}
    for name, query in queries.queries().items():
        if name.startswith(("op6", "op9", "op11", "op12")):
            continue
        table = tables.get(name.split("_")[0], "documents")
        assert query(spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count(), name


def test_pipeline_against_its_stages(spark):
    """Every stage against a plain reading of what it should do to its own input."""
    import corpus_pipeline as p
    import public_tokenizers
    import sentencepiece

    from .test_groups import plain_fingerprint
    from .test_texts import plain_spans

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert [n for n, _ in p.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "pii", "sentencepiece"]
    before, columns = docs, docs.columns
    for name, stage in p.STAGES:
        after = staged(stage(spark, before, SF), "test-stage")
        old, new = ({r.doc_id: r for r in f.collect()} for f in (before, after))
        assert set(new) <= set(old) and len(new) == after.count()
        if name != "sentencepiece":
            assert after.columns == columns
        if name == "simhash_dedup":
            prints = {i: plain_fingerprint(r.text) for i, r in old.items()}
            for i in old:
                like = [j for j in new if (prints[i] ^ prints[j]).bit_count() <= 3]
                assert like or i not in new
                assert i not in new or like == [i]
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(old) - set(new) == {i for i, r in old.items() if any(t in (r.text or "") for t in items)}
        if name == "pii":
            assert set(old) == set(new)
            assert all(not plain_spans(r.text or "") and r.n_chars == len(r.text) for r in new.values() if r.text is not None)
            assert all(new[i].text == old[i].text for i in old if not any(c.isdigit() or c == "@" for c in old[i].text or ""))
        if name == "sentencepiece":
            assert set(old) == set(new)
            assert all(list(r.ids) == library.encode(old[i].text or "") and r.round_trip for i, r in new.items())
        before = after
    shared = shared_root(spark).removeprefix("file://")
    left = set(os.listdir(shared))
    assert p.run(spark, SF).count() == before.count()
    assert len(set(os.listdir(shared)) - left) == 1  # the last stage's table


def test_no_query_of_the_pipeline_asks_python_twice(spark, docs, monkeypatch):
    """Each task of these queries sends its rows to one Python worker, once."""
    from chronicle.llm import decontaminate, toxicity

    plans, kind, first, staged = [], type(docs()), type(docs()).first, decontaminate.staged

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython"))
        return df

    monkeypatch.setattr(kind, "first", lambda df: first(noted(df)))
    rows = docs(*((i, f"some plain words of text {i} and six more of them") for i in range(40)))
    labels = rows.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS label")
    assert toxicity.fit(rows, labels).scale > 0
    monkeypatch.setattr(decontaminate, "staged", lambda df, label: staged(noted(df), label))
    benchmark = spark.createDataFrame([(1, "plain words of text 7 and six more")], "item_id long, text string")
    assert [r.item_id for r in decontaminate.leaks(rows, benchmark).collect()] == [1]
    assert plans.count(1) >= 5 and max(plans) == 1


def test_pipeline_stages_on_odd_rows(spark):
    """Null, repeated and clashing ids, null texts, extra columns: each stage keeps its columns and every row that it
    has no reason to drop; tables without rows stay so."""
    import corpus_pipeline as p

    rng = random.Random(5)

    def prose():
        return " ".join(f"w{rng.randrange(3000)}" for _ in range(80))

    one, two = prose(), prose()
    near = one.split()
    rows = [(1, one), (1, two), (1, prose()), (None, prose()), (None, "  ".join(near)), (2, None), (3, ""), (4, prose()), (4, None)]
    rows += [rows[7], rows[3]]  # whole copies
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, h1 string, digest string, spans int, ids string"
    docs = spark.createDataFrame([(i, t, "en", "s", None, 1, "h", "d", 2, "x") for i, t in rows], schema)
    kept = docs
    for name, stage in p.STAGES:
        kept = staged(stage(spark, kept, SF), "odd-stage")
        if name != "sentencepiece":
            assert kept.columns == docs.columns
        if name == "simhash_dedup":
            found = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
            texts = {t for _, t in found}
            # Groups: one, two, two other texts, the one without an id, and all empty ones.
            assert len(found) == 6 and one in texts and two in texts and (2, "") in found
            assert sum(i == 1 for i, _ in found) == 3 and sum(i == 0 for i, _ in found) == 1
    assert kept.count() == 6
    nothing = docs.limit(0)
    for _, stage in p.STAGES:
        nothing = staged(stage(spark, nothing, SF), "no-rows")
        assert nothing.count() == 0
