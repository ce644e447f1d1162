"""Phrase growth against counting every phrase, and its registered query against SQL."""

import os
import random
import re
import sys
from collections import Counter

import pytest

from chronicle.llm import collocations, queries

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from checking import connect, difference  # noqa: E402

from .conftest import ODD_TEXTS  # noqa: E402


def plain(rows, top, least):
    """Every phrase counted, scored and sifted by hand."""
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            total[lang or "und"] += len(words)
            for k in range(1, 5):
                counts.update((lang or "und", words[i : i + k]) for i in range(len(words) - k + 1))
    able = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    hidden = set()
    for (lang, words), a in able.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inner = lang, words[i : i + k]
                if 100 * a >= 80 * able[inner]:
                    hidden.add(inner)
    found = []
    for lang, words in able.keys() - hidden:
        a = able[lang, words]
        cuts = [(2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        found.append((lang, -score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    result, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(result)


def texts(seed, n, vocabulary):
    """Words of uneven frequency, and a few passages that repeat whole or in part."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Ü", "ß", "a-b", "É"]
    passages = [[rng.choice(words) for _ in range(7)] for _ in range(6)]
    for _ in range(n):
        text = []
        for _ in range(rng.randint(0, 12)):
            text += rng.choice(passages)[rng.randint(0, 2) :] if rng.random() < 0.3 else [words[int(len(words) * rng.random() ** 3)]]
            text.append(rng.choice(["", "", "", ".", " ,", "\n", "\t", "  "]))
        yield " ".join(text).replace("w1", "W1"), rng.choice(["en", "de", None])


@pytest.mark.parametrize(("seed", "vocabulary", "top", "least"), [(1, 12, 4, 3), (2, 60, 3, 2), (3, 30, 1000, 2), (4, 25, 1, 5)])
def test_collocations(spark, monkeypatch, seed, vocabulary, top, least):
    """Small tops settle in several rounds; all agree with counting everything."""
    rows = [*texts(seed, 300, vocabulary), *((t, "odd") for t in ODD_TEXTS), ("x y x y x y x y", "und")]
    df = spark.createDataFrame([(t, g, 1, "p") for t, g in rows], "text string, lang string, a long, phrase string")
    got = collocations.collocations(df.repartition(5), top, least)
    assert sorted(map(tuple, got.collect())) == plain(rows, top, least)


def test_small_filters_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "FILTER_BITS", 7)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 100)
    rows = list(texts(5, 200, 20))
    got = collocations.collocations(spark.createDataFrame(rows, "text string, lang string"), 3, 2)
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, 2)


def test_growth_goes_only_where_the_bound_allows(spark, monkeypatch):
    """Of the pairs, those that begin with one of the two common words are not grown."""
    sizes = []
    marks = collocations._marks
    monkeypatch.setattr(collocations, "_marks", lambda rows, *a: sizes.append((a[0], rows.count())) or marks(rows, *a))
    rows = [("a b c d", "en")] * 50 + [(f"the w{i % 40} of v{i % 40}", "en") for i in range(2000)]
    got = collocations.collocations(spark.createDataFrame(rows, "text string, lang string"), 1, 30).collect()
    assert [(r.phrase, r.score) for r in got] == [("a b c d", 1_000_000)]
    frequent, grown = sizes[1][1], sizes[2][1]
    assert (frequent, grown) == (3 + 3 * 40, 3 + 40)


def test_no_documents(spark):
    assert collocations.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None), ("", "x")], "text string, lang string")).collect() == []


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    df = queries.queries()["op12_collocations"](spark, sf_dir)
    assert difference(df, connect(sf_dir), queries.oracle_sql()["op12_collocations"]) is None
