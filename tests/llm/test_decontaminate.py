"""Greedy string tiling against its plain definition, and hard inputs."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from chronicle.llm import decontaminate
from chronicle.llm.kernels import Words


def plain_tiles(text, item, size):
    """Again and again the longest match without marked words, the first in the item, then in the text."""
    used_text, used_item, found = [False] * len(text), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(text)):
                n = 0
                while i + n < len(item) and d + n < len(text) and item[i + n] == text[d + n] and not used_item[i + n] and not used_text[d + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < size:
            return found
        used_item[i : i + n], used_text[d : d + n] = [True] * n, [True] * n
        found.append((d, i, n))


def seeds_of(words, size):
    texts = Words(pa.array([" ".join(words)]))
    _, hash_, check, place = decontaminate._seeds(texts, size)
    return hash_.view(np.int64), check.view(np.int64), place


def tiles_of(text, item, size, share=0.0):
    own = decontaminate._TextSeeds(*seeds_of(text, size))
    return own.tiles(*seeds_of(item, size)[:2], len(item), size, share)


@pytest.mark.parametrize(("vocabulary", "size"), [(1, 3), (2, 3), (2, 5), (4, 2), (30, 2), (30, 5)])
def test_tiles_equal_the_definition(vocabulary, size):
    rng = random.Random(vocabulary * 10 + size)
    for _ in range(60):
        text = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(size, 60))]
        item = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(size, 40))]
        for _ in range(3):
            a, b = rng.randrange(len(item)), rng.randrange(len(text))
            text[b:b] = item[a : a + rng.randint(1, 15)]
        found = plain_tiles(text, item, size)
        coverage, n = tiles_of(text, item, size)
        assert (round(coverage * len(item)), n) == (sum(t[2] for t in found), len(found))


def test_repeated_words_end_soon():
    """Not a step for each pair of equal places."""
    started = time.time()
    assert tiles_of(["a"] * 200_000, ["a"] * 10_000, 5) == (1.0, 1)
    assert tiles_of(["a"] * 8_000, ["a"] * 10_000, 5) == (0.8, 1)
    broken = [w for i in range(4_000) for w in ["a"] * 49 + [f"b{i}"]]
    assert tiles_of(broken, ["a"] * 4_900, 5) == (1.0, 100)
    rng = random.Random(1)
    noise = [rng.choice("ab") for _ in range(100_000)]
    coverage, _ = tiles_of(noise, [rng.choice("ab") for _ in range(1_000)], 5)
    assert coverage > 0.9
    assert time.time() - started < 60


def pairs(spark, docs, texts, items, **options):
    rows = docs(*enumerate(texts))
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated_pairs(rows, benchmark, **options).collect())


def test_short_and_unspaced_items(spark, docs):
    texts = [
        "All know that Paris is capital, and more.",
        "paris is a capital",
        "他说：敏捷的棕色狐狸跳过了懒狗。然后离开了。",
        "敏捷的棕色狐狸",
        "ก่อน สวัสดีชาวโลกทั้งหลาย หลัง",
        "a word",
        "𠀀𠀁𠀂𠀃𠀄𠀅 x",
    ]
    items = ["Paris is capital", "敏捷的棕色狐狸跳过了懒狗", "สวัสดีชาวโลกทั้งหลาย", "word", "狐狸", "𠀀𠀁𠀂𠀃𠀄𠀅", "one two three four five six"]
    assert pairs(spark, docs, texts, items) == [(0, 0), (2, 1), (2, 4), (3, 4), (4, 2), (5, 3), (6, 5)]


def test_a_phrase_of_all_items_joins_nothing(spark, docs, monkeypatch):
    """Documents with the common phrase meet only the items that they hold."""
    phrase = "which of the following is the right answer to this"
    items = [f"{phrase} " + " ".join(f"q{i}x{k}" for k in range(12)) for i in range(60)]
    texts = [f"{phrase} question number {i} of mine" for i in range(200)] + [f"see {items[7]} there", items[9] + " " + items[7]]
    items += [items[3], items[3].upper()]  # the same words under other ids
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    own, names = decontaminate.benchmark_items(frame)
    assert own.count() == 60 and names.count() == 62
    index = decontaminate.item_index(own)
    assert index.groupBy("hash", "check").count().where("count > 1").count() == 0
    assert pairs(spark, docs, texts + [items[3]], items) == [(200, 7), (201, 7), (201, 9), (202, 3), (202, 60), (202, 61)]


def test_items_made_of_common_phrases_are_found(spark, docs, monkeypatch):
    """Where all seeds of an item are common, enough of them stay in the index; many items a text go in groups."""
    monkeypatch.setattr(decontaminate, "GROUP_ITEMS", 4)
    rng = random.Random(3)
    blocks = [" ".join(f"b{k}w{j}" for j in range(6)) for k in range(6)]
    items = [" ".join(rng.sample(blocks, 3)) for _ in range(40)]
    texts = [" ".join(rng.sample(blocks, n)) + " tail" for n in (1, 2, 3, 4, 6, 6)]
    expected = []
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            found = plain_tiles(text.split(), item.split(), 5)
            if sum(t[2] for t in found) >= 0.8 * 18:
                expected.append((d, i))
    assert pairs(spark, docs, texts, items) == expected and expected


def test_documents_and_items_at_random(spark, docs):
    """All pairs against the definition, with few words so that seeds repeat."""
    rng = random.Random(8)
    items = [" ".join(f"v{rng.randrange(6)}" for _ in range(rng.randint(1, 20))) for _ in range(25)]
    texts = []
    for _ in range(40):
        words = [f"v{rng.randrange(6)}" for _ in range(rng.randint(0, 25))]
        words[0:0] = rng.choice(items).split()
        texts.append(" ".join(words))
    expected = []
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            n = len(item.split())
            if sum(t[2] for t in plain_tiles(text.split(), item.split(), min(5, n))) >= 0.8 * n - 1e-9:
                expected.append((d, i))
    assert pairs(spark, docs, texts, items) == expected
