"""The strongest phrases of each language, by best-first growth from prefixes.

A phrase can score no more than its prefix's count allows. Prefixes whose bound
reaches a threshold are grown by a word, and the threshold falls until enough
phrases above it are known to stay.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronicle.llm.kernels import filled, hashes, layout, mixed, slices
from chronicle.shared import staged

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
#: The score of a phrase whose parts never stand without each other is half of this.
SCALE = 2_000_000
#: A phrase goes where a longer one has at least 4 of 5 of its occurrences.
COVERED = (4, 5)
NO_LANGUAGE = "und"
#: Filters of phrases have 2 to this power bits (2 MB each), whatever they hold. They save work and decide nothing.
FILTER_BITS = 24
SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: 0 in words, 1 between words, 2 between pieces.
_KIND = np.zeros(256, np.int8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2

_COUNTS = "lang string, phrase string, words int, f long"


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of its prefix and its last word; a language is the prefix of a word."""
    return mixed(prefix * _BASE + word)


class Filter:
    """Bits of phrase hashes."""

    def __init__(self, words: np.ndarray | None = None):
        self.words = words  # None where it holds nothing

    def has(self, h: np.ndarray) -> np.ndarray:
        if self.words is None:
            return np.zeros(len(h), bool)
        slot = h & np.uint64((1 << FILTER_BITS) - 1)
        return ((self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)

    def __or__(self, other: "Filter") -> "Filter":
        if self.words is None or other.words is None:
            return other if self.words is None else self
        return Filter(self.words | other.words)


def filters(marked: DataFrame, count: int) -> list[Filter]:
    """``count`` filters of the rows ``lang, phrase, words, filter`` (its number). The driver gets no more than their bits."""

    def slots(batches):
        for batch in batches:
            words, kind = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            split, h = pc.split_pattern(batch.column(1), " "), hashes(batch.column(0))
            for k in range(max(words, default=0)):
                own = np.flatnonzero(words > k)
                h[own] = _longer(h[own], hashes(pc.list_element(split.take(pa.array(own)), k)))
            slot = (h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
            bits = (np.uint64(1) << (slot & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(slot >> 6), pa.array(bits)], ["filter", "word", "bit"])

    rows = marked.select("lang", "phrase", "words", F.col("filter").cast("int").alias("filter"))
    found = rows.mapInArrow(slots, "filter int, word long, bit long").groupBy("filter", "word").agg(F.bit_or("bit").alias("set")).toArrow()
    result = [Filter(np.zeros(1 << (FILTER_BITS - 6), np.uint64)) for _ in range(count)]
    kind = found["filter"].to_numpy()
    for i, f in enumerate(result):
        own = found.filter(pa.array(kind == i))
        f.words[own["word"].to_numpy()] = own["set"].to_numpy().view(np.uint64)
    return result


class _Text:
    """The words of some rows: language, word number, whether the next one follows in the same piece, and hashes."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        offsets, data = layout(pc.ascii_lower(texts))
        kind = _KIND[data]
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = kind == 0
        first, last = inside[:-1].copy(), inside[:-1].copy()
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-2]
        before[edges] = False
        first &= ~before
        after = inside[1:].copy()
        after[edges - 1] = False
        last &= ~after
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        rows = np.searchsorted(offsets, starts, "right") - 1
        breaks = np.cumsum(kind == 2, dtype=np.int32)[starts]
        self.joined = np.zeros(len(starts), bool)
        self.joined[:-1] = (rows[1:] == rows[:-1]) & (breaks[1:] == breaks[:-1])
        lengths = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=lengths[1:])
        kept = np.ascontiguousarray(data[inside[:-1]])
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(lengths), pa.py_buffer(kept)).dictionary_encode()
        langs = langs.dictionary_encode()
        self.words, self.langs = words.dictionary, langs.dictionary
        self.word = words.indices.to_numpy().astype(np.int64)
        self.lang = langs.indices.to_numpy().astype(np.int64)[rows]
        self.word_hash = hashes(self.words)[self.word] if len(starts) else np.zeros(0, np.uint64)
        lang_hash = hashes(self.langs)[self.lang] if len(starts) else np.zeros(0, np.uint64)
        self.hash = _longer(lang_hash, self.word_hash)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """For the word at each place whether a phrase of ``size`` words starts there, and its hash."""
        n = max(0, len(self.word) - size + 1)
        fits, h = np.ones(n, bool), self.hash[:n]
        for k in range(1, size):
            fits &= self.joined[k - 1 : k - 1 + n]
            h = _longer(h, self.word_hash[k : k + n])
        return fits, h

    def counted(self, places: np.ndarray, size: int) -> pa.RecordBatch:
        """The different phrases that start at ``places``, with their numbers there."""
        width, key, steps = max(1, len(self.words)), self.lang[places], []
        for k in range(size):
            encoded = pa.array(key * width + self.word[places + k]).dictionary_encode()
            steps.append(encoded.dictionary.to_numpy())
            key = encoded.indices.to_numpy().astype(np.int64)
        number, names = np.arange(len(steps[-1])), []
        for step in reversed(steps):
            number, word = np.divmod(step[number], width)
            names.append(self.words.take(pa.array(word)))
        phrase = pc.binary_join_element_wise(*reversed(names), " ")
        count = np.bincount(key, minlength=len(phrase)).astype(np.int64)
        words = pa.array(np.full(len(phrase), size, np.int32))
        return pa.RecordBatch.from_arrays([self.langs.take(pa.array(number)), phrase, words, pa.array(count)], ["lang", "phrase", "words", "f"])


def _counts(docs: DataFrame, chosen, least: int) -> DataFrame:
    """Counts of at least ``least`` of the phrases that start where ``chosen`` says: it takes a
    :class:`_Text` and gives places by number of words. Rows of no words hold all words of a language."""

    def counted(batches):
        for batch in batches:
            langs, texts, start = batch.column(0), filled(batch.column(1)), 0
            for part in slices(texts, SLICE_BYTES):
                text = _Text(langs.slice(start, len(part)), part)
                start += len(part)
                for size, places in chosen(text).items():
                    if not len(places):
                        continue
                    if size == 1:
                        totals = np.bincount(text.lang, minlength=len(text.langs)).astype(np.int64)
                        none = pa.nulls(len(totals), pa.string())
                        zero = pa.array(np.zeros(len(totals), np.int32))
                        yield pa.RecordBatch.from_arrays([text.langs, none, zero, pa.array(totals)], ["lang", "phrase", "words", "f"])
                    yield text.counted(places, size)
                del text  # before the next one is made
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col("text").cast("string").alias("text"))
    sums = rows.mapInArrow(counted, _COUNTS).groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return staged(sums.where((F.col("f") >= least) | (F.col("words") == 0)), "phrase-counts")


def _score(a: str, other: str) -> Column:
    """SCALE times ``a`` by ``other``, rounded down, without overflow."""
    return F.expr(f"cast((cast({SCALE} as decimal(7,0)) * cast({a} as decimal(20,0))) div cast({other} as decimal(22,0)) as long)")


def _scored(phrases: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """``lang, phrase, a, l, r, score, bound`` of the phrases of ``size`` words all of whose parts are in ``counts``.

    ``bound`` is what a phrase with this prefix can reach: its first cut has the
    first word on one side and at least itself on the other.
    """
    word = F.split("phrase", " ")
    parts = [
        F.struct(F.lit(2 * cut + side).alias("at"), F.array_join(F.slice(word, 1 + side * cut, (cut, size - cut)[side]), " ").alias("part"))
        for cut in range(1, size)
        for side in (0, 1)
    ]
    rows = phrases.where(F.col("words") == size).select("lang", "phrase", F.col("f").alias("a"), F.inline(F.array(*parts)))
    known = counts.where(F.col("words").between(1, size - 1)).select("lang", F.col("phrase").alias("part"), "f")
    sides = [F.max(F.when(F.col("at") == at, F.col("f"))).alias(f"f{at}") for at in range(2, 2 * size)]
    found = rows.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(*sides).dropna()
    cuts = [
        F.struct(_score("a", f"cast(f{2 * k} as decimal(20,0)) + f{2 * k + 1}").alias("score"), F.lit(k).alias("k"), F.col(f"f{2 * k}").alias("l"), F.col(f"f{2 * k + 1}").alias("r"))
        for k in range(1, size)
    ]
    found = found.withColumn("cut", F.array_min(F.array(*cuts))).withColumn("bound", _score("a", "cast(f2 as decimal(20,0)) + a"))
    return found.select("lang", "phrase", F.lit(size).alias("words"), "a", "cut.l", "cut.r", "cut.score", "bound")


def _thresholds(pairs: DataFrame, rank: int) -> DataFrame:
    """``lang, least``: a score that at least ``rank`` of the language's pairs reach, 0 where there are fewer.

    Found on a histogram of fixed size per language.
    """
    step = SCALE // 20_000
    bars = pairs.groupBy("lang", F.expr(f"score div {step}").alias("bar")).agg(F.count(F.lit(1)).alias("n"))
    falling = Window.partitionBy("lang").orderBy(F.desc("bar"))
    above = bars.withColumn("above", F.sum("n").over(falling))
    least = F.coalesce(F.max(F.when(F.col("above") >= rank, F.col("bar"))) * step, F.lit(0))
    return above.groupBy("lang").agg(least.alias("least"))


def _part(first: int, last: int) -> Column:
    """Words ``first`` to ``last`` of a phrase."""
    return F.array_join(F.slice(F.split("phrase", " "), first, last - first + 1), " ")


def _marks(rows: DataFrame, number: int, phrase: Column | None = None) -> DataFrame:
    named = F.col("phrase") if phrase is None else phrase
    return rows.select("lang", named.alias("phrase"), F.size(F.split(named, " ")).alias("words"), F.lit(number).alias("filter"))


def _survivors(shorter: DataFrame, longer: DataFrame, size: int) -> DataFrame:
    """The phrases of ``size`` words that no longer one has most occurrences of.

    One word more is enough to look at: what lies in a phrase of two words more
    also lies in one between, which is at least as frequent.
    """
    inner = F.explode(F.array(_part(1, size), _part(2, size + 1)))
    hiding = longer.where(F.col("words") == size + 1).select("lang", inner.alias("phrase"), F.col("f").alias("n_longer"))
    most = hiding.groupBy("lang", "phrase").agg(F.max("n_longer").alias("n_longer"))
    held = F.col("n_longer") * COVERED[1] >= F.col("a") * COVERED[0]
    return shorter.join(most, ["lang", "phrase"], "left").where(~F.coalesce(held, F.lit(False))).drop("n_longer")


def _frequent_words(text: _Text) -> dict[int, np.ndarray]:
    return {1: np.arange(len(text.word))}


def _pairs_of(frequent: Filter):
    def chosen(text: _Text):
        fits, _ = text.grams(2)
        common = frequent.has(text.hash)
        return {2: np.flatnonzero(fits & common[:-1] & common[1:])} if len(fits) else {}

    return chosen


def _grown(text: _Text, size: int, prefix: Filter, suffix: Filter, done: tuple[Filter, Filter], pair: Filter) -> np.ndarray:
    """Places of phrases of ``size`` words with a chosen prefix or suffix that were not counted before."""
    fits, _ = text.grams(size)
    n = len(fits)
    if not n:
        return np.zeros(0, np.int64)
    common = pair.has(text.grams(2)[1])
    for k in range(size - 1):
        fits &= common[k : k + n]
    places = np.flatnonzero(fits)
    h = text.grams(size - 1)[1]
    left, right = h[places], h[places + 1]
    wanted = (prefix.has(left) | suffix.has(right)) & ~(done[0].has(left) | done[1].has(right))
    return places[wanted]


def collocations(docs: DataFrame, top: int = TOP, min_count: int = MIN_COUNT) -> DataFrame:
    """The ``top`` phrases of two to four words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A to Z), split at ``.,;:!?`` and line breaks into
    pieces and these at blanks and tabs into words. ``a`` counts a phrase's
    occurrences (at least ``min_count``), ``l`` and ``r`` those of its parts at
    the weakest cut, ``n`` all words. A phrase goes where a longer one that holds
    it has 4 of 5 of its occurrences. Equal scores are ordered by ``a``, then by
    the phrase. Null texts are empty, a null language is ``und``; ids do not
    matter, repeated rows count each time, and no rows give no rows.

    Words are counted first, then pairs of frequent words. In each round the
    pairs, then the triples whose bound reaches a language's threshold are grown
    by a word to the right, and those above it by one to the left, too, which
    tells whether they stay; phrases counted once are not counted again. What
    scores at least the threshold is then known completely. It is settled when
    ``top`` of it stay; otherwise the threshold falls to four times the rank, at
    last to 0. Every count is exact and taken over all documents: a phrase passes
    the filters at all of its places or at none.
    """
    words = _counts(docs, _frequent_words, min_count)
    (frequent,) = filters(_marks(words.where("words = 1"), 0), 1)
    pair_counts = _counts(docs, _pairs_of(frequent), min_count)
    counts = words.unionByName(pair_counts)
    pairs = staged(_scored(pair_counts, counts, 2), "scored-pairs")
    (common,) = filters(_marks(pairs, 0), 1)
    done3, done4 = (Filter(), Filter()), (Filter(), Filter())
    triples = quads = None
    rank, least = 2 * top, staged(_thresholds(pairs, 2 * top), "thresholds")
    while True:
        above, able = F.col("score") >= F.col("least"), F.col("bound") >= F.col("least")
        live = pairs.join(least, "lang")
        grown, ended = filters(_marks(live.where(able), 0).unionByName(_marks(live.where(above), 1)), 2)
        found = _counts(docs, lambda t, p=grown, s=ended, d=done3: {3: _grown(t, 3, p, s, d, common)}, min_count).where("words = 3")
        triples = found if triples is None else triples.unionByName(found)
        done3 = (done3[0] | grown, done3[1] | ended)

        scored3 = staged(_scored(triples, counts.unionByName(triples), 3), "scored-triples")
        live = scored3.join(least, "lang")
        # The last two words of what is grown begin the phrases that end the longer ones; their counts are needed, too.
        marks = _marks(live.where(able), 0).unionByName(_marks(live.where(above), 1)).unionByName(_marks(live.where(able), 2, _part(2, 3)))
        grown, ended, endings = filters(marks, 3)
        none = Filter()

        def chosen(t, p=grown, s=ended, e=endings, d=(done3, done4)):
            return {3: _grown(t, 3, e, none, d[0], common), 4: _grown(t, 4, p, s, d[1], common)}

        found = _counts(docs, chosen, min_count)
        triples = triples.unionByName(found.where("words = 3"))
        quads = found.where("words = 4") if quads is None else quads.unionByName(found.where("words = 4"))
        done3, done4 = (done3[0] | endings, done3[1]), (done4[0] | grown, done4[1] | ended)

        best = [rows.join(least, "lang").where(above).drop("least", "bound") for rows in (pairs, _scored(triples, counts.unionByName(triples), 3))]
        stay = (
            _survivors(best[0], triples, 2)
            .unionByName(_survivors(best[1], quads, 3))
            .unionByName(_scored(quads, counts.unionByName(triples), 4).join(least, "lang").where(above).drop("least", "bound"))
        )
        stay = staged(stay, "phrases")
        number = stay.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        short = least.join(number, "lang", "left").where((F.col("least") > 0) & (F.coalesce("n", F.lit(0)) < top)).select("lang")
        short = staged(short, "unsettled")
        if short.isEmpty():
            break
        rank *= 4
        lower = _thresholds(pairs.join(short, "lang", "left_semi"), rank).select("lang", F.col("least").alias("lower"))
        least = staged(least.join(lower, "lang", "left").select("lang", F.least("least", "lower").alias("least")), "thresholds")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = stay.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = words.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
