"""Toxic passages by maximum-scoring segments over token log-odds."""

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicle.llm.kernels import Words, filled, slices, windows
from chronicle.shared import staged

#: Labelled texts with different sketches that the model is fitted on, at most (in expectation).
SAMPLE_TEXTS = 20_000
#: Strength of the Dirichlet prior as a share of the sample's tokens.
PRIOR_SHARE = 0.1
#: Share of tokens that say anything about toxicity, and the variance of their true log-odds; those of all others are 0.
TELLING_SHARE = 0.2
TELLING_VARIANCE = 4.0
#: Tokens in fewer texts of the sample have the prior's value, 0, like tokens that are not in it.
MIN_TEXTS = 4
MIN_DRIFT = 0.05
#: Chance with which a clean text of its length reaches the score of a reported passage.
SIGNIFICANCE = 0.05

#: Log-odds are whole numbers of 1/_STEPS, so that sums of them are exact in any order.
_STEPS = 1 << 10
PASSAGES = "array<struct<first:int,last:int,score:double>>"


@dataclass
class Model:
    """What scoring needs; ``tokens`` are sorted word hashes, ``steps`` their log-odds in units of 1/_STEPS.

    A word's score is its log-odds less ``drift``, which keeps the expected
    score of a clean text's word below zero. ``words`` names the tokens.
    """

    tokens: np.ndarray
    steps: np.ndarray
    words: pa.Array | None
    drift: float
    rate: float  # lambda of the extreme-value distribution
    scale: float  # K of the extreme-value distribution
    intercept: float = 0.0
    slope: float = 0.0

    @property
    def odds(self) -> np.ndarray:
        return self.steps / _STEPS


def _counted(batches):
    """Per batch, each word with the number of toxic and clean texts that hold it."""
    for batch in batches:
        label = batch["label"].to_numpy(zero_copy_only=False)
        at = 0
        for part in slices(filled(batch["text"])):
            words = Words(part)
            encoded = words.words().dictionary_encode()
            index, n = encoded.indices.to_numpy(), len(encoded.dictionary)
            seen = np.unique(words.rows * max(n, 1) + index)
            toxic = label[at : at + len(part)][seen // max(n, 1)] if n else seen
            yield pa.RecordBatch.from_arrays(
                [
                    encoded.dictionary,
                    pa.array(np.bincount(seen % max(n, 1), toxic, n).astype(np.int64)),
                    pa.array(np.bincount(seen % max(n, 1), 1 - toxic, n).astype(np.int64)),
                ],
                ["word", "toxic", "clean"],
            )
            at += len(part)


@F.arrow_udf(T.LongType())
def sketch(texts: pa.Array) -> pa.Array:
    """The smallest hash of a text's five-word windows: near copies mostly share it."""
    out = []
    for part in slices(filled(texts)):
        words = Words(part)
        hashes, at = windows(words, 5)
        bounds = np.searchsorted(at, words.row_starts)
        for row, n in enumerate(words.counts.tolist()):
            own = hashes[bounds[row] : bounds[row + 1]]
            if not len(own):
                own = words.hashes[words.row_starts[row] : words.row_starts[row + 1]]
            out.append(int(own.min()) if len(own) else n)
    return pa.array(np.array(out, np.uint64).view(np.int64), pa.int64())


def segments(first, last, left, right) -> list[tuple[int, int, float]]:
    """All maximal scoring runs ``(first, last, score)`` of one text, in linear time.

    The arguments are lists over the text's stretches of words with positive
    scores, in order: first and last word, and the sums of all scores before
    and up to the end of the stretch.
    """
    kept = []  # first, last, sum before the run, sum with it, previous run with a smaller left sum
    for run in zip(first, last, left, right):
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= run[2]:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= run[3]:
                kept.append((*run, j))
                break
            run = (kept[j][0], run[1], kept[j][2], run[3])
            del kept[j:]
    return [(first, last, right - left) for first, last, left, right, _ in kept]


def stretches(scores: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of positive scores that stay within a row, as ``segments`` takes them; rows start at ``row_starts``."""
    if not len(scores):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    positive = scores > 0
    edge = np.ones(len(scores), bool)
    edge[1:] = positive[1:] != positive[:-1]
    edge[row_starts[row_starts < len(scores)]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(scores))
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    up = positive[starts]
    return starts[up], ends[up] - 1, sums[starts[up]], sums[ends[up]]


def word_scores(model: Model, hashes: np.ndarray) -> np.ndarray:
    """The score of each word: its log-odds, 0 for an unknown one, less the drift."""
    if not len(model.tokens):
        return np.full(len(hashes), -model.drift)
    slot = np.searchsorted(model.tokens, hashes)
    slot[slot == len(model.tokens)] = 0
    return np.where(model.tokens[slot] == hashes, model.steps[slot] / _STEPS, 0.0) - model.drift


def _scorer(model: Model):
    """The UDF: significant passages and total evidence of each text; tasks get ten bytes a token."""
    model = replace(model, words=None)

    @F.arrow_udf(f"struct<n_words:long,evidence:double,best:double,passages:{PASSAGES}>")
    def score(texts: pa.Array) -> pa.Array:
        sizes, evidence, best, found = [], [], [], []
        for part in slices(filled(texts)):
            words = Words(part)
            distinct, at = np.unique(words.hashes, return_inverse=True)
            first, last, left, right = stretches(word_scores(model, distinct)[at], words.row_starts)
            bounds = np.searchsorted(first, words.row_starts)
            for row, n in enumerate(words.counts.tolist()):
                lo, hi = bounds[row], bounds[row + 1]
                start = words.row_starts[row]
                runs = segments((first[lo:hi] - start).tolist(), (last[lo:hi] - start).tolist(), left[lo:hi].tolist(), right[lo:hi].tolist())
                base = np.log(model.scale * max(n, 1))
                floor = base - np.log(-np.log1p(-SIGNIFICANCE))
                passages = [{"first": a, "last": b, "score": s} for a, b, s in runs if model.rate * s >= floor]
                sizes.append(n)
                evidence.append(sum(model.rate * p["score"] - base for p in passages))
                best.append(max((s for _, _, s in runs), default=0.0))
                found.append(passages)
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())]))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(evidence, pa.float64()), pa.array(best, pa.float64()), pa.array(found, kind)],
            ["n_words", "evidence", "best", "passages"],
        )

    return score


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_TEXTS) -> DataFrame:
    """``(text, label)`` of about ``limit`` distinct labelled texts, chosen by hash.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1); other labels and null ids
    are left out. Of texts with the same sketch one counts, toxic if any of
    them is, so that a group of copies does not teach its own words.
    """
    marked = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    marked = docs.select("doc_id", sketch("text").alias("digest")).join(marked, "doc_id")
    # The text that is kept is one that carries the label: the smallest id among those with the largest label.
    least = F.max(F.struct(F.col("label").cast("long").alias("label"), (-F.col("doc_id")).alias("at")))
    unique = marked.groupBy("digest").agg(least.alias("best"))
    unique = staged(unique.select("digest", (-F.col("best.at")).alias("doc_id"), "best.label"), "toxicity-sketches")
    n = unique.count()
    share = min(1.0, limit / max(n, 1))
    chosen = unique.where(F.pmod("digest", F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    # The sample is bounded by ``limit``, and so is what is broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(chosen.drop("digest")), "doc_id").select("text", "label")


def _rate(share, score) -> float:
    """Lambda: where the expected ``exp(lambda * score)`` of clean texts' words is one again; ``share`` sums to one."""
    if not len(score) or score.max() <= 0:
        return 1.0

    def excess(x):
        return float((share * np.exp(x * score)).sum() - 1)

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        high *= 2
    while excess(low) > 0 and low > 1e-12:
        low /= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _logistic(x, y, weight, rounds: int = 50) -> tuple[float, float]:
    """Intercept and slope of a lightly regularised logistic fit."""
    design = np.stack([np.ones_like(x), x], 1)
    beta, ridge = np.zeros(2), np.diag([1e-6, 1e-2])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge @ beta
        step = np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(2), gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_TEXTS) -> Model:
    """Learn token log-odds, the extreme-value distribution and its calibration.

    A token's log-odds come from counts per class under a Dirichlet prior with
    the corpus shares as its mean, times the probability that they are not
    chance. Every token of ``MIN_TEXTS`` texts or more has its own, below zero too.
    Without labelled texts of both classes every text gets the prior share of
    toxic ones (one half without any labels).
    """
    sample = staged(training_sample(docs, labels, limit), "toxicity-sample")
    counts = sample.mapInArrow(_counted, "word string, toxic long, clean long")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = counts.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum("clean"), F.lit(0))).first()
    n1, n0 = totals
    prior = PRIOR_SHARE * (n1 + n0)
    if n1 and n0:
        a = (F.col("toxic") + F.col("clean")) * PRIOR_SHARE
        odds = F.ln((F.col("toxic") + a) / (n1 + prior - F.col("toxic") - a)) - F.ln((F.col("clean") + a) / (n0 + prior - F.col("clean") - a))
        variance = 1 / (F.col("toxic") + a) + 1 / (F.col("clean") + a)
        # An estimate counts as far as chance alone, of its own variance, is unlikely to give it.
        wide = variance + TELLING_VARIANCE
        chance = (1 - TELLING_SHARE) / TELLING_SHARE * F.sqrt(wide / variance) * F.exp(odds * odds / 2 * (1 / wide - 1 / variance))
        shrunk = odds / (1 + chance)
        # At most one row for every MIN_TEXTS words of the bounded sample, 20 bytes and the word each.
        found = counts.where(F.col("toxic") + F.col("clean") >= MIN_TEXTS).select("word", "clean", shrunk.alias("odds"))
        found = found.toArrow().combine_chunks()
        words, odds, clean = found["word"].combine_chunks(), found["odds"].to_numpy(), found["clean"].to_numpy()
    else:
        words, odds, clean = pa.array([], pa.string()), np.zeros(0), np.zeros(0)
    hashes = Words(words).hashes if len(words) else np.zeros(0, np.uint64)
    share = np.append(clean, max(0, n0 - clean.sum())) / max(n0, 1)
    steps = np.round(odds * _STEPS).astype(np.int16)  # counts of a bounded sample keep log-odds below 32
    odds = steps / _STEPS
    plain = np.append(odds, 0.0)  # all other tokens
    drift = np.ceil(max(MIN_DRIFT, 2 * float((share * np.maximum(plain, 0)).sum())) * _STEPS) / _STEPS
    order = np.argsort(hashes)
    order = order[steps[order] != 0]  # unknown tokens have 0
    model = Model(hashes[order], steps[order], words.take(pa.array(order)), drift, _rate(share, plain - drift), 1.0)
    # A filter on the result of a deterministic function would run it a second time, in another worker.
    best = sample.where("label = 0").select(_scorer(model).asNondeterministic()("text").alias("r")).select("r.*")
    clean = best.where("n_words > 0").agg(
        F.avg(model.rate * F.col("best") - F.ln("n_words")).alias("m"), F.count(F.lit(1)).alias("n")
    ).first()
    if clean.n:
        model.scale = float(np.exp(clean.m - np.euler_gamma))
    binned = (
        sample.select("label", F.round(F.log1p(_scorer(model)("text")["evidence"]), 2).alias("x"))
        .groupBy("x", "label")
        .count()
        .collect()
    )
    if binned:
        model.intercept, model.slope = _logistic(*(np.array([float(r[k]) for r in binned]) for k in ("x", "label", "count")))
    return model


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` and ``passages``; nothing is shuffled.

    ``passages`` are the significant runs of words (first and last word, from
    0, and their log-odds); columns of these names are replaced. Null and empty texts have no passages and the
    score of a text without evidence.
    """

    def probability(evidence: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(model.intercept) + F.lit(model.slope) * F.log1p(evidence))))

    own = ("score", "predicted", "passages")
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in own]
    found = docs.select(F.struct(*rest).alias("doc"), _scorer(model)(F.col(text)).alias("toxic"))
    score = probability(F.col("toxic.evidence"))
    return found.select("doc.*", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "toxic.passages")
