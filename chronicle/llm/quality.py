"""Document quality from its own evidence and from where it stands.

A naive Bayes classifier over binned text measures gives each document's
evidence. Site and section rates come from labelled documents, sections shrunk
towards their site and sites towards all, as strongly as the spread between
them tells (empirical Bayes).
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicle.llm.kernels import Words, filled, slices
from chronicle.shared import staged

MEASURES = ("n_words", "signs", "repeats", "top_word", "repeated_lines")
BINS = 20
_MAX_STRENGTH = 1e6


@F.arrow_udf(T.StructType([T.StructField(m, T.DoubleType()) for m in MEASURES]))
def measures(texts: pa.Array) -> pa.Array:
    """Words, share of characters that are signs, of words like the one before,
    of the most frequent word, of lines seen before; zeros for an empty text."""
    out = []
    for part in slices(filled(texts)):
        words = Words(part)
        for row, text in enumerate(part):
            text = text.as_py()
            own = words.hashes[words.row_starts[row] : words.row_starts[row + 1]]
            n = len(own)
            letters = int((words.ends - words.starts)[words.row_starts[row] : words.row_starts[row + 1]].sum())
            size = len(text.encode())
            blanks = len(text) - len("".join(text.split()))
            lines = [x for x in text.split("\n") if x.strip()]
            out.append(
                (
                    float(n),
                    max(0, size - letters - blanks) / max(size, 1),
                    float((own[1:] == own[:-1]).sum()) / max(n, 1),
                    float(np.unique(own, return_counts=True)[1].max()) / n if n else 0.0,
                    1 - len(set(lines)) / len(lines) if lines else 0.0,
                )
            )
    columns = np.array(out, np.float64).reshape(-1, len(MEASURES)).T
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], list(MEASURES))


def _strength(groups: DataFrame, centre: str) -> float:
    """How many observations the prior is worth: from the spread of group rates around ``centre``.

    ``groups`` has ``good``, ``n`` and the expected rate. Spread that chance
    alone explains gives the largest strength.
    """
    p = F.col(centre)
    r = groups.agg(
        F.sum((F.col("good") - F.col("n") * p) ** 2 - F.col("n") * p * (1 - p)).alias("over"),
        F.sum(F.col("n") * (F.col("n") - 1) * p * (1 - p)).alias("scale"),
    ).first()
    if not r.scale or not r.over or r.over <= 0:
        return _MAX_STRENGTH
    rho = min(max(r.over / r.scale, 1 / _MAX_STRENGTH), 0.5)  # the part of the variance that lies between groups
    return 1 / rho - 1


def site_rates(labelled: DataFrame) -> tuple[DataFrame, DataFrame, float]:
    """Posterior rates of good documents by ``host`` and by (``host``, ``path``), and the global rate.

    ``labelled`` has ``host``, ``path`` and ``good`` (0 or 1).
    """
    paths = labelled.groupBy("host", "path").agg(F.sum("good").alias("good"), F.count(F.lit(1)).alias("n"))
    paths = staged(paths, "path-counts")
    total = paths.agg(F.coalesce(F.sum("good"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    overall = (total[0] + 1) / (total[1] + 2)
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n")).withColumn("centre", F.lit(overall))
    strength = _strength(hosts, "centre")
    hosts = hosts.select("host", ((F.col("good") + strength * overall) / (F.col("n") + strength)).alias("host_rate"))
    inside = paths.join(hosts, "host")
    strength = _strength(inside, "host_rate")
    rate = (F.col("good") + strength * F.col("host_rate")) / (F.col("n") + strength)
    return hosts, inside.select("host", "path", rate.alias("path_rate")), overall


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``evidence`` (log odds), ``site_rate``, ``score`` and ``keep`` (score >= 0.5) of every row.

    ``docs`` has ``doc_id``, ``text``, ``host`` and ``path``; ``labels`` has
    ``doc_id`` and ``good`` (0 or 1), of which other values and null ids are
    left out. Null hosts and paths are a site and section of their own; null
    texts count as empty. A section without labels takes its site's rate, a
    site without labels the global one; without any labels every score is
    one half. Texts are read once and not shuffled.
    """
    host, path = (F.coalesce(c, F.lit("")) for c in ("host", "path"))
    known = staged(docs.select("doc_id", host.alias("host"), path.alias("path"), measures("text").alias("m")), "measures")
    marks = labels.where("good IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("good").alias("good"))
    labelled = staged(known.join(marks, "doc_id"), "labelled")
    shares = [i / BINS for i in range(1, BINS)]
    cuts = labelled.agg(*[F.percentile_approx(f"m.{m}", shares).alias(m) for m in MEASURES]).first()

    def binned(m):
        # Values of a measure and of its cuts are compared; equal cuts leave bins empty.
        own = sorted(set(cuts[m] or []))
        return F.lit(0) + sum(((F.col(f"m.{m}") > c).cast("int") for c in own), F.lit(0))

    bins = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), binned(m).alias("bin")) for m in MEASURES]))
    counts = labelled.select("good", bins.alias("b")).groupBy("b.measure", "b.bin").agg(
        F.sum("good").alias("good"), F.count(F.lit(1)).alias("n")
    ).collect()  # at most BINS rows for each measure
    totals = {}
    for r in counts:
        g, n = totals.get(r.measure, (0, 0))
        totals[r.measure] = (g + r.good, n + r.n)
    evidence = F.lit(0.0)
    for m in MEASURES:
        odds = F.lit(0.0)
        for r in sorted((r for r in counts if r.measure == m), key=lambda r: r.bin):
            good, n = totals[m]
            gain = np.log((r.good + 0.5) / (good + 0.5 * BINS)) - np.log((r.n - r.good + 0.5) / (n - good + 0.5 * BINS))
            odds = F.when(F.col(f"_{m}") == r.bin, float(gain)).otherwise(odds)
        evidence = evidence + odds
    hosts, paths, overall = site_rates(labelled)
    binned_rows = known.select("doc_id", "host", "path", *[binned(m).alias(f"_{m}") for m in MEASURES])
    rows = binned_rows.select("doc_id", "host", "path", evidence.alias("evidence"))
    rows = rows.join(paths, ["host", "path"], "left").join(hosts, "host", "left")
    rate = F.coalesce("path_rate", "host_rate", F.lit(overall))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.ln(rate / (1 - rate)))))
    return rows.select("doc_id", "evidence", rate.alias("site_rate"), score.alias("score"), (score >= 0.5).alias("keep"))
