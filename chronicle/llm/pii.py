"""Personal data: patterns, and a skip-chain random field that carries their labels on.

Patterns give the base spans. Tokens with digits or an at sign form a chain
per document; tokens that repeat, or are the same number in another spelling, are tied by
skip edges, and loopy message passing makes their labels agree. A token that
the field labels and no pattern found becomes another span.
"""

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicle.llm.kernels import filled, slices
from chronicle.shared import staged

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"
RARE = "array<struct<shape:string,counts:array<long>>>"
#: Token shapes whose counts every task holds, the most frequent ones; those of others are joined to the documents.
MAX_SHAPES = 2_000
#: Messages that change by less have settled.
SETTLED = 1e-4
#: Shorter tokens repeat by chance and are not tied.
MIN_KEY = 6
#: Tied tokens that disagree and agree, before any are counted.
AGREEMENT_PRIOR = (1, 30)
MIN_MARGINAL = 0.5

# The patterns; possessive runs and the look-behind find the same matches without rescanning.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_OPENING, _CLOSING = "([{<\"'", ")]}>\"'.,;:!?"


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if place % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` in order of kind and place; ``kind`` indexes ``KINDS``."""
    found, last = [], 0
    at = text.find("@")
    while at >= 0:
        local = text[last:at]
        start = last + len(local.rstrip(_LOCAL))
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            last = match.end()
            found.append((0, start, last))
        else:
            last = at + 1 if start == at else max(last, start)
        at = text.find("@", match.end() if match else at + 1)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
                found.append((1, *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    found.append((3, *m.span()))
    return found


def candidates(text: str) -> list[tuple[int, int]]:
    """Tokens with a digit or an at sign, without brackets and stops around them."""
    found = []
    if "@" not in text and not _DIGIT.search(text):
        return found
    place = 0
    for token in text.split():
        place = text.index(token, place)
        end = place + len(token)
        if "@" in token or _DIGIT.search(token):
            start = place + len(token) - len(token.lstrip(_OPENING))
            stop = end - (len(token) - len(token.rstrip(_CLOSING)))
            if start < stop:
                found.append((start, stop))
        place = end
    return found


def shape(token: str) -> str:
    """The form of a token: letters as ``a``, digits as their number up to 19, signs as they are; long forms end in their hash."""
    out = []
    for part in re.finditer(r"[0-9]+|[^\W\d_]+|.", token, re.S):
        piece = part[0]
        if "0" <= piece[0] <= "9":
            out.append(f"9{min(len(piece), 20)}")
        else:
            out.append("a" if piece.isalpha() else piece)
    form = "".join(out)
    return form if len(form) <= 64 else form[:32] + hashlib.md5(form.encode("utf-8", "surrogatepass")).hexdigest()


def keys(token: str) -> list[str]:
    """What ties tokens: the token in lower case, and its digits if they are a long number."""
    digits = re.sub(r"[^0-9]", "", token)
    same = [token.lower()] if len(token) >= MIN_KEY else []
    if len(digits) >= 7 and not re.search(r"[^\W\d_]", token):
        same.append("#" + digits)
    return same


@dataclass
class Field:
    """Log potentials: by shape and label, the gain of agreeing neighbours, of agreeing tied tokens.

    ``rare`` is a table of all other shapes with their counts by label, if there are any.
    """

    shapes: dict
    unseen: np.ndarray
    chain: float
    skip: float
    rare: DataFrame | None = None


def potential(counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """The log share of a shape's labels, with one observation of the overall shares added."""
    return np.log((counts + prior) / (counts.sum() + 1))


def observed(text: str):
    """Candidates with their observed labels (0 for none, else 1 + kind) and the base spans."""
    base, tokens = base_spans(text), candidates(text)
    labels = np.zeros(len(tokens), np.int64)
    if tokens:
        starts = np.array([t[0] for t in tokens])
        ends = np.array([t[1] for t in tokens])
        for kind, start, end in reversed(base):
            labels[np.searchsorted(ends, start, "right") : np.searchsorted(starts, end)] = kind + 1
    return base, tokens, labels


def ties(text: str, tokens) -> list[tuple[int, int]]:
    """Skip edges: each token with the last one before it that shares a key."""
    last, edges = {}, set()
    for n, (start, end) in enumerate(tokens):
        for key in keys(text[start:end]):
            if key in last:
                edges.add((last[key], n))
            last[key] = n
    return sorted(edges)


def marginals(unary: np.ndarray, edges, gains, rounds: int | None = None) -> np.ndarray:
    """Label beliefs by loopy sum-product; an edge adds its gain where both labels agree.

    Messages pass until they settle (or for ``rounds``). Those that still swing
    when evidence has long crossed the whole graph are damped more and more.
    """
    n, k = unary.shape
    unary = unary - unary.max(axis=1, keepdims=True)
    if not len(edges):
        p = np.exp(unary)
        return p / p.sum(axis=1, keepdims=True)
    a, b = np.asarray(edges).T
    src, dst = np.concatenate((a, b)), np.concatenate((b, a))
    gain = np.expm1(np.concatenate((gains, gains)))[:, None]
    back = np.concatenate((np.arange(len(a)) + len(a), np.arange(len(a))))
    messages = np.zeros((len(src), k))
    for turn in itertools.count() if rounds is None else range(rounds):
        belief = unary.copy()
        np.add.at(belief, dst, messages)
        out = belief[src] - messages[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        fresh = np.log(out.sum(axis=1, keepdims=True) + gain * out)
        fresh -= fresh.max(axis=1, keepdims=True)
        step = 0.5 ** (1 + max(0, turn - 4 * n) // 100)
        messages, before = (1 - step) * messages + step * fresh, messages
        if np.abs(messages - before).max() < SETTLED:
            break
    belief = unary.copy()
    np.add.at(belief, dst, messages)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def rare_shapes(text: str, field: Field) -> list[str]:
    """Shapes of tokens that no pattern found, as far as the field does not hold them itself."""
    if all(shape(text[s:e]) in field.shapes for s, e in candidates(text)):
        return []
    _, tokens, labels = observed(text)
    return sorted({shape(text[s:e]) for (s, e), label in zip(tokens, labels.tolist()) if not label} - field.shapes.keys())


def all_spans(text: str, field: Field, rare: dict | None = None) -> list[tuple[int, int, int, bool]]:
    """Base spans and those that the field adds, ``(kind, start, end, is base)``, by kind and place.

    ``rare`` has the potentials of shapes that the field does not hold itself.
    """
    base, tokens, labels = observed(text)
    spans = [(*s, True) for s in base]
    if (labels == 0).any():
        shapes = field.shapes | rare if rare else field.shapes
        unary = np.array([shapes.get(shape(text[s:e]), field.unseen) for s, e in tokens])
        known = labels > 0
        unary[known] = -20.0
        unary[known, labels[known]] = 0.0
        skip = ties(text, tokens)
        chain = [(i, i + 1) for i in range(len(tokens) - 1)]
        gains = np.array([field.chain] * len(chain) + [field.skip] * len(skip))
        belief = marginals(unary, chain + skip, gains)
        added, before = [], -1
        for n in np.flatnonzero((labels == 0) & (belief[:, 1:].max(axis=1) > MIN_MARGINAL)).tolist():
            kind, (start, end) = int(belief[n, 1:].argmax()), tokens[n]
            if before == n - 1 and added and added[-1][0] == kind and not text[added[-1][2] : start].strip(" ().-"):
                added[-1][2] = end  # the next part of the same number
            else:
                added.append([kind, start, end])
            before = n
        spans += [(*s, False) for s in added]
    return sorted(spans)


def _counts(batches):
    """Shapes by label, and how often neighbours and tied tokens agree, per batch."""
    for batch in batches:
        found = {}
        for text in filled(batch["text"]):
            text = text.as_py()
            _, tokens, labels = observed(text)
            for (start, end), label in zip(tokens, labels.tolist()):
                key = ("shape", shape(text[start:end]), label)
                found[key] = found.get(key, 0) + 1
            for what, edges in (("chain", [(i, i + 1) for i in range(len(tokens) - 1)]), ("skip", ties(text, tokens))):
                for a, b in edges:
                    if labels[a] or labels[b]:
                        key = (what, "", int(labels[a] == labels[b]))
                        found[key] = found.get(key, 0) + 1
        columns = list(zip(*((*k, n) for k, n in found.items()))) or [[], [], [], []]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["what", "shape", "label", "n"])


def fit(docs: DataFrame, max_shapes: int = MAX_SHAPES) -> Field:
    """Potentials from the labels that the patterns give, over all documents.

    A shape's potential is the log share of its labels, with one observation of
    the overall shares added. The overall shares and the agreement count every
    shape and document; the ``max_shapes`` most frequent shapes are held by the
    field, all others stay a table.
    """
    able = docs.where(F.col("text").rlike("[0-9@]")).select("text")
    counts = able.mapInArrow(_counts, "what string, shape string, label int, n long").groupBy("what", "shape", "label").agg(F.sum("n").alias("n"))
    counts = staged(counts, "shape-counts")
    overall, agreement = np.ones(len(KINDS) + 1), {"chain": [1, 1], "skip": list(AGREEMENT_PRIOR)}
    for r in counts.groupBy("what", "label").agg(F.sum("n").alias("n")).collect():  # one row per label
        (overall if r.what == "shape" else agreement[r.what])[r.label] += r.n
    prior = overall / overall.sum()
    gain = {w: float(np.clip(np.log(yes / no), 0, 6)) for w, (no, yes) in agreement.items()}
    by_label = F.array(*(F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)) for k in range(len(KINDS) + 1)))
    shapes = counts.where("what = 'shape'").groupBy("shape").agg(F.sum("n").alias("total"), by_label.alias("counts"))
    held = shapes.orderBy(F.desc("total"), "shape").limit(max_shapes).collect()
    rare = None
    if len(held) == max_shapes:
        total, last = F.col("total"), held[-1]
        rare = staged(shapes.where((total < last.total) | (total == last.total) & (F.col("shape") > last.shape)).drop("total"), "rare-shapes")
        rare = None if rare.isEmpty() else rare
    return Field({r.shape: potential(np.array(r.counts), prior) for r in held}, np.log(prior), gain["chain"], gain["skip"], rare)


_KIND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def _marks(text: str, rare, field: Field, prior: np.ndarray, partial: bool) -> list[dict] | None:
    if partial and rare_shapes(text, field):
        return None
    own = {r["shape"]: potential(np.array(r["counts"]), prior) for r in rare or ()}
    return [{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in all_spans(text, field, own)]


def finder(field: Field, partial: bool = False):
    """The UDF: spans of texts and the counts of their rare shapes; null for texts with rare shapes if ``partial``."""
    prior = np.exp(field.unseen)

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array, rare: pa.Array) -> pa.Array:
        return pa.array([_marks(t.as_py(), own.as_py(), field, prior, partial) for t, own in zip(filled(texts), rare)], _KIND)

    # A filter on the result of a deterministic function would run it a second time.
    return spans.asNondeterministic() if partial else spans


def hider(field: Field, partial: bool = False):
    """Finds the spans and covers them in one worker, which hands back small parts; else like ``finder``."""
    prior = np.exp(field.unseen)

    @F.arrow_udf(f"struct<spans:{SPANS},hidden:string>")
    def both(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, rare in batches:
            at = 0
            for part in slices(filled(texts)):
                out = []
                for value, own in zip(texts.slice(at, len(part)), rare.slice(at, len(part))):
                    value = value.as_py()
                    marks = _marks(value or "", own.as_py(), field, prior, partial)
                    out.append(None if marks is None else {"spans": marks, "hidden": _covered(value, marks)})
                yield pa.array(out, pa.struct([("spans", _KIND), ("hidden", pa.string())]))
                at += len(part)

    return both.asNondeterministic() if partial else both


def _lacking(field: Field):
    @F.arrow_udf("array<string>")
    def lacking(texts: pa.Array) -> pa.Array:
        return pa.array([rare_shapes(text.as_py(), field) for text in filled(texts)], pa.list_(pa.string()))

    return lacking.asNondeterministic()


def _with_found(docs: DataFrame, field: Field, text: str, name: str, udf) -> DataFrame:
    """``docs`` with the result of ``udf`` (``finder`` or ``hider``) as the column ``name``."""
    none = F.lit(None).cast(RARE)
    if field.rare is None:
        return docs.withColumn(name, udf(field)(F.col(text), none))
    own, value = replace(field, rare=None), F.col("doc").getField(text)
    found = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    plain = found.select("doc", udf(own, partial=True)(value, none).alias("found")).where("found IS NOT NULL")
    some = found.select("doc", _lacking(own)(value).alias("shapes")).where(F.size("shapes") > 0)
    some = staged(some.withColumn("digest", F.unhex(F.sha2(value, 256))), "rare-texts")
    wanted = some.select("digest", F.explode("shapes").alias("shape")).distinct().join(field.rare, "shape")
    wanted = wanted.groupBy("digest").agg(F.collect_list(F.struct("shape", "counts")).alias("rare"))
    some = some.join(wanted, "digest", "left").select("doc", udf(own)(value, F.col("rare")).alias("found"))
    columns = {c: F.col("doc").getField(c) for c in docs.columns if c.lower() != name.lower()} | {name: F.col("found")}
    return plain.unionByName(some).select(*(c.alias(n) for n, c in columns.items()))


def with_spans(docs: DataFrame, field: Field, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with the personal data of each whole text, in code points, by kind and place.

    ``base`` tells the spans of the patterns from those that the random field
    adds. Null and empty texts have none. Only rows whose texts have shapes that
    the field does not hold itself are staged and joined with the counts of these.
    """
    return _with_found(docs, field, text, spans, finder)


def _covered(value: str | None, marks: list[dict] | None) -> str | None:
    if not value or not marks:
        return value
    parts, last = [], 0
    merged = []
    for m in sorted(marks, key=lambda m: (m["start"], -m["end"], m["kind"])):
        if merged and m["start"] < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], m["end"])
        else:
            merged.append([m["start"], m["end"], m["kind"]])
    for start, end, kind in merged:
        parts += [value[last:start], f"[{kind.upper()}]"]
        last = end
    return "".join(parts) + value[last:]


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span's stretch as ``[KIND]``; overlapping spans become one, named by the first."""

    @F.arrow_udf("string")
    def cover(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([_covered(value.as_py(), marks.as_py()) for value, marks in zip(texts, found)], pa.string())

    return cover(text, spans)


def with_redacted(docs: DataFrame, field: Field, text: str = "text", spans: str = "spans", hidden: str = "hidden") -> DataFrame:
    """``docs`` with ``spans`` and ``hidden``: ``with_spans``, then ``redacted``, in one pass.

    A task needs one Python worker for it, where the two by themselves take two
    and send each text to both.
    """
    both = _with_found(docs, field, text, "_found", hider)
    return both.withColumn(spans, F.col("_found.spans")).withColumn(hidden, F.col("_found.hidden")).drop("_found")
