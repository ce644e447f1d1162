"""URL verdicts: fixed host and path rules first, mined token rules for the rest."""

from math import log, sqrt

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicle.shared import staged

#: A rule needs this many bad URLs, however many URLs are labelled.
MIN_BAD = 10
MIN_CONFIDENCE = 0.6
#: Tokens that FP-growth mines together: a URL with more useful ones is mined in pairs of blocks of half as many, and
#: what lies in no pair is grown.
TOGETHER = 8
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and the rest of a URL; all empty without ``://`` or for a null."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substr(rest, F.length(host) + 1)
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), path, F.substr(tail, F.length(path) + 1)


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL: scheme, host labels, path segments, query keys."""
    host, path, rest = split_url(url)

    def tagged(tag: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    scheme = F.coalesce(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1), F.lit(""))
    query = F.split(F.regexp_extract(rest, r"^\?([^#]*)", 1), "&")
    return F.array_distinct(
        F.concat(
            tagged("scheme ", F.array(F.lower(scheme))),
            tagged("host ", F.split(host, r"\.")),
            tagged("path ", F.split(path, "/")),
            tagged("key ", F.transform(query, lambda x: F.substring_index(x, "=", 1))),
        )
    )


def fixed_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Name and verdict of the longest of ``rules`` (verdict, host, path) that fits, else null.

    A rule fits its host and all subdomains where the path starts with the rule's.
    """
    name = verdict = None
    for act, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, act) if verdict is None else verdict.when(fits, act)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _labelled_sets(labelled: DataFrame) -> DataFrame:
    """``tokens, n, bad``: the different sets of tokens, with all and bad URLs that have them."""
    rows = labelled.where("url IS NOT NULL AND bad IS NOT NULL").select(F.array_sort(tokens(F.col("url"))).alias("tokens"), "bad")
    return rows.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"))


def _share_of_bad(sets: DataFrame) -> float:
    n, bad = sets.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    return bad / n if n else 0.0


def _useful_tokens(sets: DataFrame, min_bad: int) -> DataFrame:
    """``token, n, bad`` of tokens that are in ``min_bad`` bad URLs, as each token of a rule is; of tokens that are in
    exactly the same sets only the first. How often a token is bad by itself does not matter: two harmless ones may be
    bad together."""
    one = F.xxhash64("tokens").cast("decimal(38,0)")
    each = sets.select(F.explode("tokens").alias("token"), "n", "bad", one.alias("set"))
    each = each.groupBy("token").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("sets"), F.sum("set").alias("set"))
    useful = each.where(F.col("bad") >= min_bad)
    return useful.groupBy("n", "bad", "sets", "set").agg(F.min("token").alias("token")).select("token", "n", "bad")


def _holding(sets: DataFrame, antecedents: DataFrame) -> DataFrame:
    """Each of ``sets`` (``tokens``) with each antecedent (``antecedent``, ``anchor``) whose tokens it has.

    The index leads from an antecedent's rarest token, its anchor, to the
    antecedent, so a common token finds nothing by itself.
    """
    found = sets.select("*", F.explode("tokens").alias("anchor")).join(antecedents, "anchor")
    return found.where(F.size(F.array_except("antecedent", "tokens")) == 0)


def _judged_antecedents(sets: DataFrame, antecedents: DataFrame) -> DataFrame:
    """``antecedents`` with exact ``n`` and ``bad`` over all of ``sets``."""
    found = _holding(sets, antecedents.select("antecedent", "anchor"))
    return found.groupBy("antecedent", "anchor").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def _sure(base: float, tried: int) -> Column:
    """More bad URLs among ``n`` than chance explains, given how many antecedents were tried."""
    expected, spread = F.col("n") * base, F.sqrt(F.col("n") * base * (1 - base))
    return F.col("bad") - expected >= spread * sqrt(2 * log(max(tried, 2)) + 4)


def _bad_items(sets: DataFrame, useful: DataFrame) -> DataFrame:
    """``items, bad``: the useful tokens of each set that bad URLs have, in order."""
    own = sets.where("bad > 0").select(F.xxhash64("tokens").alias("set"), "bad", F.explode("tokens").alias("token"))
    return own.join(useful.select("token"), "token").groupBy("set", "bad").agg(F.array_sort(F.collect_list("token")).alias("items")).drop("set")


def _transactions(own: DataFrame) -> DataFrame:
    """``items``: the useful tokens of each bad URL, at most ``TOGETHER`` in a row.

    The tokens of a longer URL are cut into blocks, and each pair of blocks is a
    row: any two of its tokens meet in one. Counts of such rows are only used to
    propose antecedents, which are counted exactly afterwards; what lies in more
    than two blocks is proposed by ``_grown``.
    """
    half = TOGETHER // 2
    blocks = F.transform(F.sequence(F.lit(0), F.expr(f"(size(items) - 1) div {half}")), lambda k: F.slice("items", k * half + 1, F.lit(half)))
    pairs = "flatten(transform(sequence(0, size(b) - 2), i -> transform(sequence(i + 1, size(b) - 1), j -> concat(b[i], b[j]))))"
    rows = own.withColumn("b", blocks).withColumn(
        "parts", F.expr(f"CASE WHEN size(items) <= {TOGETHER} THEN array(items) ELSE {pairs} END")
    )
    return rows.select(F.explode("parts").alias("items"), "bad").where("size(items) > 1").select("items", F.explode(F.sequence(F.lit(1), "bad"))).select("items")


def _grown(own: DataFrame, min_bad: int) -> DataFrame | None:
    """``antecedent``: all combinations in ``min_bad`` bad URLs that a URL of more than ``TOGETHER`` useful tokens has;
    null where no URL is that long.

    They grow by one token a round, each from its own first tokens, and are counted over all of ``own``. What is
    too rare, or in no long URL, is so with every further token, and does not grow.
    """
    if own.where(F.size("items") > TOGETHER).isEmpty():
        return None
    held = own.select("items", "bad", F.explode("items").alias("token")).select("items", "bad", F.array("token").alias("antecedent"))
    found = None
    while True:
        later = F.filter("items", lambda x: x > F.element_at("antecedent", -1))
        wider = held.select("items", "bad", "antecedent", F.explode(later).alias("token"))
        wider = wider.select("items", "bad", F.concat("antecedent", F.array("token")).alias("antecedent"))
        counted = wider.groupBy("antecedent").agg(F.sum("bad").alias("n_bad"), F.max(F.size("items")).alias("longest"))
        level = staged(counted.where((F.col("n_bad") >= min_bad) & (F.col("longest") > TOGETHER)).select("antecedent"), "grown-antecedents")
        if level.isEmpty():
            return found
        found = level if found is None else found.unionByName(level)
        held = staged(wider.join(level, "antecedent"), "grown-sets").select("items", "bad", "antecedent")


def mined_rules(labelled: DataFrame, min_bad: int = MIN_BAD, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Token combinations that mark bad URLs: ``rule_id, antecedent, anchor, n, bad, confidence``.

    ``labelled`` has ``url`` and ``bad`` (boolean); rows with a null in either
    are left out. A rule is in ``min_bad`` bad URLs, ``min_confidence`` of its
    URLs are bad, and that is more than chance would give among as many
    combinations as were tried. What a shorter rule implies is left out.

    Single tokens are counted first. Those that are no rule by themselves are
    combined by FP-growth over the bad URLs that no single token marks. Tokens
    that always stand together count as one. Long URLs are mined in parts, and
    combinations that lie in no part are grown token by token: rules of any
    length are complete. Matching always looks at whole URLs.
    """
    sets = staged(_labelled_sets(labelled), "url-sets")
    base = _share_of_bad(sets)
    useful = staged(_useful_tokens(sets, min_bad), "url-tokens")
    good_enough = (F.col("bad") >= min_bad) & (F.col("bad") >= F.col("n") * min_confidence)
    single = useful.where(good_enough & _sure(base, useful.count()))
    single = staged(single.select(F.array("token").alias("antecedent"), F.col("token").alias("anchor"), "n", "bad"), "single-rules")

    marked = _holding(sets, single.select("antecedent", "anchor")).select("tokens").distinct()
    rest = staged(sets.join(marked, "tokens", "left_anti"), "unmarked-sets")
    left = staged(_useful_tokens(rest, min_bad), "url-tokens")
    own = staged(_bad_items(rest, left), "bad-items")
    rows = staged(_transactions(own), "url-transactions")
    total = rows.count()
    rules = single
    if total:
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, min_bad / total), minConfidence=1.0).fit(rows)
        proposed = model.freqItemsets.where(F.size("items") > 1).select(F.array_sort("items").alias("antecedent"))
        grown = _grown(own, min_bad)
        proposed = (proposed if grown is None else proposed.unionByName(grown)).distinct()
        rarity = left.select(F.col("token").alias("anchor"), F.col("n").alias("anchor_n"))
        anchors = proposed.select("antecedent", F.explode("antecedent").alias("anchor")).join(rarity, "anchor")
        anchors = anchors.groupBy("antecedent").agg(F.min_by("anchor", F.struct("anchor_n", "anchor")).alias("anchor"))
        longer = staged(_judged_antecedents(sets, anchors), "proposed-rules")
        longer = longer.where(good_enough & _sure(base, longer.count()))
        rules = rules.unionByName(staged(longer, "longer-rules"))
    # A rule that holds another one says nothing more.
    inner = rules.select("antecedent", "anchor")
    implied = _holding(rules.select(F.col("antecedent").alias("tokens")), inner).where(F.size("tokens") > F.size("antecedent"))
    kept = rules.join(implied.select(F.col("tokens").alias("antecedent")).distinct(), "antecedent", "left_anti")
    kept = kept.select(F.xxhash64("antecedent").alias("rule_id"), "antecedent", "anchor", "n", "bad", (F.col("bad") / F.col("n")).alias("confidence"))
    return staged(kept, "mined-rules")


def matched_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct urls of ``pages`` that hold all tokens of a mined rule, found by the rules' rarest tokens."""
    urls = pages.select("url").where("url IS NOT NULL").distinct().withColumn("tokens", tokens(F.col("url")))
    return _holding(urls, rules.select("antecedent", "anchor")).select("url").distinct()


def judged(pages: DataFrame, labels: DataFrame, rules, min_bad: int = MIN_BAD, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages`` (``page_id``, ``url``).

    The fixed rule that fits decides; without one a URL is blocked when a rule
    mined from ``labels`` (``page_id``, ``bad``) matches it, and allowed
    otherwise. Null urls and those without ``://`` have an empty host and path
    and fit no fixed rule. Repeated rows are judged each; with no labels
    nothing is mined and the rest is allowed.
    """
    pages = pages.select("page_id", "url")
    marks = labels.where("page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    mined = mined_rules(pages.join(marks, "page_id"), min_bad, min_confidence)
    blocked = matched_urls(pages, mined).withColumn("mined", F.lit(True))
    host, path, _ = split_url(F.col("url"))
    rows = pages.join(blocked, "url", "left").select("page_id", host.alias("host"), path.alias("path"), "mined")
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("mined"), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
