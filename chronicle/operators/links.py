"""The link graph of a table of pages: edges, bounded pagination, look-ups."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from chronicle.functions.sqltext import bind, first_of, quote
from chronicle.functions.urls import canonical_url, host_allowed, resolve_url
from chronicle.operators.extraction import Element, in_order, with_nodes
from chronicle.shared import staged

# Which links lead to records and which to the next listing page.
PAGE_BASE = Element("base")
DETAIL_LINK = Element("a", classes=("obituary-item__name",))
DETAIL_LINK_PLACES = (
    Element("a", inside=Element("div", classes=("obituary-item",))),
    Element("a", inside=Element("h2", classes=("obituary__name",))),
)
DETAIL_HREF_PART = "/obituaries/"
NEXT_LINKS = (
    Element("a", values=(("rel", "next"),)),
    Element("a", classes=("pagination__next",)),
    Element("a", inside=Element("li", classes=("next",))),
    Element("a", class_parts=("next",)),
)
MAX_LISTING_PAGES = 5


def _hrefs(elements: str) -> str:
    return f"transform(filter({elements}, n -> n.href IS NOT NULL), n -> n.href)"


def detail_links(
    nodes: str = "nodes",
    primary: Element = DETAIL_LINK,
    places: Sequence[Element] = DETAIL_LINK_PLACES,
    href_part: str = DETAIL_HREF_PART,
) -> Column:
    """Links to record pages in document order; the wider patterns count only
    where the primary one finds nothing."""
    named = f"filter({nodes}, n -> coalesce(n.tag = 'a' AND contains(n.href, {quote(href_part)}), false))"
    wider = in_order(f"concat({', '.join([named, *[p.select(nodes) for p in places]])})")
    choice = f"CASE WHEN size(best) > 0 THEN best ELSE {_hrefs(wider)} END"
    return F.expr(bind(_hrefs(primary.select(nodes)), "best", choice))


def next_link(nodes: str = "nodes", places: Sequence[Element] = NEXT_LINKS) -> Column:
    """The link to the next listing page: the first pattern whose first link
    has a non-empty target."""
    return F.expr(first_of([f"get({_hrefs(p.select(nodes))}, 0)" for p in places], "c <> ''"))


def page_links(pages: DataFrame, **patterns) -> DataFrame:
    """Per page the resolved record links (``details``, duplicates kept) and the
    next listing page (``next_url``). No shuffle: a page's links stay in its row.

    Links are relative to the page's URL, or to the base it names.
    """
    named_base = F.expr(f"get({_hrefs(PAGE_BASE.select('nodes'))}, 0)")
    found = with_nodes(pages).select(
        "page_id",
        "url",
        named_base.alias("named_base"),
        detail_links(**patterns).alias("hrefs"),
        next_link().alias("next_href"),
    )
    base = f"coalesce({resolve_url('url', 'named_base')}, url)"
    based = found.select("page_id", "url", "hrefs", "next_href", F.expr(base).alias("base"))
    return based.select(
        "page_id",
        "url",
        F.expr(f"transform(hrefs, h -> {resolve_url('base', 'h')})").alias("details"),
        F.expr(resolve_url("base", "next_href")).alias("next_url"),
    )


def edges(links: DataFrame) -> DataFrame:
    """``src_url, dst_url, kind`` rows, one per link found."""
    both = F.concat(
        F.transform("details", lambda d: F.struct(d.alias("dst_url"), F.lit("detail").alias("kind"))),
        F.when(
            F.col("next_url").isNotNull(),
            F.array(F.struct(F.col("next_url").alias("dst_url"), F.lit("next").alias("kind"))),
        ).otherwise(F.array()),
    )
    return links.select(F.col("url").alias("src_url"), F.inline(both))


def links_per_page(links: DataFrame) -> DataFrame:
    """Number of record links found on each page."""
    return links.select("page_id", "url", F.size("details").cast("long").alias("n_links"))


def allowed_targets(edge_rows: DataFrame, domains: Sequence[str]) -> DataFrame:
    """Only edges whose target lies on an allowed host."""
    return edge_rows.where(host_allowed(F.col("dst_url"), domains))


def distinct_targets(edge_rows: DataFrame) -> DataFrame:
    """Each target page once, as its comparison form and one of its spellings."""
    return edge_rows.groupBy(canonical_url("dst_url").alias("page_key")).agg(
        F.min("dst_url").alias("dst_url")
    )


def reached_listings(
    links: DataFrame, starts: DataFrame, max_pages: int = MAX_LISTING_PAGES
) -> DataFrame:
    """Listing pages reached from each start by next links, at most
    ``max_pages`` hops counting the start, as ``start_url, url, page_key, hop``.

    ``links`` is read once: its next links are stored as a small table that every
    hop joins with the pages reached last. A page that a start has reached
    before is not followed again, so circles end, and a hop that reaches
    nothing new is the last one.
    """
    steps = staged(
        links.where(F.col("next_url").isNotNull())
        .groupBy(canonical_url("url").alias("from_key"), canonical_url("next_url").alias("page_key"))
        .agg(F.min("next_url").alias("url")),
        "next-links",
    )
    first = starts.groupBy(F.col("url").alias("start_url")).agg(F.first("url").alias("url"))
    frontier = staged(first.select("start_url", "url", canonical_url("url").alias("page_key"), F.lit(1).alias("hop")), "reached")
    reached = frontier
    for hop in range(2, max_pages + 1):
        onward = frontier.select("start_url", F.col("page_key").alias("from_key")).join(steps, "from_key")
        fresh = onward.join(reached, ["start_url", "page_key"], "left_anti")
        fresh = fresh.groupBy("start_url", "page_key").agg(F.min("url").alias("url"))
        fresh, seen = fresh.select("start_url", "url", "page_key", F.lit(hop).alias("hop")), Observation()
        frontier = staged(fresh.observe(seen, F.count(F.lit(1)).alias("rows")), "reached")
        if not seen.get["rows"]:
            break
        reached = reached.unionByName(frontier)
    return reached


def selected_pages(pages: DataFrame, targets: DataFrame) -> DataFrame:
    """The pages that ``targets`` point to, one row per page row."""
    keyed = pages.withColumn("page_key", canonical_url("url"))
    return keyed.join(targets.select("page_key"), "page_key", "left_semi").drop("page_key")


def unfetched(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """Targets for which there is no page yet."""
    known = pages.select(canonical_url("url").alias("page_key")).distinct()
    return targets.join(known, "page_key", "left_anti")


def pages_to_extract(
    pages: DataFrame,
    links: DataFrame,
    starts: DataFrame,
    domains: Sequence[str],
    max_pages: int = MAX_LISTING_PAGES,
) -> DataFrame:
    """The record pages linked from all listing pages that are reached."""
    reached = reached_listings(links, starts, max_pages).select("page_key").distinct()
    on_reached = (
        links.withColumn("page_key", canonical_url("url"))
        .join(reached, "page_key", "left_semi")
        .drop("page_key")
    )
    details = edges(on_reached).where(F.col("kind") == "detail")
    return selected_pages(pages, distinct_targets(allowed_targets(details, domains)))
