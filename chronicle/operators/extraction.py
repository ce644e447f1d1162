"""Extracting the fields of a record from a table of pages.

Selections are SQL over the node array of a page (see ``functions.html``). Each
page is read once and all fields come from the same array.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronicle.functions.dates import normalize_date
from chronicle.functions.html import html_nodes
from chronicle.functions.sqltext import bind, first_of, quote, stripped


def _below(nodes: str, element: str) -> str:
    """An element and its descendants. Nodes are stored by position, so this is
    a slice and needs no search."""
    return f"slice({nodes}, {element}.ord + 1, {element}.last - {element}.ord + 1)"


def in_order(found: str) -> str:
    """Nodes without repeats in document order; the position is their first field."""
    return f"array_sort(array_distinct({found}))"


@dataclass(frozen=True)
class Element:
    """Which elements are meant: tag, whole class names, parts of the class
    attribute, exact attribute values, and an element they must lie inside.

    The methods give SQL text; ``nodes`` names the node array of a page.
    """

    tag: str
    classes: tuple[str, ...] = ()
    class_parts: tuple[str, ...] = ()
    values: tuple[tuple[str, str], ...] = ()
    inside: "Element | None" = None

    def fits(self, node: str) -> str:
        """Whether a node is meant, as far as the node itself shows."""
        words = f"concat(' ', translate({node}.class, {quote(chr(9) + chr(10) + chr(13) + chr(12))}, '    '), ' ')"
        tests = [f"{node}.tag = {quote(self.tag)}"]
        tests += [f"contains({words}, {quote(f' {name} ')})" for name in self.classes]
        tests += [f"contains({node}.class, {quote(part)})" for part in self.class_parts]
        tests += [f"{node}.{attribute} = {quote(value)}" for attribute, value in self.values]
        return f"coalesce({' AND '.join(tests)}, false)"

    def select(self, nodes: str) -> str:
        """The matching nodes in document order."""
        if self.inside is None:
            return f"filter({nodes}, n -> {self.fits('n')})"
        inner = f"filter({_below(nodes, 'e')}, n -> n.ord <> e.ord AND {self.fits('n')})"
        return in_order(f"flatten(transform({self.inside.select(nodes)}, e -> {inner}))")

    def direct_texts(self, nodes: str) -> str:
        """The texts directly inside the matching elements, in document order."""
        if self.inside is None:
            parent_fits = self.fits(f"get({nodes}, t.parent)")
            kept = f"filter({nodes}, t -> t.tag = '#text' AND {parent_fits})"
        else:
            own = f"filter({_below(nodes, 'e')}, t -> t.tag = '#text' AND t.parent = e.ord)"
            kept = in_order(f"flatten(transform({self.select(nodes)}, e -> {own}))")
        return f"transform({kept}, t -> t.text)"

    def all_texts(self, nodes: str) -> str:
        """All texts inside the matching elements, one element after the other."""
        inner = f"filter({_below(nodes, 'e')}, t -> t.tag = '#text')"
        return f"flatten(transform({self.select(nodes)}, e -> transform({inner}, t -> t.text)))"


# Where the fields are found on a page, best place first.
NAME_PLACES = (
    Element("p", classes=("my-auto", "h1", "text-white", "font-weight-bolder")),
    Element("p", class_parts=("my-auto", "h1")),
    Element("p", class_parts=("font-weight-bolder",), inside=Element("div", class_parts=("obit-main-info",))),
)
NAME_HEADING = Element("h1")
NAME_SUFFIX = " Obituary"
DATE_PLACE = Element("p", class_parts=("mt-2", "mb-1", "text-white"))
DATE_SEPARATORS = ("-", "–")
AGE_WORDS = "years old"
BODY_PLACES = (
    Element("div", class_parts=("obit-text",)),
    Element("div", class_parts=("obituary-text",)),
    Element("div", values=(("itemprop", "description"),)),
    Element("div", class_parts=("obit-content",)),
    Element("section", class_parts=("obit",)),
)
BODY_PARAGRAPH = Element("p")
BODY_MIN_LENGTH = 100


def with_nodes(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the markup by the page's node array, column ``nodes``."""
    return pages.withColumn("nodes", html_nodes(F.col(html))).drop(html)


def page_nodes(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """The nodes of all pages as rows."""
    return with_nodes(pages).select(key, F.inline("nodes"))


def _joined(texts: str) -> str:
    """Texts stripped and joined by a blank, blank ones left out."""
    return f"array_join(filter(transform({texts}, t -> {stripped('t')}), t -> t <> ''), ' ')"


def extract_name(
    nodes: str = "nodes",
    places: Sequence[Element] = NAME_PLACES,
    heading: Element = NAME_HEADING,
    suffix: str = NAME_SUFFIX,
) -> Column:
    """The first place with a direct text decides; when it is blank or there is
    none, the heading without its suffix word."""
    firsts = [f"get({p.direct_texts(nodes)}, 0)" for p in places]
    placed = stripped(first_of(firsts, "c IS NOT NULL"))
    title = f"get({heading.direct_texts(nodes)}, 0)"
    titled = stripped(f"replace({title}, {quote(suffix)}, '')")
    return F.expr(bind(placed, "p", f"CASE WHEN p <> '' THEN p ELSE coalesce({titled}, p) END"))


def date_texts(
    nodes: str = "nodes",
    place: Element = DATE_PLACE,
    separators: Sequence[str] = DATE_SEPARATORS,
    age_words: str = AGE_WORDS,
) -> Column:
    """The texts of the date block that are neither blank, nor a separator, nor
    an age; birth comes first, death second."""
    texts = f"transform({place.all_texts(nodes)}, t -> {stripped('t')})"
    marks = ", ".join(quote(s) for s in ("", *separators))
    return F.expr(f"filter({texts}, t -> t NOT IN ({marks}) AND NOT contains(t, {quote(age_words)}))")


def container_text(place: Element, nodes: str = "nodes") -> Column:
    """All text inside the matching elements, null when there is none."""
    return F.expr(first_of([_joined(place.all_texts(nodes))], "c <> ''"))


def longest_paragraph(
    nodes: str = "nodes", paragraph: Element = BODY_PARAGRAPH, min_length: int = BODY_MIN_LENGTH
) -> Column:
    """The longest direct paragraph text, if longer than ``min_length``."""
    texts = paragraph.direct_texts(nodes)
    longest = (
        f"aggregate({texts}, cast(NULL AS string), "
        "(best, t) -> CASE WHEN length(best) >= length(t) THEN best ELSE t END)"
    )
    return F.expr(bind(longest, "p", f"CASE WHEN length(p) > {min_length} THEN {stripped('p')} END"))


def extract_text(nodes: str = "nodes", places: Sequence[Element] = BODY_PLACES) -> Column:
    """The first container with text, else the longest paragraph."""
    contained = first_of([_joined(p.all_texts(nodes)) for p in places], "c <> ''")
    return F.coalesce(F.expr(contained), longest_paragraph(nodes))


def extract_records(pages: DataFrame, run_ts: str, keep: Sequence[str] = ()) -> DataFrame:
    """One record per page; ``keep`` names page columns to carry along."""
    found = with_nodes(pages).select(
        *keep,
        "url",
        extract_name().alias("full_name"),
        date_texts().alias("dates"),
        extract_text().alias("obituary_text"),
    )
    return found.select(
        *keep,
        "full_name",
        normalize_date(F.get("dates", 0)).alias("date_of_birth"),
        normalize_date(F.get("dates", 1)).alias("date_of_death"),
        "obituary_text",
        F.col("url").alias("source_url"),
        F.lit(run_ts).alias("scraped_at"),
    )
