"""Edges, pagination and look-ups on small link graphs."""

from chronicle.operators import links
from chronicle.shared import staged

SITE = "https://www.example.org"


def page_links(spark, pages):
    rows = [(i, url, html) for i, (url, html) in enumerate(pages)]
    return links.page_links(spark.createDataFrame(rows, "page_id long, url string, html string"))


def one(spark, html, url=f"{SITE}/us/obituaries"):
    return page_links(spark, [(url, html)]).first()


def test_class_links_win(spark):
    row = one(spark, '<a class="big obituary-item__name" href="a-1">x</a><a href="/obituaries/b">y</a>')
    assert row.details == [f"{SITE}/us/a-1"]


def test_fallback_links_in_document_order_without_repeats(spark):
    html = (
        '<a href="/z">no</a><h2 class="obituary__name"><a href="/two">2</a></h2>'
        '<div class="obituary-item"><a href="/obituaries/three">3</a><a>none</a></div><a href="/obituaries/four">4</a>'
    )
    assert one(spark, html).details == [f"{SITE}{p}" for p in ("/two", "/obituaries/three", "/obituaries/four")]


def test_links_are_relative_to_the_base_of_the_page(spark):
    row = one(spark, '<head><base href="/else/"></head><a class="obituary-item__name" href="a">x</a><a rel=next href="?p=2">n</a>')
    assert (row.details, row.next_url) == ([f"{SITE}/else/a"], f"{SITE}/else/?p=2")


def test_next_link_patterns_in_order(spark):
    cases = {
        '<a class="x-next" href="/4">a</a><a rel="next" href="/1">b</a>': "/1",
        '<a rel="next" href="">a</a><a class="pagination__next" href="/2">b</a>': "/2",
        '<li class="a next"><span><a href="/3">a</a></span></li>': "/3",
        '<a class="go-next" href="?page=2">a</a>': "/us/obituaries?page=2",
        '<a rel="nextish" href="/n">a</a>': None,
        '<a rel="next">a</a>': None,
    }
    rows = page_links(spark, [(f"{SITE}/us/obituaries", html) for html in cases]).collect()
    got = [r.next_url for r in sorted(rows, key=lambda r: r.page_id)]
    assert got == [v and SITE + v for v in cases.values()]


def chain(spark, n, loop_to=None):
    pages = []
    for i in range(1, n + 1):
        target = i + 1 if i < n else loop_to
        link = f'<a rel="next" href="/p/{target}">n</a>' if target else ""
        pages.append((f"{SITE}/p/{i}", link + f'<a class="obituary-item__name" href="/d/{i}">d</a>'))
    return staged(page_links(spark, pages), "links")


def starts(spark, *numbers):
    return spark.createDataFrame([(f"{SITE}/p/{i}",) for i in numbers], "url string")


def test_pagination_stops_at_five_pages(spark):
    got = links.reached_listings(chain(spark, 7), starts(spark, 1)).collect()
    assert sorted((r.hop, r.url) for r in got) == [(i, f"{SITE}/p/{i}") for i in range(1, 6)]


def test_pagination_stops_without_next(spark):
    assert links.reached_listings(chain(spark, 3), starts(spark, 2)).count() == 2


def test_pagination_survives_a_loop(spark):
    assert links.reached_listings(chain(spark, 3, loop_to=1), starts(spark, 1)).count() == 3


def test_two_starts_and_copies_of_a_page(spark):
    listings = chain(spark, 4)
    got = links.reached_listings(listings.unionByName(listings), starts(spark, 1, 3), max_pages=3)
    assert sorted((r.start_url[-1], r.url[-1], r.hop) for r in got.collect()) == [
        ("1", "1", 1), ("1", "2", 2), ("1", "3", 3), ("3", "3", 1), ("3", "4", 2),
    ]


def test_record_pages_of_all_reached_listings(spark):
    rows = [(i, f"{SITE}/d/{i}#top", "") for i in range(1, 8)] + [(99, f"{SITE}/d/1", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = links.pages_to_extract(pages, chain(spark, 7), starts(spark, 1), ["example.org"])
    assert sorted(r.page_id for r in got.collect()) == [1, 2, 3, 4, 5, 99]


def test_other_hosts_are_not_followed(spark):
    edges = links.edges(page_links(spark, [(SITE, '<a class="obituary-item__name" href="https://other.org/d">d</a>')]))
    assert edges.count() == 1
    assert links.allowed_targets(edges, ["example.org"]).count() == 0


def test_unfetched_targets(spark):
    edges = links.edges(chain(spark, 3)).where("kind = 'detail'")
    pages = spark.createDataFrame([(f"{SITE}/d/2",)], "url string")
    left = links.unfetched(links.distinct_targets(edges.unionByName(edges)), pages)
    assert sorted(r.dst_url for r in left.collect()) == [f"{SITE}/d/1", f"{SITE}/d/3"]
