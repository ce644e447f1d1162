"""Scalar functions against plain Python and the fixture tables."""

import datetime
import json
import random
import urllib.parse
from html.parser import HTMLParser

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronicle import shared
from chronicle.functions import dates, html, jsonl, sqltext, text, urls


def column(spark, values, expression, kind="string"):
    """``expression`` of each value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[1] for r in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


DATES = {
    "January 15, 1940": "1940-01-15",
    "Jan 15, 1940": "1940-01-15",
    "1940-01-15": "1940-01-15",
    None: None,
    "": None,
    "jan 5, 1940": "1940-01-05",
    "1/5/1940": "1940-01-05",
    "1940-1-5": "1940-01-05",
    "15 January 1940": "1940-01-15",
    "January  15, 1940": "1940-01-15",
    " March 10, 2026\n": "2026-03-10",
    "15 Jan 1940": "15 Jan 1940",
    "Sept 3, 1990": "Sept 3, 1990",
    "February 30, 1990": "February 30, 1990",
    "February 29, 2024": "2024-02-29",
    "13/01/1990": "13/01/1990",
    "01/15/40": "01/15/40",
    "January 15,1940": "January 15,1940",
    "Spring 1940": "Spring 1940",
    "January 015, 1940": "January 015, 1940",
    "2026-001-01": "2026-001-01",
    "12026-01-01": "12026-01-01",
    "January 1, 0000": "January 1, 0000",
    "0000-01-01": "0000-01-01",
    "0001-01-01": "0001-01-01",
    "August 28, ١٩٣٧": "1937-08-28",
    "August\xa028,\u30001937": "1937-08-28",
    "August 2٨, 1937": "1937-08-28",
    "August ٢٨, 1937": "August ٢٨, 1937",
    "８/2８/1937": "８/2８/1937",
    "𝟏937-08-28": "1937-08-28",
    "   ": "",
}


def test_normalize_date_fixtures(spark):
    assert column(spark, list(DATES), dates.normalize_date) == list(DATES.values())


def test_normalize_date_equals_strptime(spark):
    rng = random.Random(5)
    months = "January February March April May June July August September October November December".split()
    formats = ["%B %d, %Y", "%b %d, %Y", "%m/%d/%Y", "%Y-%m-%d", "%d %B %Y"]

    def by_strptime(raw):
        for f in formats:
            try:
                return datetime.datetime.strptime(raw.strip(), f).date().isoformat()  # four digits, unlike strftime
            except ValueError:
                pass
        return raw.strip()

    def foreign(number, share=0.1):
        """Some digits in another script."""
        scripts = "٠۰०０𝟎"
        return "".join(chr(ord(rng.choice(scripts)) + int(c)) if rng.random() < share else c for c in str(number))

    raws = []
    for _ in range(2500):
        m, d, y = rng.randint(0, 14), foreign(rng.randint(0, 33)), foreign(rng.choice([1000, 1900, 2024, 2025, 99, 20240, "0000", "0001"]))
        name = months[m % 12]
        name = rng.choice([name, name[:3], name[:4], name.upper(), name.lower()])
        pad = rng.choice(["", "0"])
        gap = rng.choice([" ", "  ", "\t", "\xa0", "\u2003"])
        raws.append(
            rng.choice(
                [
                    f"{name}{gap}{pad}{d}, {y}",
                    f"{pad}{m}/{d}/{y}",
                    f"{y}-{m}-{pad}{d}",
                    f"{pad}{d} {name}{gap}{y}",
                    f"{name} {d},{y}",
                    f"{name} {d}, {y} x",
                ]
            )
        )
    assert column(spark, raws, dates.normalize_date) == [by_strptime(r) for r in raws]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2026-01-15", "2026-01-15"),
        (" 2026-1-5 ", "2026-01-05"),
        ("2026/01/15", "2026-01-15"),
        ("2026-01-15T10:00:00Z", "2026-01-15"),
        ("2026", None),
        ("20260115", None),
        ("2026-01-15x", None),
        ("2026-02-30", None),
        ("Spring 1940", None),
        ("", None),
    ],
)
def test_cast_date(spark, raw, expected):
    (day,) = column(spark, [raw], dates.cast_date)
    assert (day and day.isoformat()) == expected


def test_stamp_date_in_own_offset(spark):
    stamps = [
        "2026-03-12T23:30:00-05:00",
        "2026-03-12T23:30:00Z",
        "2026-03-12",
        "20260312T233000",
        "2026-03-12 10:00:00.123456+00:00",
        "2026-02-30T00:00:00",
        "2026-03-12T25:00:00",
        "2026-03-12T10:30:59,5+05",
        "20260312 1030+053015",
        "2026-03-12T10:3",
        "2026-0312",
        "2026-W11-4T10:30Z",
        "2026W114",
        "2026-W11",
        "2020-W53-7",
        "2026-W54-1",
        "2026-W00-1",
        "yesterday",
        "",
        None,
    ]

    def by_python(s):
        try:
            return datetime.datetime.fromisoformat(s.replace("Z", "+00:00")).date()
        except (ValueError, AttributeError):
            return None

    assert column(spark, stamps, dates.stamp_date) == [by_python(s) for s in stamps]


def test_strip_equals_python(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert sorted(text.WHITE_SPACE) == sorted(spaces)
    values = [s + "a" + s + "b" + s for s in spaces] + ["", "   ", "​x​"]
    assert column(spark, values, text.strip) == [v.strip() for v in values]


def test_digit_class_equals_python(spark):
    characters = [chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x20000)]]
    got = column(spark, characters, lambda v: v.rlike(text.ANY_DIGIT))
    assert [c for c, g in zip(characters, got) if g != c.isdigit()] == []


def test_safe_name_and_shorten(spark):
    assert column(spark, ["Ana María O/Neil", None, "x" * 60], text.safe_name) == [
        "ana_maría_o-neil",
        "unknown",
        "x" * 50,
    ]
    long = "é" * 301
    assert column(spark, [long, long[:300]], lambda v: text.shorten(v, 300)) == [long[:300] + "...", long[:300]]


def test_percent_text_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (1, 1), (0, 0), (2, 3)], "a long, b long")
    got = [r[0] for r in df.select(text.percent_text(F.col("a"), F.col("b"))).collect()]
    assert got == ["12%", "38%", "100%", "—", "67%"]


def test_json_document_equals_python(spark):
    values = ["plain", 'a "quote" \\ back', "línea\nnueva\t", "", None, "日本/語 😀", " "]

    def document(v):
        return text.json_document({"name": v, "url": F.lit(None).cast("string")})

    expected = [json.dumps({"name": v, "url": None}, ensure_ascii=False, indent=2) for v in values]
    assert column(spark, values, document) == expected
    fields = {"url": F.lit(None).cast("string")}
    sizes = column(spark, values, lambda v: text.json_document_size({"name": v, **fields}))
    assert sizes == [len(e.encode()) for e in expected]


LINES = [
    '{"a":1}', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}} x {', '{"a":1},"w":5',
    "{'a':1}", '{"a":NaN}', '{"a":[-Infinity, 1]}', '{"a":01}', "5", "[1]", "", "  ", '{"a":1', "{}",
    '{"a":"x\ty"}', '  {"a":1}  ', '{"a":1,}', '{"a":1}] x {}', "null", '"s"', "{a:1}", '{"a":"\\x"}',
    '\xa0{"a":1}\x0c', '{"a":\t1}', '{"a":"}"}', '{"a":{"b":1}}', '{"a":"}"} x', '{"a":{"b":1}}{"c":2}', '{"a":"it\'s \\"so\\""}', '{"a":"b\\\\"}', '/*c*/{"a":1}', '{"a":/*c*/1}', '{"v":1,"w":0}',
]


def test_object_keys_equals_python(spark):
    def by_python(line):
        try:
            value = json.loads(line.strip())
        except json.JSONDecodeError:
            return False
        return isinstance(value, dict)

    got = column(spark, LINES, jsonl.is_object)
    assert got == [by_python(line) for line in LINES]


def test_object_keys_on_long_escaped_text(spark):
    line = json.dumps({"a": 'x\n"' * 200_000, "b": None})
    assert column(spark, [line], jsonl.object_keys) == [["a", "b"]]


def test_lines_made_up_to_look_whole(spark):
    lines = ['{"a":1},"w":0}', '{"a":1},"line":{"b":2}', '{"a":1},"w":{}}', '{"a":1}}', '{"a":{}},"x":{"y":{}']
    assert column(spark, lines, jsonl.is_object) == [False] * len(lines)


def test_missing_keys_counts_null_as_present(spark):
    lines = ['{"a":null,"b":1}', '{"b":1}', "[]"]
    got = column(spark, lines, lambda v: jsonl.missing_keys(jsonl.object_keys(v), ["a", "b", "c"]))
    assert got == [["c"], ["a", "c"], None]


def test_resolve_url_equals_python(spark):
    rng = random.Random(7)
    bases = [
        "https://www.example.org/us/obituaries",
        "http://example.org",
        "https://example.org/a/b/c?x=1#f",
        "https://h.example.org/a//b/",
        "HTTP://Example.org/x/y;p",
    ]
    links = [
        "", "/x/y", "z", "../z", "../../../z", "./z", ".", "..", "?page=2", "#top", "//other.org/p",
        "https://other.org/p?q#r", "mailto:a@b.c", "javascript:void(0)", "/a/../b/./c", "a//b", "/a//b",
        "../", "./", "x?y=/z/..", "http:rel", "a/b/../c/..",
    ]
    parts = ["a", "b", "..", ".", "", "c.html"]
    links += ["/".join(rng.choice(parts) for _ in range(rng.randint(1, 6))) for _ in range(200)]
    pairs = [(b, link) for b in bases for link in links]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, base string, link string")
    got = df.select("i", F.expr(urls.resolve_url("base", "link")).alias("r")).orderBy("i").collect()
    expected = [urllib.parse.urljoin(b, link) for b, link in pairs]
    assert [(p, g.r, e) for p, g, e in zip(pairs, got, expected) if g.r != e] == []


def test_hosts(spark):
    values = [
        "https://www.example.org/x", "http://example.org:8080", "https://badexample.org/", "/x", None,
        "https://user@WWW.Example.ORG:1/x",
    ]
    got = column(spark, values, lambda v: urls.host_allowed(v, ["example.org"]))
    assert got == [True, True, False, False, False, True]


def test_canonical_url(spark):
    values = ["HTTPS://Example.org?b=2&a=1#x", "https://example.org/?a=1&b=2", "https://example.org/A"]
    assert column(spark, values, lambda v: urls.canonical_url("v")) == [
        "https://example.org/?a=1&b=2",
        "https://example.org/?a=1&b=2",
        "https://example.org/A",
    ]


def standard_texts(markup):
    """Non-blank text pieces as the standard library's parser finds them."""

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__()
            self.pieces = []

        def handle_data(self, data):
            if data.strip():
                self.pieces.append(data.strip())

    reader = Reader()
    reader.feed(markup)
    reader.close()
    return reader.pieces


def test_nodes_hold_the_text_of_the_test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for page in pages:
        nodes = html.nodes_array(pa.array([page.html]))[0].as_py()
        ours = [n["text"].strip() for n in nodes if n["tag"] == "#text" and n["text"].strip()]
        assert "".join(ours) == "".join(standard_texts(page.html))


def texts_of(markup):
    nodes = html.nodes_array(pa.array([markup]))[0].as_py()
    return [(nodes[n["parent"]]["tag"] if n["parent"] >= 0 else None, n["text"]) for n in nodes if n["tag"] == "#text"]


@pytest.mark.parametrize(
    "markup, expected",
    [
        ("<script>1</script x><h1>N</h1>", [("script", "1"), ("h1", "N")]),
        ("<script>1</script/><h1>N</h1>", [("script", "1"), ("h1", "N")]),
        ("<script>1</script\n><h1>N</h1>", [("script", "1"), ("h1", "N")]),
        ("<script>1</scripts><b>2</b></SCRIPT>3", [("script", "1</scripts><b>2</b>"), (None, "3")]),
        ("<style>a</style x='>'>b", [("style", "a"), (None, "'>b")]),
        ("<script><!--<script>1</script>2--></script>3", [("script", "<!--<script>1</script>2-->"), (None, "3")]),
        ("<script><!--<script>1</script>2</script>3", [("script", "<!--<script>1</script>2"), (None, "3")]),
        ("<script><!--1</script>2--></script>3", [("script", "<!--1"), (None, "2-->"), (None, "3")]),
        ("<script><!--><script>1</script>2", [("script", "<!--><script>1"), (None, "2")]),
        ("<script><!--<script>1-->2</script>3", [("script", "<!--<script>1-->2"), (None, "3")]),
        ("<script>1<script>2</script>3", [("script", "1<script>2"), (None, "3")]),
        ("<script><!--<scripty>1</script>2", [("script", "<!--<scripty>1"), (None, "2")]),
        ("<title>a <b>&amp; c</title >d", [("title", "a <b>& c"), (None, "d")]),
        ("<textarea><p>x</textarea/><p>y", [("textarea", "<p>x"), ("p", "y")]),
        ("<style>&amp;</style><xmp><p></xmp>z", [("style", "&amp;"), ("xmp", "<p>"), (None, "z")]),
        ("<script>never ends <p>1</p>", [("script", "never ends <p>1</p>")]),
        ("<script></script><p>1", [("p", "1")]),
    ],
)
def test_text_elements_end_as_the_standard_says(markup, expected):
    assert texts_of(markup) == expected


def test_nodes_nest(spark):
    markup = (
        "<!-- <p>no</p> --><div class='a  b' itemprop=x>one<p>two<br>three<b>four<p>five</p>six</div>"
        "<ul><li>7<li>8</ul>a < b &amp; c<script>if (a<b) {'</p>'}</script><p title=\"a>b\">last<a href="
    )
    nodes = html.nodes_array(pa.array([markup]))[0].as_py()
    shown = [
        (n["tag"], n["text"], nodes[n["parent"]]["tag"] if n["parent"] >= 0 else None)
        for n in nodes
        if n["tag"] == "#text"
    ]
    assert shown == [
        ("#text", "one", "div"),
        ("#text", "two", "p"),
        ("#text", "three", "p"),
        ("#text", "four", "b"),
        ("#text", "five", "p"),
        ("#text", "six", "div"),
        ("#text", "7", "li"),
        ("#text", "8", "li"),
        ("#text", "a < b & c", None),
        ("#text", "if (a<b) {'</p>'}", "script"),
        ("#text", "last", "p"),
    ]
    div = nodes[0]
    assert (div["class"], div["itemprop"]) == ("a  b", "x")
    assert [n["text"] for n in nodes[: div["last"] + 1] if n["text"]][-1] == "six"


def test_first_of_stops_at_the_first_that_fits(spark):
    """A later candidate that would fail is not computed."""
    chosen = sqltext.first_of(["nullif(v, 'no')", "upper(v)", "raise_error('computed')"], "c <> ''")
    assert column(spark, ["yes", "no"], lambda v: F.expr(chosen)) == ["yes", "NO"]
    assert column(spark, ["", None], lambda v: F.expr(sqltext.first_of(["v", "v"], "c <> ''"))) == [None, None]


def test_shared_folder_must_be_named_where_there_are_several_machines(spark, monkeypatch):
    for master, alone in (("local", True), ("local[8]", True), ("local[2,3]", True), ("local-cluster[3,2,1024]", False), ("yarn", False)):
        assert bool(shared._ONE_MACHINE.fullmatch(master)) == alone


def test_pages_of_a_batch_are_read_in_parts():
    """However many pages come at once, a bounded part of them is held as nodes."""
    pages = [None, "", "<p>a</p>" * 100_000, *[f"<p>{'x' * 50_000}{i}</p>" for i in range(60)], None]
    batch = pa.array(["cut off", *pages])[1:]
    parts = list(html.html_nodes.func(iter([batch, batch[:0], batch[:2]])))
    assert sum(len(p) for p in parts) == len(pages) + 2 and len(parts) > 4
    assert pa.concat_arrays(parts).to_pylist() == html.nodes_array(pa.array([*pages, *pages[:2]])).to_pylist()
    sizes = [sum(len(m or "") for m in part.to_pylist()) for part in html.slices(batch, 200_000)]
    assert sum(sizes) == sum(len(m or "") for m in pages) and sorted(sizes)[-2] <= 200_000
