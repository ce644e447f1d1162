"""Pages as arrays of nodes.

One Arrow function reads the markup; everything that selects nodes is a Spark
expression over the resulting array, so a page never leaves its own row.
"""

import html
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A node's position in the array is its place in document order. ``last`` is
# the position of its last descendant, ``parent`` is -1 at the top, and ``text``
# is set on ``#text`` nodes only.
_ATTRIBUTES = ("class", "itemprop", "rel", "href")
NODE = T.StructType(
    [T.StructField(f, T.IntegerType()) for f in ("ord", "last", "parent")]
    + [T.StructField(f, T.StringType()) for f in ("tag", *_ATTRIBUTES, "text")]
)

# Fixed values from the HTML standard: elements without content, elements whose
# content is text without tags (in the second group with character references),
# and which open element a start tag closes.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW_TEXT = frozenset("script style xmp iframe noembed noframes".split())
_ESCAPABLE_TEXT = frozenset("textarea title".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
_CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "option": ("option",),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
}
_SCOPE = frozenset("ul ol dl table td th body html div section article select".split())

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:-->|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-z][^\s/>]*)(?P<attrs>(?:[\s/]+(?:[^\s/>=]+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)?)?)*+)[^>]*(?P<closed>>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"(?P<name>[^\s/>=]+)(?:\s*=\s*(?:\"(?P<dq>[^\"]*)\"|'(?P<sq>[^']*)'|(?P<bare>[^\s>]+)))?"
)


# What ends the text of an element, and inside scripts what hides such an end.
_TEXT_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in _RAW_TEXT | _ESCAPABLE_TEXT}
_SCRIPT_MARK = re.compile(r"<!--|-->|<(?P<end>/?)script(?=[\s/>])", re.IGNORECASE)


def _text_end(markup: str, tag: str, start: int) -> int:
    """Where the text of an element that starts at ``start`` ends.

    In a script, a comment that holds the start of another script hides the end
    tag of that inner one; the comment's own end opens the view again.
    """
    if tag != "script":
        end = _TEXT_ENDS[tag].search(markup, start)
        return end.start() if end else len(markup)
    commented = inner = False
    position = start
    while mark := _SCRIPT_MARK.search(markup, position):
        position = mark.end()
        if mark[0] == "<!--":
            commented = True
            position -= 2  # its dashes may be those of the end, too
        elif mark[0] == "-->":
            commented = inner = False
        elif not mark["end"]:
            inner = inner or commented
        elif not inner:
            return mark.start()
        else:
            inner = False
    return len(markup)


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        name = m["name"].lower()
        if name in _ATTRIBUTES and name not in found:
            value = m["dq"] if m["dq"] is not None else m["sq"] if m["sq"] is not None else m["bare"]
            found[name] = html.unescape(value or "")
    return found


def read_nodes(markup: str) -> list[list]:
    """The nodes of one page, each ``[last, parent, tag, attributes, text]``."""
    nodes: list[list] = []
    path: list[int] = []  # positions of the open elements, outermost first

    def add(tag, attributes, text=None):
        nodes.append([len(nodes), path[-1] if path else -1, tag, attributes, text])

    def close(depth):
        for position in path[depth:]:
            nodes[position][0] = len(nodes) - 1
        del path[depth:]

    def close_open(tags, scope):
        for depth in range(len(path) - 1, -1, -1):
            tag = nodes[path[depth]][2]
            if tag in tags:
                close(depth)
                return
            if tag in scope:
                return

    text_open, position = False, 0
    while m := _TOKEN.match(markup, position):
        position = m.end()
        text = m["text"]
        if text is not None:
            if text_open:
                nodes[-1][4] += text
            else:
                add("#text", {}, text)
                text_open = True
            continue
        text_open = False
        if m["start"]:
            if not m["closed"]:
                continue  # the page ends inside this tag
            tag = m["start"].lower()
            if tag in _CLOSES_P:
                close_open(("p",), _SCOPE)
            if tag in _CLOSES:
                close_open(_CLOSES[tag], _SCOPE - set(_CLOSES[tag]))
            add(tag, _attributes(m["attrs"]) if m["attrs"] else {})
            if tag in _TEXT_ENDS:
                start, position = position, _text_end(markup, tag, position)
                path.append(len(nodes) - 1)
                if position > start:
                    add("#raw" if tag in _RAW_TEXT else "#text", {}, markup[start:position])
            elif tag not in _VOID:
                path.append(len(nodes) - 1)
        elif m["end"]:
            close_open((m["end"].lower(),), frozenset())
    close(0)
    return nodes


def nodes_array(pages: pa.Array) -> pa.Array:
    """An Arrow array of node lists for an Arrow array of page markup."""
    offsets, ords, lasts, parents, tags, texts = [0], [], [], [], [], []
    attributes = {name: [] for name in _ATTRIBUTES}
    for page in pages:
        nodes = read_nodes(page.as_py() or "")
        for position, (last, parent, tag, attrs, text) in enumerate(nodes):
            ords.append(position)
            lasts.append(last)
            parents.append(parent)
            tags.append("#text" if tag == "#raw" else tag)
            texts.append(html.unescape(text) if tag == "#text" and "&" in text else text)
            for name in _ATTRIBUTES:
                attributes[name].append(attrs.get(name))
        offsets.append(len(ords))
    fields = [
        pa.array(ords, pa.int32()),
        pa.array(lasts, pa.int32()),
        pa.array(parents, pa.int32()),
        pa.array(tags, pa.string()),
        *[pa.array(attributes[name], pa.string()) for name in _ATTRIBUTES],
        pa.array(texts, pa.string()),
    ]
    names = ["ord", "last", "parent", "tag", *_ATTRIBUTES, "text"]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names))


#: Bytes of markup that are read together. A task holds the nodes of so much at a time, however many pages Spark
#: hands it at once; a page is never cut.
TOGETHER_BYTES = 1 << 20


def slices(markup: pa.Array, most: int = TOGETHER_BYTES) -> Iterator[pa.Array]:
    """``markup`` in order, cut so that only single pages exceed ``most`` bytes."""
    start = held = 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(markup), 0).to_pylist()):
        if i > start and held + size > most:
            yield markup.slice(start, i - start)
            start, held = i, 0
        held += size
    yield markup.slice(start)


# Sent to the executors with the job, so that they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@F.arrow_udf(T.ArrayType(NODE))
def html_nodes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for markup in batches:
        for part in slices(markup):
            yield nodes_array(part)
