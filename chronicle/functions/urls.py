"""URLs: resolving links, hosts, and the form used for comparing."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chronicle.functions.sqltext import bind, quote

# Generic URI syntax (scheme, authority, path, query, fragment)
# and the schemes whose references may be relative.
_URI = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_PARTS = ("scheme", "host", "path", "query", "fragment")
_RELATIVE_SCHEMES = ("http", "https", "ftp", "file")


def _parts(url: str) -> str:
    """A struct of the URL's parts, empty text for those that are absent."""
    fields = [f"{quote(name)}, regexp_extract({url}, {quote(_URI)}, {g})" for g, name in enumerate(_PARTS, 1)]
    return f"named_struct({', '.join(fields)})"


def _merged_path(base: str, ref: str) -> str:
    """The path of ``ref`` as seen from ``base``, its ``.`` and ``..`` steps taken."""
    folder = bind(f"split({base}.path, '/')", "f", "filter(f, (s, i) -> i < size(f) - 1 OR s = '')")
    # Repeated slashes collapse in a relative path, but not in an absolute one.
    tidy = "filter(a, (s, i) -> i = 0 OR i = size(a) - 1 OR s <> '')"
    relative = bind(f"concat({folder}, split({ref}.path, '/'))", "a", tidy)
    steps = f"CASE WHEN startswith({ref}.path, '/') THEN split({ref}.path, '/') ELSE {relative} END"
    none = "cast(array() AS array<string>)"
    walked = (
        f"aggregate({steps}, {none}, (done, s) -> CASE WHEN s = '.' THEN done "
        "WHEN s = '..' THEN slice(done, 1, greatest(size(done) - 1, 0)) ELSE concat(done, array(s)) END)"
    )
    open_end = quote(r"(?:^|/)\.{1,2}$")
    tail = f"CASE WHEN {ref}.path RLIKE {open_end} THEN array('') ELSE {none} END"
    joined = f"array_join(concat({walked}, {tail}), '/')"
    return bind(joined, "p", "CASE WHEN p = '' THEN '/' ELSE p END")


def resolve_url(base: str, link: str) -> str:
    """SQL text: the absolute form of a link found on the page at ``base``; null
    for null. The operands are SQL text, usually column names."""
    clean = f"regexp_replace(regexp_replace(l, {quote('^[\\x00-\\x20]+')}, ''), {quote('[\\t\\r\\n]')}, '')"
    scheme = "CASE WHEN r.scheme = '' THEN lower(b.scheme) ELSE lower(r.scheme) END"
    known = ", ".join(quote(s) for s in _RELATIVE_SCHEMES)
    foreign = f"({scheme}) <> lower(b.scheme) OR ({scheme}) NOT IN ({known})"
    bare = "r.host = '' AND r.path = ''"
    path = f"CASE WHEN r.host <> '' THEN r.path WHEN {bare} THEN b.path ELSE {_merged_path('b', 'r')} END"
    rooted = bind(path, "p", "CASE WHEN p <> '' AND NOT startswith(p, '/') THEN concat('/', p) ELSE p END")
    query = f"CASE WHEN {bare} AND r.query = '' THEN b.query ELSE r.query END"
    full = (
        f"concat({scheme}, '://', CASE WHEN r.host <> '' THEN r.host ELSE b.host END, {rooted}, "
        + bind(query, "q", "CASE WHEN q <> '' THEN concat('?', q) ELSE '' END")
        + ", CASE WHEN r.fragment <> '' THEN concat('#', r.fragment) ELSE '' END)"
    )
    seen_from = bind(_parts(base), "b", bind(_parts("c"), "r", f"CASE WHEN {foreign} THEN l ELSE {full} END"))
    resolved = f"CASE WHEN l = '' THEN {base} WHEN l IS NOT NULL THEN {bind(clean, 'c', seen_from)} END"
    return bind(link, "l", resolved)


def canonical_url(url: str) -> Column:
    """The form in which two URLs of the same page compare equal: scheme and
    host in lower case, sorted query arguments, no fragment, ``/`` for no path."""
    arguments = "array_join(array_sort(filter(split(u.query, '&'), a -> a <> '')), '&')"
    query = bind(arguments, "q", "CASE WHEN q <> '' THEN concat('?', q) ELSE '' END")
    path = "CASE WHEN u.path = '' THEN '/' ELSE u.path END"
    form = f"concat(lower(u.scheme), '://', lower(u.host), {path}, {query})"
    return F.expr(bind(_parts(url), "u", form))


def host(url: Column) -> Column:
    """The host in lower case, without user info and port; null when absent."""
    authority = F.regexp_extract(url, _URI, 2)
    return F.lower(F.nullif(F.regexp_replace(authority, r"^.*@|:\d*$", ""), F.lit("")))


def host_allowed(url: Column, domains: Sequence[str]) -> Column:
    """True when the host is one of the domains or a subdomain of one."""
    name = host(url)
    hit = name.isin(*[d.lower() for d in domains])
    for domain in domains:
        hit = hit | name.endswith("." + domain.lower())
    return F.coalesce(hit, F.lit(False))
