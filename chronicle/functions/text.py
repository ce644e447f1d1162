"""Scalar text expressions. All of them stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when text is stripped.
WHITE_SPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        *(0x2028, 0x2029, 0x202F, 0x205F, 0x3000),
    )
)

# A character class of everything that counts as a digit, i.e.
# the decimal digits of any script plus super-, subscript and circled forms.
ANY_DIGIT = (
    r"[\p{Nd}\x{B2}\x{B3}\x{B9}\x{1369}-\x{1371}\x{19DA}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247C}\x{2488}-\x{2490}\x{24EA}"
    r"\x{24F5}-\x{24FD}\x{24FF}\x{2776}-\x{277E}\x{2780}-\x{2788}\x{278A}-\x{2792}"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
    r"\x{11F50}-\x{11F59}\x{16AC0}-\x{16AC9}\x{1E4F0}-\x{1E4F9}]"
)


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` removes blanks only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and all-white-space text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def empty_to_null(text: Column) -> Column:
    """Only ``''`` becomes null; white space is kept as it is."""
    return F.nullif(text, F.lit(""))


def or_default(text: Column, default: Column | str) -> Column:
    """``default`` where the text is null or empty."""
    other = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(empty_to_null(text), other)


def without(text: Column, part: str) -> Column:
    """Remove every literal occurrence of ``part``."""
    return F.replace(text, F.lit(part), F.lit(""))


def last_segment(url: Column) -> Column:
    """What follows the last ``/`` (the whole text when there is none)."""
    return F.substring_index(url, "/", -1)


def prefix(text: Column, n: int) -> Column:
    """The first ``n`` characters, counted in code points."""
    return F.substring(text, 1, n)


def shorten(text: Column, n: int, mark: str = "...") -> Column:
    """The first ``n`` characters and ``mark`` where the text is longer."""
    return F.when(F.length(text) > n, F.concat(prefix(text, n), F.lit(mark))).otherwise(text)


def safe_name(name: Column, n: int = 50) -> Column:
    """A file-name form: lower case, blank to ``_``, slash to ``-``, cut to ``n``."""
    return prefix(F.translate(F.lower(F.coalesce(name, F.lit("unknown"))), " /", "_-"), n)


def join_texts(texts: Column) -> Column:
    """Strip every element of an array, drop blank ones, join with a blank."""
    return F.array_join(F.filter(F.transform(texts, strip), lambda t: t != ""), " ")


def byte_length(text: Column) -> Column:
    """Bytes of the text in UTF-8."""
    return F.octet_length(text)


def percent_text(part: Column, total: Column) -> Column:
    """A whole percentage rounded half to even, a dash when there are no rows."""
    share = F.bround(F.try_divide(part, total) * 100, 0).cast("int")
    return F.when(total > 0, F.concat(share.cast("string"), F.lit("%"))).otherwise("—")


def _pretty(fields: dict[str, Column]) -> Column:
    record = F.struct(*[value.alias(name) for name, value in fields.items()])
    return F.to_json(record, {"pretty": "true", "ignoreNullFields": "false"})


def json_document(fields: dict[str, Column]) -> Column:
    """An object as JSON text: two blanks of indent, one field per line, nulls
    kept, text unescaped, no blank before the colon."""
    # Line breaks within values are escaped, so every line starts a field.
    return F.regexp_replace(_pretty(fields), r'(?m)^  ("[^"]+") : ', "  $1: ")


def json_document_size(fields: dict[str, Column]) -> Column:
    """Bytes of the document in UTF-8, without building its final form."""
    return byte_length(_pretty(fields)) - len(fields)
