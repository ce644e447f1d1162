"""Tests on raw JSON Lines text. A typed read cannot tell an absent key from a
null value, nor text after the closing brace, so these look at the line."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronicle.functions.text import strip


def _objects(line: Column) -> Column:
    """An array with the top-level entries of a line that is exactly one strict
    JSON object, as a map of texts; empty for any other line.

    One parse tells all: the line is framed by two keys, the second one named
    after a hash of the line, and exactly these two must come out. Text after
    the object, however it is made up, leaves other keys or none.
    """
    text = strip(line)
    mark = F.hex(F.xxhash64(text))
    framed = F.concat(F.lit('{"line":'), text, F.lit(',"'), mark, F.lit('":{}}'))
    entries = F.from_json(framed, "map<string,map<string,string>>", {"allowSingleQuotes": "false"})
    whole = F.filter(F.array(entries), lambda m: F.map_keys(m) == F.array(F.lit("line"), mark))
    return F.array_compact(F.transform(whole, lambda m: m["line"]))


def object_keys(line: Column) -> Column:
    """The top-level keys of a line that is one strict JSON object, else null."""
    return F.get(F.transform(_objects(line), F.map_keys), F.lit(0))


def _field(entries: Column, name: str) -> Column:
    """The value under ``name``, the last one where the key is repeated."""
    keys, values = F.reverse(F.map_keys(entries)), F.reverse(F.map_values(entries))
    return F.get(values, (F.array_position(keys, name) - 1).cast("int"))


def parsed(line: Column, fields: T.StructType, **more) -> Column:
    """An array with the fields of a line that is exactly one strict JSON object,
    as a struct of texts, else an empty array. ``more`` names columns made from
    the line's entries, for example its keys."""

    def record(entries: Column) -> Column:
        extra = [make(entries).alias(name) for name, make in more.items()]
        return F.struct(*[_field(entries, f.name).alias(f.name) for f in fields], *extra)

    return F.transform(_objects(line), record)


def parsed_object(line: Column, fields: T.StructType) -> Column:
    """The fields of a line that is exactly one strict JSON object, else null."""
    return F.get(parsed(line, fields), F.lit(0))


def is_object(line: Column) -> Column:
    """True when the line is exactly one strict JSON object."""
    return F.size(_objects(line)) == 1


def missing_keys(keys: Column, required: Sequence[str]) -> Column:
    """The required names that are not among the keys, in the given order."""
    return F.array_except(F.array(*[F.lit(k) for k in required]), keys)
