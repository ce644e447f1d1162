"""Small helpers for expressions written as SQL text.

Lambdas over arrays are shorter and far quicker to build as SQL than as nested
calls; operands are SQL text too, usually column names.
"""

from chronicle.functions.text import WHITE_SPACE


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bind(value: str, name: str, use: str) -> str:
    """``use`` with ``name`` standing for ``value``, which is computed once."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def stripped(value: str) -> str:
    """Without Unicode white space at both ends."""
    return f"btrim({value}, {quote(WHITE_SPACE)})"


def first_of(candidates: list[str], condition: str) -> str:
    """The first candidate ``c`` that meets the condition, else null; later ones
    are computed only where none before them does."""
    chosen = "NULL"
    for candidate in reversed(candidates):
        chosen = bind(candidate, "c", f"CASE WHEN {condition} THEN c ELSE {chosen} END")
    return chosen
