"""Column expressions over text: whitespace tokens and positional fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col as col_of

# The characters Python's str.split() treats as whitespace.
# All Unicode separators (category Z: Zs, Zl, Zp) plus these controls:
# \t \n \x0b \x0c \r \x1c \x1d \x1e \x1f \x85.
# The same class text works in Java regex (Spark) and RE2 (DuckDB).
WHITESPACE_CLASS = r"[\p{Z}\t\n\x0B\f\r\x1C-\x1F\x85]"
WHITESPACE_RUN = WHITESPACE_CLASS + "+"


def _col(c: str | Column) -> Column:
    return col_of(c) if isinstance(c, str) else c


def literal_regex(sep: str) -> str:
    """Escape ``sep`` so Spark's regex ``split`` treats it literally."""
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in sep)


def tokens(c: str | Column, lower: bool = True) -> Column:
    """Whitespace tokens of a string, as ``str.split()`` gives them (no empty tokens)."""
    text = F.lower(_col(c)) if lower else _col(c)
    return F.filter(F.split(text, WHITESPACE_RUN), lambda t: t != F.lit(""))


def fixed_decimal(c: str | Column, places: int) -> Column:
    """A number as text with exactly ``places`` decimals (``12.50``)."""
    return F.format_string(f"%.{int(places)}f", _col(c).cast("double"))


def field_at(c: str | Column, sep: str, index: int, on_missing: str = "error") -> Column:
    """The ``index``-th (0-based) field of ``c`` split on the literal ``sep``.

    ``on_missing="error"`` fails the task on a short line (Python's IndexError);
    ``"null"`` yields NULL instead.  A NULL line gives NULL either way.
    """
    if index < 0:
        raise ValueError("index must be >= 0")
    if on_missing not in ("error", "null"):
        raise ValueError("on_missing must be 'error' or 'null'")
    parts = F.split(_col(c), literal_regex(sep))
    value = F.get(parts, index)
    if on_missing == "null":
        return value
    return F.when(_col(c).isNull() | (F.size(parts) > index), value).otherwise(
        F.raise_error(F.concat(
            F.lit(f"line has fewer than {index + 1} fields: "), _col(c))))
