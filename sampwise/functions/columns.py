"""Column references by exact name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """The top-level column called ``name``, even if it holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]
