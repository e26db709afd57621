"""Row predicates used by the samplers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col as col_of


def residue(index: str | Column, start: int, step: int) -> Column:
    """True where ``(index - start) mod step == 0`` (floored modulo, as Python's ``%``)."""
    if step < 1:
        raise ValueError("step must be >= 1")
    idx = col_of(index) if isinstance(index, str) else index
    return F.pmod(idx - F.lit(int(start)), F.lit(int(step))) == 0


def correct(label: str = "label", prediction: str = "prediction") -> Column:
    """1.0 where the prediction equals the label, else 0.0."""
    return (col_of(label) == col_of(prediction)).cast("double")
