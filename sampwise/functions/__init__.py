"""Column-level building blocks (pure expressions, no actions)."""

from .hashing import bucket_of, cumulative_bounds, uniform
from .predicates import correct, residue
from .text import WHITESPACE_CLASS, WHITESPACE_RUN, field_at, literal_regex, tokens

__all__ = [
    "WHITESPACE_CLASS", "WHITESPACE_RUN", "bucket_of", "correct", "cumulative_bounds",
    "field_at", "literal_regex", "residue", "tokens", "uniform",
]
