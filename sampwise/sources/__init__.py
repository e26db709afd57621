"""Inputs: text lines, delimited files, parquet tables, small driver rows."""

from .delimited import (IRIS_COLUMNS, clean_column_names, clean_name, read_delimited,
                        read_iris, to_typed)
from .infer import Inferred, infer_delimited
from .rows import from_literals, from_rows
from .tables import TABLES, table
from .text import read_lines

__all__ = [
    "IRIS_COLUMNS", "Inferred", "TABLES", "clean_column_names", "clean_name", "from_literals", "from_rows",
    "infer_delimited", "read_delimited", "read_iris", "read_lines", "table", "to_typed",
]
