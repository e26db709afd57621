"""Column types of delimited files by one mergeable aggregate, with the rows that do not fit.

Every value is mapped to the set of types it can be read as (a bit mask), and rows are counted per
(column, mask): partial counts in each task, at most ``2 ** len(TYPES)`` groups a column whatever the
size.  The type of a column is the first of ``TYPES`` that enough of its values fit.  Values are
parsed from the file once for the counts; the typed frame is a lazy cast, and the misfits are a
lazy filter of the same frame.

Defined cases: an empty field is NULL and fits every type; a column of NULLs only is a string; a line
with another number of fields than the header is malformed and counts for no column; an empty
file (or a header alone) has string columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import col as col_of

# The types in the order in which they are tried, and the shape their text must have.
TYPES = ("int", "bigint", "double", "date", "timestamp", "boolean")
SHAPES = {
    "int": r"^[+-]?\d{1,10}$",
    "bigint": r"^[+-]?\d{1,19}$",
    "double": r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^NaN$|^[+-]?Infinity$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$",
    "boolean": r"^(?i:true|false)$",
}
LINE = "_sw_line"


@dataclass(frozen=True)
class Inferred:
    types: DataFrame  # (column, type, n_values, n_null, n_misfit), one row per column
    frame: DataFrame  # the well-formed rows, typed; misfits are NULL
    misfits: DataFrame  # (column, value, line): values that miss their column's type, and malformed lines


def fits(value: Column, typ: str) -> Column:
    """Whether the text can be read as ``typ``; NULL text gives false."""
    return F.coalesce(value.rlike(SHAPES[typ]) & value.try_cast(typ).isNotNull(), F.lit(False))


def mask(value: Column) -> Column:
    """The set of types a text fits, bit k for ``TYPES[k]``; NULL for NULL."""
    bits = F.lit(0)
    for k, typ in enumerate(TYPES):
        bits = bits + F.when(fits(value, typ), F.lit(1 << k)).otherwise(0)
    return F.when(value.isNotNull(), bits)


def narrowest(counts: dict[int, int], share: float) -> tuple[str, int]:
    """(type, misfits) of a column from its rows per mask."""
    total = sum(counts.values())
    for k, typ in enumerate(TYPES):
        fit = sum(n for bits, n in counts.items() if bits >> k & 1)
        if total and fit and fit >= share * total:
            return typ, total - fit
    return "string", 0


def infer_delimited(spark: SparkSession, path: str | list[str], *, sep: str = ",",
                    share: float = 1.0) -> Inferred:
    """Infer the types of delimited files with a header.

    ``share`` is the part of a column's values that must fit a type (1.0: all, as a reader with
    inference does); below 1.0 the others are listed in ``misfits`` and NULL in ``frame``.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie in (0, 1]")
    # whole lines are parsed whatever columns are asked for, or malformed ones would go unseen
    reader = spark.read.option("sep", sep).option("header", True).option("columnPruning", False)
    names = reader.csv(path).columns  # the header line only
    schema = StructType([StructField(c, StringType()) for c in [*names, LINE]])
    raw = (reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).csv(path))
    # the reader refuses a query on LINE alone, so the filter names a column, too
    read = F.length(F.coalesce(col_of(names[0]), F.lit(""))) >= 0
    good = raw.where(F.col(LINE).isNull() & read)
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), mask(col_of(c)).alias("bits"))
                                for k, c in enumerate(names)])).alias("pair")
    met = good.select(pairs).groupBy("pair.k", "pair.bits").agg(F.count(F.lit(1)).alias("n"))
    counts: list[dict[int, int]] = [{} for _ in names]
    nulls = [0] * len(names)
    for r in met.collect():  # a bounded number of masks per column
        if r["bits"] is None:
            nulls[r["k"]] = r["n"]
        else:
            counts[r["k"]][r["bits"]] = r["n"]
    found = [narrowest(c, share) for c in counts]
    rows = [(c, typ, sum(by.values()), n, bad)
            for c, (typ, bad), by, n in zip(names, found, counts, nulls)]
    types = spark.createDataFrame(rows, "column string, type string, n_values long, n_null long, n_misfit long")

    def typed(c: str, typ: str) -> Column:
        value = col_of(c)
        return (value if typ == "string" else F.when(fits(value, typ), value.try_cast(typ))).alias(c)

    frame = good.select(*[typed(c, typ) for c, (typ, _) in zip(names, found)])
    text = "string"
    wrong = [F.struct(F.lit(c).alias("column"), col_of(c).alias("value"), F.lit(None).cast(text).alias("line"))
             for c, (typ, bad) in zip(names, found) if bad]
    wrong_if = [col_of(c).isNotNull() & ~fits(col_of(c), typ) for c, (typ, bad) in zip(names, found) if bad]
    listed = [F.when(F.col(LINE).isNull() & miss, cell) for miss, cell in zip(wrong_if, wrong)]
    listed.append(F.when(F.col(LINE).isNotNull(), F.struct(
        F.lit(None).cast(text).alias("column"), F.lit(None).cast(text).alias("value"), F.col(LINE).alias("line"))))
    misfits = raw.where(read).select(
        F.explode(F.array_compact(F.array(*listed))).alias("cell")).select("cell.*")
    return Inferred(types, frame, misfits)
