"""End-to-end jobs over user files, one per job of the studied workload.

Each takes file paths and returns DataFrames (nothing is printed or collected
here); ``python -m sampwise`` shows them on the console.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.counts import field_count, top_k, word_count
from ..operators.locators import located_sample, scan_order_index
from ..operators.models import ModelSpec, decision_tree, linear_svm, random_forest
from ..operators.sampling import draw_offsets
from ..sources.delimited import clean_column_names, read_delimited, read_iris
from ..sources.text import read_lines
from .experiments import run_experiments, run_per_part, summarise

# The bank marketing columns the experiment jobs use (after the
# dotted names are cleaned) and the iris feature columns.
BANK_NUMERIC = ("age", "duration", "campaign", "pdays", "previous", "emp_var_rate",
                "cons_price_idx", "cons_conf_idx", "euribor3m", "nr_employed")
BANK_CATEGORICAL = ("job", "marital", "education", "default", "housing", "loan",
                    "contact", "month", "day_of_week", "poutcome")
BANK_LABEL = "y"
IRIS_NUMERIC = ("sepal_length", "sepal_width", "petal_length", "petal_width")
IRIS_LABEL = "species"
RANDOM_PART_WEIGHTS = (0.33, 0.33, 0.34)


def words_in_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(word, count)`` of a text file: lower-cased whitespace tokens."""
    return word_count(read_lines(spark, path))


def top_fields_in_file(spark: SparkSession, path: str | list[str], *, sep: str = ",",
                       index: int = 3, k: int = 10, on_missing: str = "error") -> DataFrame:
    """``(key, count)`` of the ``index``-th field, most frequent first, at most ``k`` rows."""
    counts = field_count(read_lines(spark, path), sep, index, on_missing=on_missing)
    return top_k(counts, k, "count", tie_break="key")


def read_bank(spark: SparkSession, path: str | list[str], *, sep: str = ";",
              schema=None) -> DataFrame:
    """Bank marketing CSV (header, ``;``), types inferred unless ``schema`` is given;
    dotted column names become underscores."""
    raw = read_delimited(spark, path, sep=sep, header=True, schema=schema,
                         infer_schema=schema is None)
    return clean_column_names(raw)


def sample_file(spark: SparkSession, path: str | list[str], *, step: int = 5,
                seed: int | None = None, sep: str = ";", n_show: int = 5,
                schema=None) -> tuple[int, DataFrame, DataFrame]:
    """1-in-``step`` systematic sample of a delimited file in file order (1-based index).

    Returns ``(start_offset, sample, first_rows)``; the offset is drawn from
    ``seed`` and the first rows are ordered by the index.
    """
    df = read_delimited(spark, path, sep=sep, header=True, schema=schema,
                        infer_schema=schema is None)
    offset = draw_offsets(step, 1, seed)[0]
    sample = located_sample(df, step, offset, base=1)  # a filter of the scan: nothing is copied
    return offset, sample, sample.orderBy("row_index").limit(n_show)


def model_spec(kind: str, seed: int | None = 42) -> ModelSpec:
    """The three classifiers with the parameters of the experiment jobs."""
    if kind == "dt":
        return decision_tree(max_depth=10, max_bins=32, seed=seed)
    if kind == "rf":
        return random_forest(num_trees=50, max_depth=10, max_bins=32, seed=seed)
    if kind == "svm":
        return linear_svm(max_iter=100, reg_param=0.1)
    raise ValueError("kind must be 'dt', 'rf' or 'svm'")


def bank_experiments(spark: SparkSession, path: str | list[str], kind: str = "dt", *,
                     n_experiments: int = 5, step: int = 5, offset_seed: int | None = None,
                     split_seed_base: int = 42, key: str | None = None,
                     numeric: Sequence[str] = BANK_NUMERIC,
                     categorical: Sequence[str] = BANK_CATEGORICAL,
                     label: str = BANK_LABEL, schema=None) -> tuple[DataFrame, DataFrame]:
    """Repeated systematic-sample experiments on the bank CSV; ``(results, summary)``.

    Without ``key`` rows are numbered in file order, as the studied job does.
    """
    df = read_bank(spark, path, schema=schema)
    results = run_experiments(df, model_spec(kind), label=label, numeric=numeric,
                              categorical=categorical, key=key,
                              n_experiments=n_experiments, step=step,
                              offset_seed=offset_seed, split_seed_base=split_seed_base)
    return results, summarise(results)


def iris_parts(spark: SparkSession, path: str, *, method: str = "systematic",
               n_parts: int = 3, split_seed: int = 1, part_seed: int = 42,
               part_weights: Sequence[float] | None = None) -> DataFrame:
    """Iris CSV cut into ``n_parts`` parts, one decision tree per part, accuracy each.

    ``method="random"`` needs a key; the file-order index serves as one.  With
    three parts the random weights default to 0.33 / 0.33 / 0.34.
    """
    df = read_iris(spark, path)
    key = None
    if method == "random":
        df = scan_order_index(df, name="row_id")
        key = "row_id"
        if part_weights is None and n_parts == 3:
            part_weights = RANDOM_PART_WEIGHTS
    return run_per_part(df, decision_tree(), label=IRIS_LABEL, numeric=IRIS_NUMERIC,
                        key=key, n_parts=n_parts, method=method, split_seed=split_seed,
                        part_seed=part_seed, part_weights=part_weights)
