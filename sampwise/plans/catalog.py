"""Registered queries over the test-data tables, with equivalent DuckDB SQL.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over whole
tables.  ``ORACLE_SQL`` holds, for every query that SQL can express, the same
result in SQL: computed columns carry the same names on both sides.  Model
queries have no SQL form (fitting is iterative) and are checked by tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import HASH_HEX_DIGITS, HASH_SCALE, cumulative_bounds
from ..functions.text import WHITESPACE_RUN, fixed_decimal, tokens
from ..operators.counts import count_by, field_count, head, row_counts, top_k, word_count
from ..operators.features import index_columns, scale_columns, assemble, vector_columns
from ..operators.index import with_row_index, with_unique_id
from ..operators.locators import located_sample, scan_order_index
from ..operators.metrics import accuracy, confusion
from ..operators.models import decision_tree, linear_svm, random_forest
from ..operators.sampling import (draw_offsets, hash_split, interval_sample, systematic_partition,
                                  systematic_sample)
from ..operators.trees import grow
from ..session import checkpoint_dir
from ..sources.delimited import clean_column_names, read_delimited, read_iris, to_typed
from ..sources.infer import infer_delimited
from ..sources.text import read_lines
from ..sources.tables import TABLES, table
from .batched import experiment_rows, run_svm_experiments, run_tree_experiments
from .datasets import (BANK_CATEGORICAL, BANK_KEY, BANK_LABEL, BANK_NUMERIC, events_bank)
from .experiments import (experiment_sizes, experiment_table, finished, run_experiments,
                          run_per_part, summarise)

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
SAMPLE_STEP = 5
SAMPLE_START = 2
ONE_BASED_OFFSET = 3
N_PARTS = 3
INTERVAL_TARGET = 100
SPLIT3_WEIGHTS = (0.33, 0.33, 0.34)
SPLIT3_SEED = 42
TRAIN_WEIGHTS = (0.8, 0.2)
TRAIN_SEED = 7
N_EXPERIMENTS = 5
OFFSET_SEED = 7
SPLIT_SEED_BASE = 42
LONG_DOC_CHARS = 200
TOP_K = 10
RICH_ACCTBAL = 5000.0
FLAG_PRICE = 150000.0
EMPTY_STEP = 40
FEW_STEP = 12
CUT_LEVELS = 20
WIDE_FACTOR = 10_000_000_000
BAD_EVERY = 50
EMPTY_OFFSETS = (3, 24, 30, 39)
STRETCH_ROWS = 1 << 16  # rows of a file that one window compares


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def experiment_offsets() -> list[int]:
    return draw_offsets(SAMPLE_STEP, N_EXPERIMENTS, OFFSET_SEED)


# ----------------------------------------------------------------- counting

def q_word_count(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return word_count(docs)


def order_lines(orders: DataFrame) -> DataFrame:
    """Orders as comma text lines; the 4th field is the order priority."""
    return orders.select(F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus",
                                     "o_orderpriority", "o_totalprice").alias("value"))


def q_field_count_top10(spark, sf_dir):
    counts = field_count(order_lines(_t(spark, sf_dir, "orders")), ",", 3)
    return top_k(counts, TOP_K, "count", tie_break="key")


def q_tokens_per_document(spark, sf_dir):
    """Counted inside the row: no token becomes a row of its own."""
    docs = _t(spark, sf_dir, "documents")
    sizes = docs.select("doc_id", F.size(tokens("text")).cast("long").alias("n")).where("n > 0")
    return sizes.groupBy("doc_id").agg(F.sum("n").alias("count"))


def customer_lines(customer: DataFrame) -> DataFrame:
    """Comma lines with 4 fields for rich customers and 3 (segment left out) otherwise."""
    segment = F.when(F.col("c_acctbal") > RICH_ACCTBAL, F.col("c_mktsegment"))
    return customer.select(F.concat_ws(",", "c_custkey", "c_name", "c_nationkey", segment)
                           .alias("value"))


def q_field_count_short_lines(spark, sf_dir):
    return field_count(customer_lines(_t(spark, sf_dir, "customer")), ",", 3,
                       on_missing="null")


def q_custkey_top10(spark, sf_dir):
    counts = count_by(_t(spark, sf_dir, "orders"), "o_custkey")
    return top_k(counts, TOP_K, "count", tie_break="o_custkey")


def q_row_counts(spark, sf_dir):
    return row_counts({name: _t(spark, sf_dir, name) for name in TABLES})


# ----------------------------------------------------------------- index and samples

def q_row_index(spark, sf_dir):
    return with_row_index(_t(spark, sf_dir, "orders"), "o_orderkey")


def q_row_index_scan_order(spark, sf_dir):
    """Scan-order index (``zipWithIndex``) without a copy.  ``out_of_order`` counts rows whose index does
    not follow their file and place in it, as the reader itself reports them."""
    orders = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("place"))
    return scan_order_facts(scan_order_index(orders))


def scan_order_facts(idx: DataFrame, stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """Facts of ``idx`` (row_index, file, place).  Each row is compared with the one before it in its file:
    inside a stretch of places by a window, across stretches by their first and last index, one row
    per stretch.  A long file is many tasks' work, and so are the distinct indexes."""
    width = int(idx.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (idx.select("row_index", "file", "place", F.floor(F.col("place") / F.lit(stretch_rows)).alias("stretch"))
            .repartition(width, "file", "stretch"))
    inside = rows.withColumn("before", F.lag("row_index").over(Window.partitionBy("file", "stretch").orderBy("place")))
    stretches = inside.groupBy("file", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.min("row_index").alias("low"), F.max("row_index").alias("high"),
        F.min_by("row_index", "place").alias("first"), F.max_by("row_index", "place").alias("last"),
        F.count_if(F.col("before") >= F.col("row_index")).alias("wrong"))
    across = stretches.withColumn("before", F.lag("last").over(Window.partitionBy("file").orderBy("stretch")))
    zero = F.lit(0).cast("long")
    order = across.agg(F.coalesce(F.sum("n"), zero).alias("n"), F.min("low").alias("min_index"),
                       F.max("high").alias("max_index"),
                       (F.coalesce(F.sum("wrong"), zero) + F.count_if(F.col("before") >= F.col("first")))
                       .alias("out_of_order"))
    distinct = (idx.select("row_index").repartition(width, "row_index")
                .agg(F.countDistinct("row_index").alias("distinct_index")))
    return order.crossJoin(distinct).select("n", "min_index", "max_index", "distinct_index", "out_of_order")


def index_facts(idx: DataFrame) -> DataFrame:
    return idx.agg(F.count(F.lit(1)).alias("n"), F.min("row_index").alias("min_index"),
                   F.max("row_index").alias("max_index"),
                   F.countDistinct("row_index").alias("distinct_index"))


def q_index_close_keys(spark, sf_dir):
    """Two hot keys that are the same double (2^60 and 2^60 + 1), many key ranges."""
    key = F.lit(1 << 60) + F.col("l_linenumber").cast("long") % 2
    rows = _t(spark, sf_dir, "lineitem").select(key.alias("big_key"))
    idx = with_row_index(rows, "big_key", partitions=50)
    return idx.groupBy("big_key").agg(F.count(F.lit(1)).alias("n"),
                                      F.min("row_index").alias("min_index"),
                                      F.max("row_index").alias("max_index"))


def q_index_after_join(spark, sf_dir):
    """Scan-order index of rows that come out of a shuffle."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    return index_facts(with_row_index(lines.join(orders.hint("merge"), "o_orderkey")))


def q_index_text_key(spark, sf_dir):
    """Key order on a text column with NULLs and a composite tie-break."""
    part = _t(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") > RICH_ACCTBAL, F.col("c_mktsegment")).alias("segment"), "c_custkey")
    return with_row_index(part, ["segment", "c_custkey"], base=1)


def q_unique_ids(spark, sf_dir):
    """Unique increasing id (not consecutive); checked by its order-free facts."""
    ids = with_unique_id(_t(spark, sf_dir, "lineitem").select("l_orderkey"), "uid")
    return ids.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("uid").alias("distinct_ids"))


def q_systematic_sample(spark, sf_dir):
    return located_sample(_t(spark, sf_dir, "orders"), SAMPLE_STEP, SAMPLE_START, order_by="o_orderkey")


def q_systematic_sample_1based(spark, sf_dir):
    return located_sample(_t(spark, sf_dir, "events"), SAMPLE_STEP, ONE_BASED_OFFSET,
                          order_by="event_id", base=1)


def q_moved_sample(spark, sf_dir):
    """A key-order sample of rows that are no bare scan, the index dropped."""
    events = _t(spark, sf_dir, "events").where("event_type IS NOT NULL").select("event_id", "event_type")
    return systematic_sample(events, SAMPLE_STEP, SAMPLE_START, order_by="event_id", keep_index=False)


def q_scan_order_sample(spark, sf_dir):
    """Every fifth row in file order, as a filter of the scan: facts that do not depend on the order
    of keys in the files, and the index against the reader's own places."""
    sample = located_sample(_t(spark, sf_dir, "lineitem"), SAMPLE_STEP, SAMPLE_START)
    return sample.agg(F.count(F.lit(1)).alias("n"), F.min("row_index").alias("min_index"),
                      F.max("row_index").alias("max_index"), F.countDistinct("row_index").alias("distinct_index"))


def q_sample_head5(spark, sf_dir):
    sample = q_systematic_sample_1based(spark, sf_dir)
    return head(sample, 5, "row_index")


def q_systematic_partition(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = systematic_partition(orders, N_PARTS, order_by="o_orderkey")
    return parts.select("part", "row_index", "o_orderkey", "o_custkey")


def q_systematic_partition_sizes(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey")
    parts = systematic_partition(orders, N_PARTS, order_by="o_orderkey")
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("num_rows"),
                                     F.min("o_orderkey").alias("min_orderkey"),
                                     F.max("o_orderkey").alias("max_orderkey"))


def q_interval_sample(spark, sf_dir):
    return located_sample(_t(spark, sf_dir, "events"), n_samples=INTERVAL_TARGET, order_by="event_id")


def q_interval_sample_scan(spark, sf_dir):
    """As many rows as A7's interval gives, from the counts kept with the index, no pass over the rows."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return interval_sample(orders, INTERVAL_TARGET, 1, order_by="o_orderkey")


def q_random_split_3way(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return hash_split(orders, SPLIT3_WEIGHTS, SPLIT3_SEED, "o_orderkey")


def q_train_test_split(spark, sf_dir):
    events = _t(spark, sf_dir, "events").select("event_id", "event_type")
    return hash_split(events, TRAIN_WEIGHTS, TRAIN_SEED, "event_id")


def q_experiment_sizes(spark, sf_dir):
    events = _t(spark, sf_dir, "events").select("event_id")
    parts = systematic_partition(events, SAMPLE_STEP, order_by="event_id")
    offsets = experiment_offsets()
    plan = experiment_table(spark, offsets,
                            [SPLIT_SEED_BASE + i for i in range(len(offsets))])
    return experiment_sizes(parts, "event_id", plan, TRAIN_WEIGHTS[0], "part")


# ----------------------------------------------------------------- features and metrics

def q_label_index(spark, sf_dir):
    events = _t(spark, sf_dir, "events").select("event_id", "event_type")
    return index_columns(events, ["event_type"], ["label"])


def q_name_index(spark, sf_dir):
    """As many levels as rows."""
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return index_columns(customer, ["c_name"], ["code"])


def q_category_index(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return index_columns(orders, ["o_orderstatus", "o_orderpriority"])


def q_delimited_orders(spark, sf_dir):
    """Orders written as ``;`` lines with a header, read back with a schema."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = f"{checkpoint_dir(spark)}/sampwise-lines-{uuid.uuid4().hex}"
    orders.write.option("sep", ";").option("header", True).csv(path)
    back = read_delimited(spark, path, sep=";", header=True,
                          schema="o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")
    return back.withColumn("price_text", fixed_decimal("o_totalprice", 4))


def _mixed_lines(spark, sf_dir) -> str:
    """Orders as ``;`` lines without types: whole numbers of two widths, a date, a yes or no, gaps, text among numbers."""
    orders = _t(spark, sf_dir, "orders")
    path = f"{checkpoint_dir(spark)}/sampwise-mixed-{uuid.uuid4().hex}"
    (orders.select(F.col("o_orderkey").alias("key"), (F.col("o_orderkey") * WIDE_FACTOR).alias("wide"),
                   F.col("o_totalprice").alias("price"), F.lit("1999-12-31").alias("day"),
                   (F.col("o_custkey") % 2 == 0).alias("even"), F.lit(None).cast("string").alias("none"),
                   F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey")).alias("gaps"),
                   F.when(F.col("o_orderkey") % BAD_EVERY == 0, F.concat(F.lit("n/a "), "o_orderkey"))
                   .otherwise(F.col("o_custkey").cast("string")).alias("mixed"))
     .write.option("sep", ";").option("header", True).csv(path))
    return path


def q_inferred_types(spark, sf_dir):
    return infer_delimited(spark, _mixed_lines(spark, sf_dir), sep=";").types


def q_inferred_misfits(spark, sf_dir):
    """Values among numbers that are none, where nine in ten of a column must fit its type."""
    return infer_delimited(spark, _mixed_lines(spark, sf_dir), sep=";", share=0.9).misfits.drop("line")


def q_iris_file(spark, sf_dir):
    """A file with the iris columns, read by name; averages per species."""
    path = f"{checkpoint_dir(spark)}/sampwise-iris-{uuid.uuid4().hex}"
    tenth = lambda n: (F.col("c_custkey") % n).cast("double") / 8
    (_t(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("Species"), tenth(80).alias("SepalLengthCm"), tenth(40).alias("SepalWidthCm"),
        tenth(70).alias("PetalLengthCm"), tenth(24).alias("PetalWidthCm"), F.col("c_custkey").alias("Id"))
     .select("Id", "SepalLengthCm", "SepalWidthCm", "PetalLengthCm", "PetalWidthCm", "Species")
     .write.option("header", True).csv(path))
    iris = read_iris(spark, path)
    return iris.groupBy("species").agg(F.count(F.lit(1)).alias("n"), *[
        F.sum(c).alias(c) for c in ("sepal_length", "sepal_width", "petal_length", "petal_width")])


def q_words_in_text_files(spark, sf_dir):
    """Word counts of text files, one line a row."""
    lines = _t(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("value"))
    path = f"{checkpoint_dir(spark)}/sampwise-text-{uuid.uuid4().hex}"
    lines.write.text(path)
    return word_count(read_lines(spark, path))


def q_typed_rows(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    dotted = part.toDF(*[c.replace("_", ".", 1) for c in part.columns])
    clean = clean_column_names(dotted)
    return to_typed(clean, {
        "partkey": ("p_partkey", "bigint"),
        "brand": ("p_brand", "string"),
        "size": ("p_size", "double"),
        "retailprice": ("p_retailprice", "double"),
    })


def q_assembled(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                              "l_extendedprice", "l_discount", "l_tax")
    vec = assemble(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "features")
    return vector_columns(vec.select("l_orderkey", "l_linenumber", "features"), "features",
                          ["f_quantity", "f_extendedprice", "f_discount", "f_tax"])


def q_scaled(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                              "l_extendedprice")
    out = scale_columns(li, ["l_quantity", "l_extendedprice"],
                        ["quantity_scaled", "extendedprice_scaled"])
    return out.select("l_orderkey", "l_linenumber",
                      F.round("quantity_scaled", 4).alias("quantity_scaled"),
                      F.round("extendedprice_scaled", 4).alias("extendedprice_scaled"))


def rule_predictions(spark, sf_dir, keep_id: bool = False) -> DataFrame:
    """Label = ``labels.quality``; prediction = 1 when a document is long."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = _t(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id").select(
        *(["doc_id"] if keep_id else []),
        F.col("quality").cast("double").alias("label"),
        (F.col("n_chars") > LONG_DOC_CHARS).cast("double").alias("prediction"))


def q_rule_accuracy_by_part(spark, sf_dir):
    """The fixed rule scored on each part of a systematic 5-way partition."""
    preds = rule_predictions(spark, sf_dir, keep_id=True)
    parts = systematic_partition(preds, SAMPLE_STEP, order_by="doc_id",
                                 deterministic_input=False)
    hit = F.col("label") == F.col("prediction")
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("num_samples"),
                                     F.avg(hit.cast("double")).alias("accuracy"))


def q_rule_accuracy_summary(spark, sf_dir):
    """Planned/finished/average/lowest/highest over the per-part accuracies."""
    per_part = q_rule_accuracy_by_part(spark, sf_dir)
    s = summarise(per_part)
    return s.select("planned", "finished", F.round("avg_accuracy", 10).alias("avg_accuracy"),
                    "min_accuracy", "max_accuracy")


def q_accuracy(spark, sf_dir):
    return accuracy(rule_predictions(spark, sf_dir))


def q_confusion(spark, sf_dir):
    return confusion(rule_predictions(spark, sf_dir))


# ----------------------------------------------------------------- models (no SQL form)

def bank(spark, sf_dir) -> DataFrame:
    return events_bank(_t(spark, sf_dir, "events"))


def _experiments(spec):
    def run(spark, sf_dir):
        return run_experiments(bank(spark, sf_dir), spec, label=BANK_LABEL,
                               numeric=BANK_NUMERIC, categorical=BANK_CATEGORICAL,
                               key=BANK_KEY, n_experiments=N_EXPERIMENTS, step=SAMPLE_STEP,
                               offsets=experiment_offsets(), split_seed_base=SPLIT_SEED_BASE)
    return run


q_dt_experiments = _experiments(decision_tree(max_depth=10, max_bins=32, seed=SPLIT_SEED_BASE))
q_rf_experiments = _experiments(random_forest(num_trees=50, max_depth=10, max_bins=32,
                                              seed=SPLIT_SEED_BASE))
q_svm_experiments = _experiments(linear_svm(max_iter=100, reg_param=0.1))


def q_experiment_summary(spark, sf_dir):
    return summarise(q_dt_experiments(spark, sf_dir))


def q_per_part_models(spark, sf_dir):
    return run_per_part(bank(spark, sf_dir), decision_tree(), label=BANK_LABEL,
                        numeric=BANK_NUMERIC, categorical=BANK_CATEGORICAL, key=BANK_KEY,
                        n_parts=N_PARTS, method="systematic", split_seed=1)


def q_random_part_models(spark, sf_dir):
    return run_per_part(bank(spark, sf_dir), decision_tree(), label=BANK_LABEL,
                        numeric=BANK_NUMERIC, categorical=BANK_CATEGORICAL, key=BANK_KEY,
                        n_parts=N_PARTS, method="random", split_seed=1, part_seed=SPLIT3_SEED,
                        part_weights=SPLIT3_WEIGHTS)


# Models whose result SQL can state.  A tree on one two-valued feature predicts, for each
# value, the label that most training rows with that value have.

def _levelwise(**options):
    def run(spark, sf_dir):
        return run_tree_experiments(bank(spark, sf_dir), label=BANK_LABEL, numeric=BANK_NUMERIC,
                                    categorical=BANK_CATEGORICAL, key=BANK_KEY, offsets=experiment_offsets(),
                                    step=SAMPLE_STEP, split_seed_base=SPLIT_SEED_BASE, **options)
    return run


def flagged_orders(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus",
        (F.col("o_totalprice") > FLAG_PRICE).cast("double").alias("flag"),
        F.when(F.col("o_totalprice") > FLAG_PRICE, 1.0).otherwise(-1.0).alias("side"),
        F.when(F.col("o_totalprice") > FLAG_PRICE, "high").otherwise("low").alias("band"))


def _rounded(results: DataFrame) -> DataFrame:
    return results.withColumn("accuracy", F.round("accuracy", 10))


def _flag_experiments(spec, label="o_orderstatus", feature="flag"):
    def run(spark, sf_dir):
        return _rounded(run_experiments(
            flagged_orders(spark, sf_dir), spec, label=label, numeric=[feature], key="o_orderkey",
            step=SAMPLE_STEP, offsets=experiment_offsets(), split_seed_base=SPLIT_SEED_BASE))
    return run


q_majority_tree = _flag_experiments(decision_tree(max_depth=1, seed=1))
q_majority_forest = _flag_experiments(random_forest(num_trees=1, max_depth=1, seed=1, bootstrap=False,
                                                    features_per_split="all"))
q_separable_svm = _flag_experiments(linear_svm(max_iter=20), label="band", feature="side")




def q_batched_svm(spark, sf_dir):
    """The SVM of every experiment in shared passes of the rows."""
    return run_svm_experiments(bank(spark, sf_dir), label=BANK_LABEL, numeric=BANK_NUMERIC,
                               categorical=BANK_CATEGORICAL, key=BANK_KEY, offsets=experiment_offsets(),
                               step=SAMPLE_STEP, split_seed_base=SPLIT_SEED_BASE)


def q_majority_svm(spark, sf_dir):
    """Classes that no plane separates: one order in five has the label of the other side.  With little
    regularisation the plane takes the majority of each side."""
    orders = _t(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") > FLAG_PRICE).cast("double").alias("flag"),
        F.when((F.col("o_totalprice") > FLAG_PRICE) == (F.col("o_custkey") % 5 != 0), "up").otherwise("down")
        .alias("turn"))
    return _rounded(run_svm_experiments(orders, label="turn", numeric=["flag"], key="o_orderkey", step=SAMPLE_STEP,
                                        offsets=experiment_offsets(), split_seed_base=SPLIT_SEED_BASE,
                                        reg_param=0.001))


def q_majority_summary(spark, sf_dir):
    s = summarise(finished(q_majority_tree(spark, sf_dir)))
    return s.select("planned", "finished", F.round("avg_accuracy", 9).alias("avg_accuracy"),
                    "min_accuracy", "max_accuracy",
                    fixed_decimal(F.lit(N_EXPERIMENTS) * F.lit(0.25), 2).alias("quarter_text"))


def _flag_parts(method):
    def run(spark, sf_dir):
        return _rounded(run_per_part(
            flagged_orders(spark, sf_dir), decision_tree(max_depth=1), label="o_orderstatus", numeric=["flag"],
            key="o_orderkey", n_parts=N_PARTS, method=method, split_seed=1, part_seed=SPLIT3_SEED,
            part_weights=SPLIT3_WEIGHTS if method == "random" else None))
    return run


q_majority_parts = _flag_parts("systematic")
q_majority_random_parts = _flag_parts("random")


def q_levelwise_tree(spark, sf_dir):
    """Depth 2 on two two-valued features, all experiments in one job per level: the majority of each cell."""
    orders = _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", (F.col("o_totalprice") > FLAG_PRICE).cast("double").alias("flag"),
        F.when(F.col("o_custkey") % 3 == 0, "third").otherwise("other").alias("kind"))
    return _rounded(run_tree_experiments(orders, label="o_orderstatus", numeric=["flag"], categorical=["kind"],
                                         key="o_orderkey", offsets=experiment_offsets(), step=SAMPLE_STEP,
                                         split_seed_base=SPLIT_SEED_BASE, depth=2))


def q_level_cut(spark, sf_dir):
    """The root's best cut of a category with many levels, per experiment: the gain and the weight left of it."""
    customer = _t(spark, sf_dir, "customer").select(
        "c_custkey", F.pmod(F.col("c_custkey"), F.lit(CUT_LEVELS)).cast("string").alias("group"),
        (F.col("c_acctbal") > RICH_ACCTBAL).cast("string").alias("rich"))
    rows, n = experiment_rows(customer, label="rich", numeric=[], categorical=["group"], key="c_custkey",
                              offsets=list(range(SAMPLE_STEP)), step=SAMPLE_STEP, split_seed_base=SPLIT_SEED_BASE)
    nodes, _ = grow(rows, n_classes=n, numeric=[], categorical=["z0"], depth=1)
    root = nodes.where("node = 1").select("experiment", F.round("gain", 9).alias("gain"),
                                          F.size("levels").cast("long").alias("levels_left"))
    total = nodes.where("node = 2").select("experiment", F.aggregate("classes", F.lit(0.0), lambda a, x: a + x)
                                           .cast("long").alias("rows_left"))
    return root.join(total, "experiment")


def q_name_tree(spark, sf_dir):
    """A feature with as many levels as rows: no level of a test row is known, so all go right."""
    customer = _t(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") > RICH_ACCTBAL, "rich").otherwise("not").alias("rich"))
    out = run_tree_experiments(customer, label="rich", numeric=[], categorical=["c_name"], key="c_custkey",
                               offsets=experiment_offsets(), step=SAMPLE_STEP, split_seed_base=SPLIT_SEED_BASE, depth=1)
    return _rounded(out)


def q_finished_experiments(spark, sf_dir):
    """Tiny samples: some experiments end with an accuracy, the others are left out by ``finished``."""
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", F.lit("one").alias("label"), F.lit(1.0).alias("x"))
    return finished(run_tree_experiments(nation, label="label", numeric=["x"], key="n_nationkey", step=FEW_STEP,
                                         offsets=list(range(FEW_STEP)), split_seed_base=SPLIT_SEED_BASE, depth=1))


q_levelwise_dt = _levelwise(depth=10)
q_levelwise_rf = _levelwise(depth=6, trees=10, bootstrap=True, subset=3, seed=SPLIT_SEED_BASE)


def q_empty_samples(spark, sf_dir):
    """A step beyond the row count: samples of one row or none, so no model anywhere."""
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.lit(1.0).alias("one"))
    return run_experiments(nation, decision_tree(), label="n_name", numeric=["one"], key="n_nationkey",
                           step=EMPTY_STEP, offsets=list(EMPTY_OFFSETS), split_seed_base=SPLIT_SEED_BASE)


def q_finished_of_planned(spark, sf_dir):
    """Experiments that finish, out of a plan in which none can."""
    return summarise(q_empty_samples(spark, sf_dir)).select(
        "planned", "finished", F.col("avg_accuracy").isNull().alias("no_average"))


QUERIES: dict[str, Query] = {
    "index_close_keys": q_index_close_keys,
    "index_after_join": q_index_after_join,
    "index_text_key": q_index_text_key,
    "name_index": q_name_index,
    "delimited_orders": q_delimited_orders,
    "inferred_types": q_inferred_types,
    "inferred_misfits": q_inferred_misfits,
    "iris_file": q_iris_file,
    "words_in_text_files": q_words_in_text_files,
    "majority_tree": q_majority_tree,
    "majority_forest": q_majority_forest,
    "separable_svm": q_separable_svm,
    "batched_svm": q_batched_svm,
    "majority_svm": q_majority_svm,
    "majority_summary": q_majority_summary,
    "majority_parts": q_majority_parts,
    "majority_random_parts": q_majority_random_parts,
    "levelwise_tree": q_levelwise_tree,
    "level_cut": q_level_cut,
    "name_tree": q_name_tree,
    "finished_experiments": q_finished_experiments,
    "levelwise_dt": q_levelwise_dt,
    "levelwise_rf": q_levelwise_rf,
    "empty_samples": q_empty_samples,
    "finished_of_planned": q_finished_of_planned,
    "word_count": q_word_count,
    "field_count_top10": q_field_count_top10,
    "custkey_top10": q_custkey_top10,
    "tokens_per_document": q_tokens_per_document,
    "field_count_short_lines": q_field_count_short_lines,
    "row_counts": q_row_counts,
    "row_index": q_row_index,
    "row_index_scan_order": q_row_index_scan_order,
    "unique_ids": q_unique_ids,
    "systematic_sample": q_systematic_sample,
    "systematic_sample_1based": q_systematic_sample_1based,
    "sample_head5": q_sample_head5,
    "systematic_partition": q_systematic_partition,
    "systematic_partition_sizes": q_systematic_partition_sizes,
    "interval_sample": q_interval_sample,
    "interval_sample_scan": q_interval_sample_scan,
    "moved_sample": q_moved_sample,
    "scan_order_sample": q_scan_order_sample,
    "random_split_3way": q_random_split_3way,
    "train_test_split": q_train_test_split,
    "experiment_sizes": q_experiment_sizes,
    "label_index": q_label_index,
    "category_index": q_category_index,
    "typed_rows": q_typed_rows,
    "assembled": q_assembled,
    "scaled": q_scaled,
    "accuracy": q_accuracy,
    "rule_accuracy_by_part": q_rule_accuracy_by_part,
    "rule_accuracy_summary": q_rule_accuracy_summary,
    "confusion": q_confusion,
    "dt_experiments": q_dt_experiments,
    "rf_experiments": q_rf_experiments,
    "svm_experiments": q_svm_experiments,
    "experiment_summary": q_experiment_summary,
    "per_part_models": q_per_part_models,
    "random_part_models": q_random_part_models,
}


# ----------------------------------------------------------------- oracle SQL

def _sql_uniform(key_sql: str, seed_sql: str) -> str:
    digest = f"md5(CAST({seed_sql} AS VARCHAR) || '|' || CAST({key_sql} AS VARCHAR))"
    return (f"(CAST(('0x' || substr({digest}, 1, {HASH_HEX_DIGITS})) AS BIGINT)"
            f" / CAST({HASH_SCALE!r} AS DOUBLE))")


def _sql_bucket(u_sql: str, weights) -> str:
    bounds = cumulative_bounds(weights)
    whens = " ".join(f"WHEN {u_sql} < CAST({b!r} AS DOUBLE) THEN {i}"
                     for i, b in enumerate(bounds[:-1]))
    return f"CASE {whens} ELSE {len(bounds) - 1} END"


def _sql_index(tbl: str, key: str, base: int = 0) -> str:
    return (f"SELECT CAST(row_number() OVER (ORDER BY {key} ASC NULLS FIRST) - 1 + {base}"
            f" AS BIGINT) AS row_index, * FROM {tbl}")


def _sql_label_codes(tbl: str, col: str) -> str:
    return (f"SELECT {col}, CAST(row_number() OVER (ORDER BY count(*) DESC, {col} ASC) - 1"
            f" AS DOUBLE) AS code FROM {tbl} GROUP BY {col}")


def _oracle() -> dict[str, str]:
    ws = WHITESPACE_RUN
    sql: dict[str, str] = {}
    sql["word_count"] = (
        "SELECT word, count(*) AS count FROM ("
        f"SELECT unnest(regexp_split_to_array(lower(text), '{ws}')) AS word FROM documents"
        ") WHERE word <> '' GROUP BY word")
    sql["field_count_top10"] = (
        "SELECT o_orderpriority AS key, count(*) AS count FROM orders GROUP BY o_orderpriority "
        f"ORDER BY count DESC, key ASC LIMIT {TOP_K}")
    sql["tokens_per_document"] = (
        "SELECT doc_id, count(*) AS count FROM ("
        f"SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{ws}')) AS word "
        "FROM documents) WHERE word <> '' GROUP BY doc_id")
    sql["field_count_short_lines"] = (
        f"SELECT CASE WHEN c_acctbal > {RICH_ACCTBAL!r} THEN c_mktsegment END AS key, "
        "count(*) AS count FROM customer GROUP BY 1")
    sql["custkey_top10"] = (
        "SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey "
        f"ORDER BY count DESC, o_custkey ASC LIMIT {TOP_K}")
    sql["row_counts"] = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
    sql["row_index"] = _sql_index("orders", "o_orderkey")
    sql["row_index_scan_order"] = (
        "SELECT count(*) AS n, CAST(0 AS BIGINT) AS min_index, CAST(count(*) - 1 AS BIGINT)"
        " AS max_index, count(*) AS distinct_index, CAST(0 AS BIGINT) AS out_of_order FROM orders")
    close = "CAST(1152921504606846976 + l_linenumber % 2 AS BIGINT)"
    sql["index_close_keys"] = (
        "SELECT big_key, count(*) AS n, min(i) AS min_index, max(i) AS max_index FROM ("
        f"SELECT {close} AS big_key, row_number() OVER (ORDER BY {close}) - 1 AS i FROM lineitem"
        ") GROUP BY big_key")
    sql["index_after_join"] = (
        "SELECT count(*) AS n, CAST(0 AS BIGINT) AS min_index, CAST(count(*) - 1 AS BIGINT)"
        " AS max_index, count(*) AS distinct_index FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    segment = f"CASE WHEN c_acctbal > {RICH_ACCTBAL!r} THEN c_mktsegment END"
    sql["index_text_key"] = (
        f"SELECT row_number() OVER (ORDER BY {segment} NULLS FIRST, c_custkey) AS row_index, "
        f"{segment} AS segment, c_custkey FROM customer")
    sql["name_index"] = (
        f"WITH c AS ({_sql_label_codes('customer', 'c_name')}) "
        "SELECT c_custkey, customer.c_name, c.code FROM customer JOIN c USING (c_name)")
    sql["delimited_orders"] = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
        "printf('%.4f', o_totalprice) AS price_text FROM orders")
    sql["inferred_types"] = (
        "SELECT v.column, v.type, CAST(CASE v.column WHEN 'none' THEN 0 WHEN 'gaps' THEN n - thirds ELSE n END AS BIGINT) "
        "AS n_values, CAST(CASE v.column WHEN 'none' THEN n WHEN 'gaps' THEN thirds ELSE 0 END AS BIGINT) AS n_null, "
        "CAST(0 AS BIGINT) AS n_misfit FROM (VALUES ('key', 'int'), ('wide', 'bigint'), ('price', 'double'), "
        "('day', 'date'), ('even', 'boolean'), ('none', 'string'), ('gaps', 'int'), ('mixed', 'string')) "
        "AS v(\"column\", type), (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS thirds FROM orders)")
    sql["inferred_misfits"] = (
        "SELECT 'mixed' AS \"column\", 'n/a ' || o_orderkey AS value FROM orders "
        f"WHERE o_orderkey % {BAD_EVERY} = 0")
    sql["iris_file"] = (
        "SELECT c_mktsegment AS species, count(*) AS n, sum((c_custkey % 80) / 8.0::DOUBLE) AS sepal_length, "
        "sum((c_custkey % 40) / 8.0::DOUBLE) AS sepal_width, sum((c_custkey % 70) / 8.0::DOUBLE) AS petal_length, "
        "sum((c_custkey % 24) / 8.0::DOUBLE) AS petal_width FROM customer GROUP BY c_mktsegment")
    sql["words_in_text_files"] = (
        "SELECT word, count(*) AS count FROM ("
        f"SELECT unnest(regexp_split_to_array(lower(concat_ws(' ', p_name, p_type)), '{ws}')) AS word FROM part"
        ") WHERE word <> '' GROUP BY word")
    sql["unique_ids"] = "SELECT count(*) AS n, count(*) AS distinct_ids FROM lineitem"
    sql["systematic_sample"] = (
        f"SELECT * FROM ({_sql_index('orders', 'o_orderkey')}) "
        f"WHERE ((row_index - {SAMPLE_START}) % {SAMPLE_STEP} + {SAMPLE_STEP}) % {SAMPLE_STEP} = 0")
    sql["systematic_sample_1based"] = (
        f"SELECT * FROM ({_sql_index('events', 'event_id', 1)}) "
        f"WHERE row_index % {SAMPLE_STEP} = {ONE_BASED_OFFSET}")
    sql["sample_head5"] = sql["systematic_sample_1based"] + " ORDER BY row_index LIMIT 5"
    sql["systematic_partition"] = (
        f"SELECT row_index % {N_PARTS} AS part, row_index, o_orderkey, o_custkey "
        f"FROM ({_sql_index('orders', 'o_orderkey')})")
    sql["systematic_partition_sizes"] = (
        f"SELECT row_index % {N_PARTS} AS part, count(*) AS num_rows, "
        "min(o_orderkey) AS min_orderkey, max(o_orderkey) AS max_orderkey "
        f"FROM ({_sql_index('orders', 'o_orderkey')}) GROUP BY 1")
    sql["interval_sample"] = (
        f"SELECT i.* FROM ({_sql_index('events', 'event_id')}) i, "
        f"(SELECT greatest(1, count(*) // {INTERVAL_TARGET}) AS k FROM events) s "
        "WHERE i.row_index % s.k = 0")
    sql["interval_sample_scan"] = (
        f"SELECT i.row_index, i.o_orderkey, i.o_custkey FROM ({_sql_index('orders', 'o_orderkey')}) i, "
        f"(SELECT greatest(1, count(*) // {INTERVAL_TARGET}) AS k FROM orders) s WHERE (i.row_index - 1) % s.k = 0")
    sql["moved_sample"] = (
        f"SELECT event_id, event_type FROM ({_sql_index('(FROM events WHERE event_type IS NOT NULL)', 'event_id')}) "
        f"WHERE row_index % {SAMPLE_STEP} = {SAMPLE_START}")
    sql["scan_order_sample"] = (
        "SELECT count(*) AS n, min(i) AS min_index, max(i) AS max_index, count(DISTINCT i) AS distinct_index FROM ("
        "SELECT row_number() OVER () - 1 AS i FROM lineitem) "
        f"WHERE i % {SAMPLE_STEP} = {SAMPLE_START}")
    sql["random_split_3way"] = (
        "SELECT o_orderkey, o_custkey, "
        f"{_sql_bucket(_sql_uniform('o_orderkey', str(SPLIT3_SEED)), SPLIT3_WEIGHTS)} AS split "
        "FROM orders")
    sql["train_test_split"] = (
        "SELECT event_id, event_type, "
        f"{_sql_bucket(_sql_uniform('event_id', str(TRAIN_SEED)), TRAIN_WEIGHTS)} AS split "
        "FROM events")
    offsets = experiment_offsets()
    values = ", ".join(f"({i + 1}, {o}, {SPLIT_SEED_BASE + i})" for i, o in enumerate(offsets))
    flag = (f"CASE WHEN {_sql_uniform('i.event_id', 'e.seed')} < "
            f"CAST({TRAIN_WEIGHTS[0]!r} AS DOUBLE) THEN 1 ELSE 0 END")
    sql["experiment_sizes"] = (
        f"WITH e(experiment_id, start_offset, seed) AS (VALUES {values}), "
        f"i AS ({_sql_index('events', 'event_id')}) "
        "SELECT e.experiment_id, e.start_offset, count(i.event_id) AS num_samples, "
        f"CAST(coalesce(sum({flag}), 0) AS BIGINT) AS num_train, "
        f"CAST(count(i.event_id) - coalesce(sum({flag}), 0) AS BIGINT) AS num_test "
        f"FROM e LEFT JOIN i ON i.row_index % {SAMPLE_STEP} = e.start_offset "
        "GROUP BY e.experiment_id, e.start_offset")
    flagged = (f"SELECT o_orderkey, o_orderstatus, CASE WHEN o_totalprice > {FLAG_PRICE!r} THEN 1 ELSE 0 END"
               " AS flag FROM orders")

    def majority(samples: str, by: str) -> str:
        """Sizes and accuracy by ``by`` of ``samples`` (by columns, o_orderstatus, flag, is_train)."""
        return (
            f"s AS ({samples}), "
            f"n AS (SELECT {by}, flag, o_orderstatus AS guess, count(*) AS here FROM s WHERE is_train = 1 "
            f"GROUP BY {by}, flag, o_orderstatus), "
            f"o AS (SELECT *, sum(here) OVER (PARTITION BY {by}, guess) AS overall FROM n), "
            f"m AS (SELECT {by}, flag, guess FROM o QUALIFY row_number() OVER "  # ties as the label codes go
            f"(PARTITION BY {by}, flag ORDER BY here DESC, overall DESC, guess) = 1), "
            f"r AS (SELECT {by}, count(*) AS num_samples, sum(is_train)::BIGINT AS num_train, "
            "sum(1 - is_train)::BIGINT AS num_test, "
            "round(avg(CASE WHEN is_train = 0 THEN (o_orderstatus = guess)::INT END), 10) AS accuracy "
            f"FROM s JOIN m USING ({by}, flag) GROUP BY {by})")

    train = (f"CASE WHEN {_sql_uniform('i.o_orderkey', 'e.seed')} < "
             f"CAST({TRAIN_WEIGHTS[0]!r} AS DOUBLE) THEN 1 ELSE 0 END AS is_train")
    orders_at = _sql_index(f"({flagged})", "o_orderkey")
    drawn = (f"SELECT e.experiment_id, e.start_offset, i.o_orderstatus, i.flag, {train} "
             f"FROM e JOIN i ON i.row_index % {SAMPLE_STEP} = e.start_offset")
    plan = f"WITH e(experiment_id, start_offset, seed) AS (VALUES {values}), i AS ({orders_at}), "
    experiments = plan + majority(drawn, "experiment_id, start_offset")
    sql["majority_tree"] = sql["majority_forest"] = (
        experiments + " SELECT *, CAST(NULL AS VARCHAR) AS error FROM r")
    sql["separable_svm"] = (
        experiments + " SELECT * REPLACE (1.0::DOUBLE AS accuracy), CAST(NULL AS VARCHAR) AS error FROM r")
    turned = ("SELECT o_orderkey, CASE WHEN (o_totalprice > {0!r}) = (o_custkey % 5 <> 0) THEN 'up' ELSE 'down' END "
              "AS o_orderstatus, CASE WHEN o_totalprice > {0!r} THEN 1 ELSE 0 END AS flag FROM orders").format(FLAG_PRICE)
    sql["majority_svm"] = (
        f"WITH e(experiment_id, start_offset, seed) AS (VALUES {values}), "
        f"i AS ({_sql_index(f'({turned})', 'o_orderkey')}), " + majority(drawn, "experiment_id, start_offset")
        + " SELECT *, CAST(NULL AS VARCHAR) AS error FROM r")
    sql["majority_summary"] = (
        experiments + " SELECT count(*) AS planned, count(accuracy) AS finished, "
        "round(avg(accuracy), 9) AS avg_accuracy, min(accuracy) AS min_accuracy, max(accuracy) AS max_accuracy, "
        f"printf('%.2f', {N_EXPERIMENTS * 0.25!r}) AS quarter_text FROM r")
    part_train = (f"CASE WHEN {_sql_uniform('o_orderkey', '1')} < "
                  f"CAST({TRAIN_WEIGHTS[0]!r} AS DOUBLE) THEN 1 ELSE 0 END AS is_train")
    for key, source, part in (
            ("majority_parts", orders_at, f"CAST(row_index % {N_PARTS} AS INT)"),
            ("majority_random_parts", flagged,
             _sql_bucket(_sql_uniform("o_orderkey", str(SPLIT3_SEED)), SPLIT3_WEIGHTS))):
        drawn = f"SELECT {part} AS part, o_orderstatus, flag, {part_train} FROM ({source})"
        sql[key] = "WITH " + majority(drawn, "part") + " SELECT *, CAST(NULL AS VARCHAR) AS error FROM r"
    two = ("SELECT o_orderkey, o_orderstatus, (CASE WHEN o_totalprice > "
           f"{FLAG_PRICE!r} THEN 1 ELSE 0 END) * 2 + (o_custkey % 3 = 0)::INT AS flag FROM orders")
    drawn = (f"SELECT e.experiment_id, e.start_offset, i.o_orderstatus, i.flag, {train} "
             f"FROM e JOIN i ON i.row_index % {SAMPLE_STEP} = e.start_offset")
    sql["levelwise_tree"] = (
        f"WITH e(experiment_id, start_offset, seed) AS (VALUES {values}), "
        f"i AS ({_sql_index(f'({two})', 'o_orderkey')}), " + majority(drawn, "experiment_id, start_offset")
        + " SELECT *, CAST(NULL AS VARCHAR) AS error FROM r")
    all_offsets = ", ".join(f"({i + 1}, {i}, {SPLIT_SEED_BASE + i})" for i in range(SAMPLE_STEP))
    in_train = _sql_uniform("i.c_custkey", "e.seed") + f" < CAST({TRAIN_WEIGHTS[0]!r} AS DOUBLE)"
    sql["level_cut"] = (
        f"WITH e(experiment, start_offset, seed) AS (VALUES {all_offsets}), i AS ({_sql_index('customer', 'c_custkey')}), "
        f"s AS (SELECT e.experiment, c_custkey % {CUT_LEVELS} AS g, (c_acctbal > {RICH_ACCTBAL!r})::INT AS rich "
        f"FROM e JOIN i ON i.row_index % {SAMPLE_STEP} = e.start_offset WHERE {in_train}), "
        "c AS (SELECT experiment, g, count(*)::DOUBLE AS n, sum(rich)::DOUBLE AS r FROM s GROUP BY ALL), "
        "t AS (SELECT *, sum(n) OVER x AS tn, sum(r) OVER x AS tr FROM c WINDOW x AS (PARTITION BY experiment)), "
        "o AS (SELECT *, CASE WHEN 2 * tr > tn THEN -r / n ELSE r / n - 1 END AS rank FROM t), "
        "p AS (SELECT *, sum(n) OVER x AS ln, sum(r) OVER x AS lr, row_number() OVER x AS k FROM o "
        "WINDOW x AS (PARTITION BY experiment ORDER BY rank, g::VARCHAR)), "
        "q AS (SELECT *, round(2 * (tr / tn * (1 - tr / tn) - ln / tn * (lr / ln) * (1 - lr / ln) - (tn - ln) / tn * "
        "((tr - lr) / (tn - ln)) * (1 - (tr - lr) / (tn - ln))), 9) AS gain FROM p WHERE ln < tn) "
        "SELECT experiment, gain, k AS levels_left, ln::BIGINT AS rows_left FROM q "
        "QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY gain DESC, rank, g::VARCHAR DESC) = 1")
    sql["name_tree"] = (  # all known levels of the main class go left; unknown ones meet the other class
        f"WITH e(experiment_id, start_offset, seed) AS (VALUES {values}), i AS ({_sql_index('customer', 'c_custkey')}), "
        f"s AS (SELECT e.experiment_id, e.start_offset, (c_acctbal > {RICH_ACCTBAL!r})::INT AS rich, "
        f"({in_train})::INT AS t FROM e JOIN i ON i.row_index % {SAMPLE_STEP} = e.start_offset), "
        f"f AS (SELECT (count(*) FILTER (WHERE c_acctbal > {RICH_ACCTBAL!r}) * 2 > count(*))::INT AS rich_first, "
        f"(count(*) FILTER (WHERE c_acctbal > {RICH_ACCTBAL!r}) * 2 = count(*)) AS even FROM customer), "
        "m AS (SELECT experiment_id, start_offset, count(*) AS num_samples, sum(t)::BIGINT AS num_train, "
        "sum(1 - t)::BIGINT AS num_test, sum(t * rich) AS tr, avg(CASE WHEN t = 0 THEN rich END) AS test_rich "
        "FROM s GROUP BY ALL) "
        "SELECT experiment_id, start_offset, num_samples, num_train, num_test, "
        "round(CASE WHEN 2 * tr > num_train OR 2 * tr = num_train AND rich_first = 1 THEN 1 - test_rich "
        "ELSE test_rich END, 10) AS accuracy, CAST(NULL AS VARCHAR) AS error FROM m, f")
    few = ", ".join(f"({i + 1}, {i}, {SPLIT_SEED_BASE + i})" for i in range(FEW_STEP))
    few_train = (f"CASE WHEN {_sql_uniform('i.n_nationkey', 'e.seed')} < "
                 f"CAST({TRAIN_WEIGHTS[0]!r} AS DOUBLE) THEN 1 ELSE 0 END")
    sql["finished_experiments"] = (
        f"WITH e(experiment_id, start_offset, seed) AS (VALUES {few}), i AS ({_sql_index('nation', 'n_nationkey')}), "
        f"s AS (SELECT e.experiment_id, e.start_offset, {few_train} AS t FROM e JOIN i "
        f"ON i.row_index % {FEW_STEP} = e.start_offset) "
        "SELECT experiment_id, start_offset, count(*) AS num_samples, sum(t)::BIGINT AS num_train, "
        "sum(1 - t)::BIGINT AS num_test, 1.0::DOUBLE AS accuracy, CAST(NULL AS VARCHAR) AS error FROM s "
        "GROUP BY ALL HAVING sum(t) BETWEEN 1 AND count(*) - 1")
    empty = ", ".join(f"({i + 1}, {o}, {SPLIT_SEED_BASE + i})" for i, o in enumerate(EMPTY_OFFSETS))
    is_train = (f"CASE WHEN {_sql_uniform('i.n_nationkey', 'e.seed')} < "
                f"CAST({TRAIN_WEIGHTS[0]!r} AS DOUBLE) THEN 1 ELSE 0 END")
    sql["empty_samples"] = (
        f"WITH e(experiment_id, start_offset, seed) AS (VALUES {empty}), "
        f"i AS ({_sql_index('nation', 'n_nationkey')}) "
        "SELECT e.experiment_id, e.start_offset, count(i.n_nationkey) AS num_samples, "
        f"coalesce(sum({is_train}) FILTER (WHERE i.n_nationkey IS NOT NULL), 0)::BIGINT AS num_train, "
        f"coalesce(sum(1 - {is_train}) FILTER (WHERE i.n_nationkey IS NOT NULL), 0)::BIGINT AS num_test, "
        "CAST(NULL AS DOUBLE) AS accuracy, CASE WHEN count(i.n_nationkey) = 0 THEN 'empty sample' "
        "ELSE 'empty train or test part' END AS error "
        f"FROM e LEFT JOIN i ON i.row_index % {EMPTY_STEP} = e.start_offset "
        "GROUP BY e.experiment_id, e.start_offset")
    sql["finished_of_planned"] = (
        f"SELECT {len(EMPTY_OFFSETS)}::BIGINT AS planned, 0::BIGINT AS finished, true AS no_average")
    sql["label_index"] = (
        f"WITH c AS ({_sql_label_codes('events', 'event_type')}) "
        "SELECT ev.event_id, ev.event_type, c.code AS label FROM events ev "
        "JOIN c USING (event_type)")
    sql["category_index"] = (
        f"WITH s AS ({_sql_label_codes('orders', 'o_orderstatus')}), "
        f"p AS ({_sql_label_codes('orders', 'o_orderpriority')}) "
        "SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority, "
        "s.code AS o_orderstatus_indexed, p.code AS o_orderpriority_indexed FROM orders o "
        "JOIN s USING (o_orderstatus) JOIN p USING (o_orderpriority)")
    sql["typed_rows"] = (
        "SELECT p_partkey AS partkey, p_brand AS brand, CAST(p_size AS DOUBLE) AS size, "
        "p_retailprice AS retailprice FROM part")
    sql["assembled"] = (
        "SELECT l_orderkey, l_linenumber, l_quantity AS f_quantity, "
        "l_extendedprice AS f_extendedprice, l_discount AS f_discount, l_tax AS f_tax "
        "FROM lineitem")
    sql["scaled"] = (
        "SELECT l_orderkey, l_linenumber, "
        "round(l_quantity / (SELECT stddev_samp(l_quantity) FROM lineitem), 4) "
        "AS quantity_scaled, "
        "round(l_extendedprice / (SELECT stddev_samp(l_extendedprice) FROM lineitem), 4) "
        "AS extendedprice_scaled FROM lineitem")
    pred = (f"CAST(quality AS DOUBLE) AS label, "
            f"CAST(CASE WHEN n_chars > {LONG_DOC_CHARS} THEN 1 ELSE 0 END AS DOUBLE) AS prediction")
    rule = f"SELECT {pred} FROM documents JOIN labels USING (doc_id)"
    sql["accuracy"] = (
        "SELECT count(*) AS n, CAST(sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) "
        "AS BIGINT) AS n_correct, avg(CAST(label = prediction AS DOUBLE)) "
        f"AS accuracy FROM ({rule})")
    by_part = (
        f"SELECT ri % {SAMPLE_STEP} AS part, count(*) AS num_samples, "
        "avg(CAST(label = prediction AS DOUBLE)) AS accuracy FROM ("
        "SELECT label, prediction, row_number() OVER (ORDER BY doc_id ASC NULLS FIRST) - 1 "
        f"AS ri FROM (SELECT doc_id, {pred} FROM documents JOIN labels USING (doc_id))) "
        "GROUP BY 1")
    sql["rule_accuracy_by_part"] = by_part
    sql["rule_accuracy_summary"] = (
        "SELECT count(*) AS planned, count(accuracy) AS finished, "
        "round(avg(accuracy), 10) AS avg_accuracy, min(accuracy) AS min_accuracy, "
        f"max(accuracy) AS max_accuracy FROM ({by_part})")
    sql["confusion"] = (
        f"SELECT label, prediction, count(*) AS count FROM ({rule}) GROUP BY label, prediction")
    return sql


ORACLE_SQL: dict[str, str] = _oracle()
