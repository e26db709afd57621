"""sampwise: counting, systematic sampling and sample-wise model comparison on Spark."""

from .operators.counts import (count_by, field_count, head, row_counts, tokenize,
                               top_k, word_count)
from .operators.features import (assemble, feature_pipeline, index_columns, scale_columns,
                                 vector_columns)
from .operators.index import with_row_index, with_unique_id
from .operators.metrics import accuracy, accuracy_value, confusion
from .operators.models import decision_tree, linear_svm, random_forest, train_and_score
from .operators.sampling import (draw_offsets, hash_split, interval_sample, random_split,
                                 sampling_interval, systematic_partition, systematic_sample,
                                 train_test_split)
from .plans.experiments import finished, run_experiments, run_per_part, summarise
from .sources import (clean_column_names, from_rows, read_delimited, read_iris, read_lines,
                      table, to_typed)

__all__ = [
    "accuracy", "accuracy_value", "assemble", "clean_column_names", "confusion", "count_by",
    "decision_tree", "draw_offsets", "feature_pipeline", "field_count", "finished",
    "from_rows", "hash_split", "head", "index_columns", "interval_sample", "linear_svm",
    "random_forest", "random_split", "read_delimited", "read_iris", "read_lines",
    "row_counts", "run_experiments", "run_per_part", "sampling_interval", "scale_columns",
    "summarise", "systematic_partition", "systematic_sample", "table", "to_typed",
    "tokenize", "top_k", "train_and_score", "train_test_split", "vector_columns",
    "with_row_index", "with_unique_id", "word_count",
]
