"""No registered query gathers data rows in one task.

The only ``Exchange SinglePartition`` allowed carries aggregate buffers (a
global count/sum/min/max over one partial row per task) or the library's
per-group count tables (``_sw_*`` columns, one row per range or split).
"""

import pytest

from sampwise.plans.catalog import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

ALLOWED = ("_sw_", "count#", "sum#", "min#", "max#", "avg#", "planned#", "finished#")


def single_partition_inputs(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(
        "formatted")
    text = df._jdf.queryExecution().explainString(mode)
    out = []
    for block in text.split("\n\n"):
        if "Arguments: SinglePartition" in block:
            line = next(l for l in block.splitlines() if l.startswith("Input"))
            out.append(line.split("[", 2)[2].rstrip("]").split(", "))
    return out


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_no_data_rows_through_one_task(spark, name):
    for cols in single_partition_inputs(QUERIES[name](spark, SF_SMALL)):
        assert all(c.startswith(ALLOWED) for c in cols), (name, cols)
