"""Write the physical plan of every SQL-checked registered query to PLANS.md.

    python scripts/plan_report.py [sf_dir]

Plans are taken before execution (AQE may still coalesce partitions or switch
join sides at run time); paths and plan ids are stripped for readability.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from sampwise.plans.catalog import ORACLE_SQL, QUERIES
    from sampwise.session import local_session

    spark = local_session(8, 8)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `scripts/plan_report.py` on `{os.path.basename(sf_dir)}` with "
           "`local[8]`, 8 shuffle partitions, AQE on (plans before execution).", ""]
    for name in ORACLE_SQL:
        text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().explainString(mode)
        text = re.sub(r", \[plan_id=\d+\]", "", text)
        text = re.sub(r"Location: \w+\([^)]*\)\[[^\]]*\], ", "", text)
        text = re.sub(r"#\d+L?", "", text)
        out += [f"## {name}", "", "```", text.strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
