"""Time every registered query; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [name ...]

Each query is fully executed with a ``noop`` write (every row computed, nothing
collected to the driver).  ``value`` is the sum over all queries, in seconds.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main(argv: list[str]) -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from sampwise.plans.catalog import QUERIES
    from sampwise.session import local_session

    spark = local_session(cpus, int(cpus) if cpus != "*" else None, app="sampwise-bench")
    # warm-up outside the timings: JVM JIT, codegen, shuffle and the parquet
    # reader, on synthetic rows (no query of the catalog, nothing cached)
    from pyspark.sql import functions as F
    spark.read.parquet(os.path.join(sf_dir, "region.parquet")).write.format("noop") \
        .mode("overwrite").save()
    for _ in range(2):
        (spark.range(0, 2_000_000, 1, 8)
         .select((F.col("id") % 1000).alias("k"), F.concat_ws(" ", F.col("id").cast("string"),
                                                              F.lit("a b")).alias("t"))
         .select("k", F.explode(F.split("t", " ")).alias("w"))
         .groupBy("k", "w").count().write.format("noop").mode("overwrite").save())
        spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string").collect()
    names = argv[1:] or list(QUERIES)
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep timing the others; report the failure
            errors[name] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir.rstrip("/"))
    out = {"metric": "total_query_seconds", "value": round(sum(timings.values()), 3),
           "unit": "sec", "queries": timings, "sf": float(m.group(1)) if m else sf_dir,
           "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out), flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
