"""Row index at a size where one task becomes the bottleneck.

    python scripts/scale_probe.py [rows] [out_dir]

Writes a synthetic parquet table (unique shuffled key, a key where a third of
the rows share one value, a payload) to ``out_dir`` (a fresh temporary folder
by default), then times, on local[8]:

* ours: ``with_row_index(df, key)`` (sampled key ranges, hot key spread);
* one-task window: ``row_number() OVER (ORDER BY key)`` without partitions;
* ours in scan order vs ``rdd.zipWithIndex`` (only for the first 5M rows: the
  RDD path moves every row through Python).

Each run fully executes with a ``noop`` write.  Prints one JSON line.
This is a measurement script, not a registered query.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv) -> int:
    rows = int(argv[1]) if len(argv) > 1 else 20_000_000
    out_dir = argv[2] if len(argv) > 2 else tempfile.mkdtemp(prefix="sw-scale-")
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from sampwise.operators.index import with_row_index
    from sampwise.session import local_session

    spark = local_session(8, 64, app="scale-probe")
    path = os.path.join(out_dir, "t.parquet")
    if not os.path.exists(path):
        (spark.range(0, rows, 1, 64)
         .select(((F.col("id") * 2654435761) % rows).alias("key"),
                 F.when(F.col("id") % 3 == 0, F.lit(-1))
                 .otherwise((F.col("id") * 40503) % rows).alias("hot_key"),
                 F.sha1(F.col("id").cast("string")).alias("payload"),
                 (F.col("id") % 1000).cast("double").alias("value"))
         .write.parquet(path))
    df = spark.read.parquet(path)
    res: dict[str, float] = {"rows": rows, "splits": df.rdd.getNumPartitions()}

    def timed(name, make):
        t0 = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        res[name] = round(time.perf_counter() - t0, 2)

    one_task = Window.orderBy("key")
    timed("ours_key_order", lambda: with_row_index(df, "key"))
    timed("one_task_window_key_order",
          lambda: df.select((F.row_number().over(one_task) - 1).alias("row_index"), "*"))
    timed("ours_hot_key_order", lambda: with_row_index(df, "hot_key"))
    hot_task = Window.orderBy("hot_key")
    timed("one_task_window_hot_key",
          lambda: df.select((F.row_number().over(hot_task) - 1).alias("row_index"), "*"))
    small = spark.read.parquet(path).limit(5_000_000)
    small_path = os.path.join(out_dir, "t5m.parquet")
    if not os.path.exists(small_path):
        small.write.parquet(small_path)
    df5 = spark.read.parquet(small_path)
    timed("ours_scan_order_5m", lambda: with_row_index(df5))
    t0 = time.perf_counter()
    df5.rdd.zipWithIndex().map(lambda x: x[1]).count()
    res["rdd_zip_with_index_5m"] = round(time.perf_counter() - t0, 2)
    print(json.dumps(res), flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
