"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "sampwise") -> SparkSession:
    """Session for tests and the bench: local mode, UI off, UTC, AQE on."""
    n = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, installing it on the context if needed.

    The cluster names it in ``spark.checkpoint.dir``; that setting always wins.
    Only a local-mode session without the setting (tests) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sampwise-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...) for it")
    return sc.getCheckpointDir()


def stored_table(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back.

    Cuts the lineage and fixes the rows: every later read sees the same files.  The
    files stay in that scratch folder until the cluster clears it.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"sampwise-{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
