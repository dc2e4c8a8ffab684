"""Spark session settings shared by tests, bench and the entry module."""
from __future__ import annotations

import math
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in the library assumes: UTC clock, ANSI arithmetic,
# adaptive execution (coalescing and skew-join splitting at runtime).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # broadcast only what the planner has proven small
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


RESULT_CONF = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "sparkfin", checkpoint_dir: str | None = None) -> SparkSession:
    master = master or os.environ.get("SPARK_MASTER", "local[*]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if checkpoint_dir:
        b = b.config("spark.checkpoint.dir", checkpoint_dir)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    b = b.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    # checkpoint files of DataFrames that went out of scope are removed
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (or a folder set on the context) is used as is.
    Only a local session, whose one JVM sees its own scratch folder, gets one
    made where none is set; on a cluster a missing setting is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors of {master} share")
        d = tempfile.mkdtemp(prefix="sparkfin-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def apply_conf(spark: SparkSession) -> None:
    """Set on a session made elsewhere what results depend on: the clock and
    ANSI arithmetic.  Memory, broadcast and shuffle settings stay the caller's."""
    for k in RESULT_CONF:
        spark.conf.set(k, BASE_CONF[k])


def cut_lineage(df):
    """Materialise ``df`` as a reliable checkpoint in the shared checkpoint
    folder (never a local checkpoint): later passes read it back instead of
    recomputing the plan, and a lost executor does not force a recompute."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df):
    """``df`` written once to the shared checkpoint folder and read back, as
    compressed columns: later passes read only what they need, its rows are
    counted without a pass, and the planner knows its size."""
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), "written", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_key(df, *keys: str, rows: int = 250_000):
    """A written table dealt by key into as many tasks as hold about ``rows``
    rows each, so what a task sorts does not grow with the table."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(df.count() / rows))
    return df.repartition(tasks, *keys)
