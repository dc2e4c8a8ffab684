"""Incremental daily capture as a Structured Streaming job.

The reference walks day by day over [after, before) windows and saves one
result per day, the last day included.  Here a file stream of events is
de-duplicated by id within a one-day watermark; each micro-batch writes the
rows it accepts under its batch number (overwritten when a batch is repeated),
and the result counts them by day and type, so open days are there as soon as
their rows are.  Rows more than a day late are not counted; ``late_rows``
returns them.  ``availableNow`` processes what is there and stops.

The folder is the caller's: a job started again with the same folder goes on
where it stopped.  A manifest of the source files (name, length, time) is part
of its state.  New files are new arrivals; where a known file was replaced or
has gone, what was counted no longer holds, and a new run counts all files.
"""
from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def _files(spark: SparkSession, source_dir: str, file_glob: str) -> set[tuple[str, int, int]]:
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(source_dir, file_glob))
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return {(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found}


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def _save_manifest(spark: SparkSession, run: str, files: set) -> None:
    """Written under another name first: a manifest is whole or not there."""
    (fs, draft), (_, path) = _at(spark, f"{run}/manifest.draft"), _at(spark, f"{run}/manifest.json")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(sorted(files)).encode()))
    out.close()
    fs.delete(path, False)
    fs.rename(draft, path)


def _manifest(spark: SparkSession, run: str) -> set | None:
    fs, path = _at(spark, f"{run}/manifest.json")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return {tuple(x) for x in json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))}
    finally:
        stream.close()


def _last_run(spark: SparkSession, folder: str) -> int:
    n = 0
    while _exists(spark, f"{folder}/run-{n + 1}"):
        n += 1
    return n


def _current_run(spark: SparkSession, folder: str, files: set) -> str:
    """The run that what is there belongs to, or a new one."""
    n = _last_run(spark, folder)
    if n and (known := _manifest(spark, f"{folder}/run-{n}")) is not None and known <= files:
        return f"{folder}/run-{n}"
    return f"{folder}/run-{n + 1}"


def daily_windows(spark: SparkSession, source_dir: str, folder: str, file_glob: str = "events.parquet",
                  watermark: str = "1 day") -> DataFrame:
    files = _files(spark, source_dir, file_glob)
    run = _current_run(spark, folder, files)
    _save_manifest(spark, run, files)
    schema = spark.read.parquet(os.path.join(source_dir, file_glob)).schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
           .option("maxFilesPerTrigger", 64).parquet(source_dir))
    events = (src.withColumn("ts", F.col("ts").cast("timestamp"))
              .withWatermark("ts", watermark)
              .dropDuplicatesWithinWatermark(["event_id"]))

    def save(batch: DataFrame, number: int) -> None:
        # values are cents: summed as decimals, the total is exact and
        # independent of the order rows arrive in (replays give the same bits)
        batch.select("event_id", F.to_date("ts").alias("day"), "event_type", F.col("value").cast("decimal(18,2)").alias("value")) \
            .write.mode("overwrite").parquet(f"{run}/accepted/batch={number}")

    q = (events.writeStream.outputMode("append").foreachBatch(save)
         .option("checkpointLocation", f"{run}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return _accepted(spark, run, schema).groupBy("day", "event_type") \
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").cast("double").alias("value_sum"))


def _accepted(spark: SparkSession, run: str, schema) -> DataFrame:
    kind = schema["event_id"].dataType.simpleString()
    return spark.read.schema(f"event_id {kind}, day date, event_type string, value decimal(18,2), batch long").parquet(f"{run}/accepted")


def late_rows(spark: SparkSession, source_dir: str, folder: str, file_glob: str = "events.parquet") -> DataFrame:
    """Source rows that the last run did not count because they came later than
    the watermark: those whose id no batch has accepted."""
    rows = spark.read.parquet(os.path.join(source_dir, file_glob))
    return rows.join(_accepted(spark, f"{folder}/run-{_last_run(spark, folder)}", rows.schema).select("event_id"), "event_id", "left_anti")
