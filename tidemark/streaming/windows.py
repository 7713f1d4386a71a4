"""Hours by event time: each hour's page views once, when it is over.

:func:`hours_closed` counts parsed lines in typed one-hour windows of the
record time, with a watermark: an hour is emitted once, when the newest record
seen is ``delay`` past its end, and its state is dropped then.  Records that
come later than that are not counted; :func:`late_rows_writer` keeps them, with
their positions, in an output of their own, so that no line disappears.

What is late is the engine's own rule (the hour's end is not after the
watermark of the batch before, which is what the batches before that one left),
applied to the newest record time that their commits have on record.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.logparse import parse_ok
from tidemark.operators.parse import with_log_fields
from tidemark.sources import fs
from tidemark.sources.files import read_parquet_or_empty
from tidemark.sources.kafka import utc_clock
from tidemark.streaming import commits
from tidemark.streaming.runner import BatchFn

HOUR = "1 hour"
HOURS_SCHEMA = "hour STRING, pv BIGINT, batch_id BIGINT"
LATE_SCHEMA = ("topic STRING, partition INT, offset BIGINT, value STRING, ts TIMESTAMP_NTZ, "
               "epoch INT, batch_id BIGINT, attempt STRING")


def parsed_times(records: DataFrame) -> DataFrame:
    """``(topic, partition, offset, value, ts)`` of the lines that parse."""
    return with_log_fields(records).where(parse_ok()).select("topic", "partition", "offset", "value", "ts")


def _instant(name: str) -> Column:
    """A wall clock as the instant it is in UTC, whatever the session's time
    zone (watermarks are instants)."""
    return F.expr(f"to_timestamp_ltz(concat(cast({name} as string), 'Z'))")


def hours_closed(records: DataFrame, delay: str) -> DataFrame:
    """``(hour, pv)`` of hours that are over, for append mode."""
    timed = parsed_times(records).select(_instant("ts").alias("at")).withWatermark("at", delay)
    return (timed.groupBy(F.window("at", HOUR)).agg(F.count(F.lit(1)).alias("pv"))
            .select(F.date_format(utc_clock("window.start"), "yyyy-MM-dd-HH").alias("hour"), "pv"))


def append_writer(path: str) -> BatchFn:
    """What each batch emits, replaced when it is replayed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
    return write


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet_or_empty(spark, HOURS_SCHEMA, path).select("hour", "pv")


def _newest_time(spark: SparkSession, path: str, batch: tuple[int, int]) -> str | None:
    """The newest record time on record with the commit of ``batch``."""
    if batch not in commits.listed(spark, path):
        return None
    e, b = batch
    return json.loads(fs.read_text(spark, f"{commits.log_of(spark, path)}/epoch={e}/batch_id={b}/commit.json"))["newest"]


def late_rows_writer(path: str, delay: str, epoch: int = 0) -> BatchFn:
    """``foreachBatch`` body: records whose hour was over when they came, by
    ``(epoch, batch_id, attempt)``, and a commit with the newest time seen."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if commits.is_committed(spark, path, epoch, batch_id):
            return
        last, seen = (_newest_time(spark, path, (epoch, batch_id - k)) for k in (1, 2))
        attempt = uuid.uuid4().hex
        timed = parsed_times(batch)
        end = F.window("ts", HOUR)["end"]
        mark = F.lit(seen).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
        newest = timed.agg(F.max("ts").cast("string").alias("m")).first()["m"]
        if seen is not None:
            (timed.withColumn("end", end).where(F.col("end") <= mark).drop("end")
             .withColumn("epoch", F.lit(int(epoch))).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
             .withColumn("attempt", F.lit(attempt))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("epoch", "batch_id", "attempt").parquet(path))
        commits.mark_committed(spark, path, epoch, batch_id, attempt, newest=max(filter(None, (last, newest)), default=None))
    return write


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """``(topic, partition, offset, value, ts)`` of late records."""
    rows = read_parquet_or_empty(spark, LATE_SCHEMA, path)
    return commits.only_committed(spark, rows, path).select("topic", "partition", "offset", "value", "ts")
