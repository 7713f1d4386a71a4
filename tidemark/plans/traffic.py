"""Traffic counters job: record stream -> page views per hour, per site and
hour, daily unique users, and source positions - all in one ledger write per
micro-batch, so a crash and restart neither loses nor double-counts a record.

The driver never sees rows: parsing and aggregation run on executors, and the
foreachBatch body issues one distributed write per batch.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.parse import parse_rejects
from tidemark.sources.files import read_parquet_or_empty
from tidemark.streaming import commits
from tidemark.streaming.ledger import batch_ledger_rows, compact_ledger, max_epoch, write_ledger
from tidemark.streaming.runner import BatchFn, resolve_epoch, run_batches

REJECTS_SCHEMA = ("topic STRING, partition INT, offset BIGINT, value STRING, "
                  "epoch INT, batch_id BIGINT")


def write_rejects(batch: DataFrame, path: str, epoch: int, batch_id: int) -> None:
    """Lines of the batch that do not parse, with their positions, replacing
    the ``(epoch, batch_id)`` partition (idempotent on replay)."""
    (parse_rejects(batch, keep=("topic", "partition", "offset"))
     .withColumn("epoch", F.lit(int(epoch)))
     .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("epoch", "batch_id").parquet(path))


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet_or_empty(spark, REJECTS_SCHEMA, path)


def traffic_batch_writer(ledger_path: str, epoch: int, rejects_path: str | None = None,
                         snapshot_path: str | None = None, compact_every: int | None = None) -> BatchFn:
    """``foreachBatch`` body: rejects, ledger rows, then the commit.  A batch
    that is committed is not written again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if commits.is_committed(spark, ledger_path, epoch, batch_id):
            return
        attempt = uuid.uuid4().hex
        if rejects_path is None:
            # One aggregation (grouping sets) reads the batch once: no cache needed.
            write_ledger(batch_ledger_rows(batch, epoch, batch_id), ledger_path, attempt)
        else:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                write_rejects(batch, rejects_path, epoch, batch_id)
                write_ledger(batch_ledger_rows(batch, epoch, batch_id), ledger_path, attempt)
            finally:
                batch.unpersist()
        commits.mark_committed(spark, ledger_path, epoch, batch_id, attempt, outputs=[ledger_path])
        if compact_every and snapshot_path is not None and (batch_id + 1) % int(compact_every) == 0:
            # Fold the ledger so readers (read_compacted) stay bounded.
            compact_ledger(spark, ledger_path, snapshot_path)
    return write


def traffic_job(spark: SparkSession, ledger_path: str, checkpoint: str, rejects_path: str | None = None,
                snapshot_path: str | None = None, compact_every: int | None = None) -> BatchFn:
    """The batch writer of ``checkpoint``: resuming keeps its epoch, a new
    checkpoint gets the next one of ledger and snapshot."""
    epoch = resolve_epoch(spark, checkpoint, max_epoch(spark, ledger_path, snapshot_path))
    return traffic_batch_writer(ledger_path, epoch, rejects_path, snapshot_path, compact_every)


def start_traffic_job(spark: SparkSession, records: DataFrame, ledger_path: str,
                      checkpoint: str, processing_time: str | None = None,
                      rejects_path: str | None = None, snapshot_path: str | None = None,
                      compact_every: int | None = None) -> StreamingQuery:
    """Run the counters job over a decoded record stream."""
    write = traffic_job(spark, ledger_path, checkpoint, rejects_path, snapshot_path, compact_every)
    return run_batches(records, write, checkpoint, processing_time)
