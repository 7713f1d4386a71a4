"""Positions-only job: record what each micro-batch read, nothing else.

Every batch appends its per-partition ``[from, until)`` audit to the ledger
(``metric='offset'`` rows, overwrite by ``(epoch, batch_id)``); the saved
position is then :func:`tidemark.streaming.ledger.ledger_positions`.  The read
rate is limited at the source: ``maxOffsetsPerTrigger`` for Kafka (see
:func:`tidemark.sources.kafka.max_offsets_per_trigger` for the per-partition
form), ``maxFilesPerTrigger`` for the file stand-in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.offsets import offset_range_audit
from tidemark.streaming import commits
from tidemark.streaming.ledger import ledger_rows, max_epoch, write_ledger
from tidemark.streaming.runner import BatchFn, resolve_epoch, run_batches


def position_rows(batch: DataFrame, epoch: int, batch_id: int) -> DataFrame:
    ranges = offset_range_audit(batch)
    return (ledger_rows(ranges, "offset", topic=F.col("topic"), partition=F.col("partition"),
                        until_offset=F.col("until_offset"), from_offset=F.col("from_offset"),
                        delta=F.col("records"))
            .withColumn("epoch", F.lit(int(epoch)))
            .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")))


def positions_batch_writer(ledger_path: str, epoch: int) -> BatchFn:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if commits.is_committed(spark, ledger_path, epoch, batch_id):
            return
        attempt = uuid.uuid4().hex
        write_ledger(position_rows(batch, epoch, batch_id), ledger_path, attempt)
        commits.mark_committed(spark, ledger_path, epoch, batch_id, attempt, outputs=[ledger_path])
    return write


def positions_job(spark: SparkSession, ledger_path: str, checkpoint: str,
                  snapshot_path: str | None = None) -> BatchFn:
    """The batch writer of ``checkpoint``, on its epoch."""
    epoch = resolve_epoch(spark, checkpoint, max_epoch(spark, ledger_path, snapshot_path))
    return positions_batch_writer(ledger_path, epoch)


def start_positions_job(spark: SparkSession, records: DataFrame, ledger_path: str,
                        checkpoint: str, processing_time: str | None = None,
                        snapshot_path: str | None = None) -> StreamingQuery:
    write = positions_job(spark, ledger_path, checkpoint, snapshot_path)
    return run_batches(records.select("topic", "partition", "offset"), write, checkpoint, processing_time)
