"""Running streaming queries and naming their checkpoint lifetimes.

* :func:`run_available` - start with ``trigger(availableNow=True)`` (process
  everything present, in bounded micro-batches, then stop) and wait; a failed
  query re-raises.
* :func:`run_batches` - the same for a ``foreachBatch`` body.
* :func:`resolve_epoch` - the *epoch* of a checkpoint: a number that stays the
  same while a checkpoint is resumed and grows when a new checkpoint starts, so
  ledger rows are ordered by ``(epoch, batch_id)`` even though ``batch_id``
  restarts at 0 with every new checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.sources.files import read_parquet_or_empty

EPOCH_SCHEMA = "epoch INT"

BatchFn = Callable[[DataFrame, int], None]

ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def run_available(writer: DataStreamWriter, processing_time: str | None = None,
                  spark: SparkSession | None = None,
                  state_partitions: int | None = None,
                  state_store: str | None = None) -> StreamingQuery:
    """Run to completion on what is available now (or with a fixed interval
    trigger when ``processing_time`` is given, which never completes).

    ``state_partitions`` fixes the number of state-store partitions of a
    stateful query (stored in its checkpoint at the first batch, so it cannot
    change later).  AQE does not coalesce stateful stages, so the session's
    shuffle-partition count (often sized for batch joins) would otherwise run
    that many state tasks every micro-batch.  ``state_store="rocksdb"`` keeps
    state in RocksDB (off-heap, spills to local disk, changelog checkpoints to
    the checkpoint folder): the choice for large state such as per-day user
    sets.  Both settings are applied only while ``start()`` clones the session
    for the query.
    """
    writer = (writer.trigger(processingTime=processing_time) if processing_time
              else writer.trigger(availableNow=True))
    settings: dict[str, str] = {}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(int(state_partitions))
    if state_store == "rocksdb":
        settings.update(ROCKSDB_STATE)
    elif state_store is not None:
        raise ValueError(f"unknown state store {state_store!r}")
    if not settings:
        q = writer.start()
    else:
        if spark is None:
            raise ValueError("per-query state settings need the session")
        previous = {k: spark.conf.get(k, None) for k in settings}
        for k, v in settings.items():
            spark.conf.set(k, v)
        try:
            q = writer.start()
        finally:
            for k, v in previous.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)
    if not processing_time:
        q.awaitTermination()
    return q


def run_batches(records: DataFrame, write: BatchFn, checkpoint: str,
                processing_time: str | None = None) -> StreamingQuery:
    """Run ``write`` for each micro-batch of ``records`` on ``checkpoint``."""
    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_available(writer, processing_time)


def default_state_partitions(spark: SparkSession) -> int:
    """One state partition per core available to the application."""
    return int(spark.sparkContext.defaultParallelism)


def _epoch_marker(checkpoint: str) -> str:
    return checkpoint.rstrip("/") + "_epoch"


def read_epoch(spark: SparkSession, checkpoint: str) -> int | None:
    rows = read_parquet_or_empty(spark, EPOCH_SCHEMA, _epoch_marker(checkpoint)).collect()
    return rows[0]["epoch"] if rows else None


def record_epoch(spark: SparkSession, checkpoint: str, epoch: int) -> int:
    """Write a checkpoint's epoch next to it, so that restarts reuse it."""
    spark.createDataFrame([(int(epoch),)], EPOCH_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        _epoch_marker(checkpoint))
    return int(epoch)


def resolve_epoch(spark: SparkSession, checkpoint: str, newest_known: int | None) -> int:
    """Epoch of ``checkpoint``: its recorded one, or ``newest_known + 1`` for a
    new checkpoint."""
    e = read_epoch(spark, checkpoint)
    if e is not None:
        return e
    return record_epoch(spark, checkpoint, 0 if newest_known is None else newest_known + 1)
