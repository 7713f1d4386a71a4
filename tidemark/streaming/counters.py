"""Running traffic counters as stateful streaming aggregations.

Same parse and metric code as the batch path; Spark keeps the running state
(per hour / per ``(day, user)``) in its state store, checkpointed with the
query, so totals survive restarts.

* page views per hour: streaming ``groupBy('hour').count()``.
* exact distinct users per day: streaming ``count_distinct`` is not supported,
  so members are deduplicated first (``dropDuplicates(['day','user_id'])``)
  and then counted.  Without a watermark every member is kept forever, like a
  per-day set that is never expired; with ``watermark`` the dedup state of a
  day is dropped once event time has moved past it by that delay (late lines
  beyond it are then no longer deduplicated).

At scale, start the query with ``run_available(..., state_store="rocksdb")``
so the member state lives off-heap in RocksDB and spills to local disk, with
changelog checkpointing to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.operators import metrics
from tidemark.operators.parse import parse_log
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import fs
from tidemark.sources.files import read_parquet_or_empty
from tidemark.streaming import commits


def running_pv_by_hour(lines: DataFrame, line_col: str = "value") -> DataFrame:
    return metrics.pv_by_hour(parse_log(lines, line_col))


def running_site_pv_by_hour(lines: DataFrame, line_col: str = "value") -> DataFrame:
    return metrics.site_pv_by_hour(parse_log(lines, line_col))


def running_uv_by_day(lines: DataFrame, line_col: str = "value",
                      watermark: str | None = None) -> DataFrame:
    members = metrics.with_day(parse_log(lines, line_col)).select("day", "user_id")
    if watermark is None:
        deduped = members.dropDuplicates(["day", "user_id"])
    else:
        timed = members.withColumn("day_start", F.to_timestamp("day", "yyyy-MM-dd"))
        deduped = (timed.withWatermark("day_start", watermark)
                   .dropDuplicates(["day", "user_id", "day_start"]))
    return deduped.groupBy("day").agg(F.count(F.lit(1)).alias("uv"))


def update_to_log(result: DataFrame, path: str, epoch: int = 0):
    """``foreachBatch`` body for update mode: each batch carries only the keys
    it changed, with their new running values; they are written to the
    ``(epoch, batch_id)`` partition (replaced on replay).  Read with
    :func:`latest_values`.  ``epoch`` is the checkpoint's
    (:func:`tidemark.streaming.runner.resolve_epoch` with :func:`log_epoch`):
    ``batch_id`` starts again with every new checkpoint.

    Unlike complete mode, the output per batch is bounded by the batch, not by
    the whole key space.
    """
    return result.writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: write_update_batch(batch, batch_id, path, epoch))


def write_update_batch(batch: DataFrame, batch_id: int, path: str, epoch: int = 0) -> None:
    """One update-mode batch into its partition (replaced on replay)."""
    (batch.withColumn("epoch", F.lit(int(epoch))).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("epoch", "batch_id").parquet(path))


def log_epoch(spark, path: str) -> int | None:
    """Newest epoch of an update log (folder names only)."""
    known = fs.partition_values(spark, f"{path.rstrip('/')}/epoch=*", "epoch")
    return max(known) if known else None


def read_update_log(spark, path: str, result_schema: StructType) -> DataFrame:
    """The update log with the result's columns plus ``epoch``, ``batch_id``."""
    schema = StructType([*result_schema.fields, StructField("epoch", IntegerType()), StructField("batch_id", LongType())])
    return read_parquet_or_empty(spark, schema, path)


def latest_values(log: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Latest value per key from an update log: ``max(struct(epoch, batch_id,
    ...))``, a single partial-aggregatable aggregate.  A new checkpoint counts
    anew, so a key's value is that of the newest epoch that has it."""
    last = F.max(F.struct("epoch", "batch_id", *values)).alias("last")
    return log.groupBy(*keys).agg(last).select(*keys, *[F.col(f"last.{v}").alias(v) for v in values])


def compact_update_log(spark, path: str, result_schema: StructType, keys: list[str], values: list[str]) -> int:
    """Fold the log of the newest epoch into the partition of its newest batch
    and remove the folders it covers; returns how many.  Run it while the job
    stands still: that batch may not be replayed at the same time."""
    log = read_update_log(spark, path, result_schema)
    top = log.agg(F.max(F.struct("epoch", "batch_id")).alias("m")).first()["m"]
    if top is None:
        return 0
    e, b = int(top["epoch"]), int(top["batch_id"])
    folded = written_once(latest_values(log, keys, values))
    write_update_batch(folded, b, path, e)
    covered = [f for f in fs.folders(spark, f"{path.rstrip('/')}/epoch=*/batch_id=*")
               if (int((at := fs.partition_of(f))["epoch"]), int(at["batch_id"])) < (e, b)]
    for folder in covered:
        fs.remove(spark, folder)
    return len(covered)


def written_once(df: DataFrame) -> DataFrame:
    """``df`` in the shared checkpoint folder, so that a table can be replaced
    by what was read from it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def complete_to_table(result: DataFrame, path: str):
    """``foreachBatch`` body for complete mode: each batch carries the full
    current result, written as a version of its own.  Readers
    (:func:`read_complete`) take the newest whole version, so that a crash in
    the middle leaves them the one before; older versions are removed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        root = path.rstrip("/")
        now = 1 + max((v for _, v in commits.listed(spark, root)), default=-1)
        batch.write.mode("overwrite").parquet(f"{root}/version={now}")
        commits.mark_committed(spark, root, 0, now)
        for old in range(max(0, now - 3), now - 1):
            fs.remove(spark, f"{root}/version={old}")
            fs.remove(spark, f"{commits.commits_path(root)}/epoch=0/batch_id={old}")
    return result.writeStream.outputMode("complete").foreachBatch(write)


def read_complete(spark, path: str, schema: StructType | str) -> DataFrame:
    """The newest whole version of a complete-mode output."""
    done = [v for _, v in commits.listed(spark, path)]
    if not done:
        return spark.createDataFrame([], schema)
    return read_parquet_or_empty(spark, schema, f"{path.rstrip('/')}/version={max(done)}")


def state_table(spark, checkpoint: str, operator: int = 0) -> DataFrame:
    """The running values of a stateful query, read from its checkpoint's
    state: key and value columns side by side, as of its last batch.  No
    output table is needed, and the query need not run."""
    rows = spark.read.format("statestore").option("operatorId", str(int(operator))).load(checkpoint)
    return rows.select("key.*", "value.*")
