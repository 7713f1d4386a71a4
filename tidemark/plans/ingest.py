"""Landing ingest job: record stream -> date-partitioned Parquet landing table,
positions in the ledger.

Each attempt at a micro-batch writes its records to the folders ``(pd, epoch,
batch_id, attempt)`` and its positions to the ledger; then ONE commit names the
attempt, for both.  A replay before the commit is another attempt, one after it
writes nothing, so the landing table holds every record exactly once and the
positions are those of what is landed; :func:`read_landing` exposes the whole
batches as ``(record, pd)``.

Partition date:
* ``date_mode="row"``: ``pd`` from each record's own timestamp (deterministic;
  a batch straddling midnight splits correctly).
* ``date_mode="batch"``: one processing date for the whole batch, taken from
  ``clock()`` on the driver.  The first attempt settles it in the commit log,
  where it stays until the batch is committed and covered, so a replay after
  midnight still lands in the original partition.

``write_positions=False`` gives the variant that keeps positions only in the
checkpoint (the source's own commit log).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.landing import quote_ident, quote_path, stamp_batch_date, stamp_row_date
from tidemark.plans.positions import position_rows
from tidemark.sources import fs
from tidemark.sources.files import read_parquet_or_empty
from tidemark.streaming import commits
from tidemark.streaming.ledger import (TRIES, fence, generations, max_epoch, new_part, newest_manifest, put_manifest,
                                       write_ledger)
from tidemark.streaming.runner import BatchFn, resolve_epoch, run_batches

LANDED_SCHEMA = "record STRING, pd STRING, epoch INT, batch_id BIGINT, attempt STRING"
LANDED_PARTITIONS = ("pd", "epoch", "batch_id", "attempt")


def utc_today() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d")


def write_landed(rows: DataFrame, path: str, epoch: int, batch_id: int, attempt: str = commits.ONLY) -> None:
    """Replace what the attempt has landed of the batch, by date."""
    (rows.withColumn("epoch", F.lit(int(epoch))).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
     .withColumn("attempt", F.lit(attempt))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*LANDED_PARTITIONS).parquet(path))


def ingest_batch_writer(landing_path: str, ledger_path: str, epoch: int,
                        date_mode: str = "row", clock=utc_today,
                        write_positions: bool = True) -> BatchFn:
    """``foreachBatch`` body: records, positions, then the commit of both.  A
    batch that is committed is not written again."""
    if date_mode not in ("row", "batch"):
        raise ValueError("date_mode must be 'row' or 'batch'")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if commits.is_committed(spark, landing_path, epoch, batch_id):
            return
        attempt, facts = uuid.uuid4().hex, {"outputs": [landing_path]}
        if date_mode == "batch":
            facts["date"] = commits.settled(spark, landing_path, epoch, batch_id, "date", clock)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            landed = stamp_batch_date(batch, facts["date"]) if date_mode == "batch" else stamp_row_date(batch)
            write_landed(landed, landing_path, epoch, batch_id, attempt)
            if write_positions:
                write_ledger(position_rows(batch, epoch, batch_id), ledger_path, attempt)
                facts["outputs"].append(ledger_path)
            commits.mark_committed(spark, landing_path, epoch, batch_id, attempt, **facts)
        finally:
            batch.unpersist()
    return write


def landed_max_epoch(spark: SparkSession, landing_path: str, compacted_path: str | None = None) -> int | None:
    """Newest epoch of the landed data, its markers or its compaction."""
    root = landing_path.rstrip("/")
    known = fs.partition_values(spark, f"{root}/pd=*/epoch=*", "epoch")
    known += fs.partition_values(spark, f"{commits.log_of(spark, root)}/epoch=*", "epoch")
    if compacted_path is not None and (newest := newest_manifest(spark, compacted_path)) is not None:
        known.append(newest[1][0])
    return max(known) if known else None


def newest_epoch(spark: SparkSession, landing_path: str, ledger_path: str,
                 compacted_path: str | None = None, snapshot_path: str | None = None) -> int | None:
    """Newest epoch in any output of the job: a new checkpoint must not reuse
    it, or its batches would replace those of an older run."""
    known = [e for e in (max_epoch(spark, ledger_path, snapshot_path),
                         landed_max_epoch(spark, landing_path, compacted_path)) if e is not None]
    return max(known) if known else None


def ingest_job(spark: SparkSession, landing_path: str, ledger_path: str, checkpoint: str,
               date_mode: str = "row", clock=utc_today, write_positions: bool = True,
               compacted_path: str | None = None, snapshot_path: str | None = None) -> BatchFn:
    """The batch writer of ``checkpoint``, on its epoch."""
    if write_positions:
        commits.share(spark, landing_path, ledger_path)
    newest = newest_epoch(spark, landing_path, ledger_path, compacted_path, snapshot_path)
    epoch = resolve_epoch(spark, checkpoint, newest)
    return ingest_batch_writer(landing_path, ledger_path, epoch, date_mode, clock, write_positions)


def start_ingest_job(spark: SparkSession, records: DataFrame, landing_path: str,
                     ledger_path: str, checkpoint: str, date_mode: str = "row",
                     clock=utc_today, write_positions: bool = True,
                     processing_time: str | None = None, table: str | None = None,
                     compacted_path: str | None = None, snapshot_path: str | None = None) -> StreamingQuery:
    """Run the landing ingest.  With ``table``, the landing output is
    registered in the catalog (:func:`register_landing`)."""
    if table is not None:
        register_landing(spark, table, landing_path, compacted_path)
    write = ingest_job(spark, landing_path, ledger_path, checkpoint, date_mode, clock, write_positions,
                       compacted_path, snapshot_path)
    return run_batches(records, write, checkpoint, processing_time)


def _path_table(spark: SparkSession, name: str, columns: str, path: str, source: str) -> str:
    """A table over a folder whose partitions are found when it is read, so
    that no batch needs a statement of its own."""
    t = quote_ident(name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {t} ({columns}) USING {source} OPTIONS (path {quote_path(path)})")
    spark.catalog.refreshTable(name)
    return t


def register_landing(spark: SparkSession, table: str, landing_path: str, compacted_path: str | None = None) -> str:
    """Expose the landing output in the catalog for SQL users as the view
    ``table`` ``(record, pd)``: the compacted parts and the whole batches after
    them.  Call it again after a compaction (the view holds its watermark);
    retention stays one compaction behind.  Returns the view's name.

    Underneath are path tables ``<table>_batches`` and ``<table>_commits`` (and
    ``<table>_compacted``, ``<table>_manifests``): partitions are found when
    they are read.
    """
    folders = [("batches", LANDED_SCHEMA, landing_path, "parquet"),
               ("commits", commits.SCHEMA, commits.log_of(spark, landing_path), "json")]
    newest = None if compacted_path is None else newest_manifest(spark, compacted_path)
    if newest is not None:
        root = compacted_path.rstrip("/")
        folders += [("compacted", COMPACTED_SCHEMA, f"{root}/rows", "parquet"),
                    ("manifests", "parts ARRAY<STRING>, generation BIGINT", f"{root}/manifest", "json")]
    batches, done, *rest = [_path_table(spark, f"{table}_{n}", columns, path, source) for n, columns, path, source in folders]
    later, compacted = "true", ""
    if newest is not None:
        generation, (e, b), _ = newest
        later = f"(epoch > {e} OR (epoch = {e} AND batch_id > {b}))"
        compacted = (f"SELECT record, pd FROM {rest[0]} LEFT SEMI JOIN "
                     f"(SELECT explode(parts) AS part FROM {rest[1]} WHERE generation = {generation}) USING (part) UNION ALL ")
    spark.sql(f"CREATE OR REPLACE VIEW {quote_ident(table)} AS {compacted}"
              f"SELECT record, pd FROM {batches} LEFT SEMI JOIN (SELECT * FROM {done} WHERE {later}) USING (epoch, batch_id, attempt) WHERE {later}")
    return table


def read_landing(spark: SparkSession, landing_path: str) -> DataFrame:
    """The whole batches of the landing table as ``(record, pd)``; a ``pd``
    predicate prunes directories."""
    landed = read_parquet_or_empty(spark, LANDED_SCHEMA, landing_path)
    return commits.only_committed(spark, landed, landing_path).select("record", "pd")


# ------------------------------------------------------------ landing compaction
#
# Micro-batches leave many small files: one (pd, epoch, batch_id, attempt) folder
# per batch.  Compaction copies the whole batches since the previous watermark
# into a new part, rebalanced by pd into right-sized files; it never rewrites
# earlier parts (each compaction costs what was landed since the last one).
# Manifests are those of the ledger's snapshots: created if there is none of
# that generation, naming all parts, kept for readers one compaction behind.
#
# Layout: <compacted>/rows/part=<p>/pd=<d> and <compacted>/manifest/generation=<g>.

COMPACTED_SCHEMA = "record STRING, part STRING, pd STRING"


def compact_landing(spark: SparkSession, landing_path: str, compacted_path: str) -> tuple[int, int] | None:
    """Copy the whole batches landed since the last compaction into a new
    part; returns the watermark ``(epoch, batch_id)`` (``None`` when nothing
    landed).  Batches that are not committed stay for a later one.  Of two at
    a time one wins and the other starts again."""
    for _ in range(TRIES):
        newest = newest_manifest(spark, compacted_path)
        generation, mark, parts = newest if newest is not None else (-1, None, [])
        top = commits.newest_after(spark, landing_path, mark)
        if top is None:
            return mark
        landed = read_parquet_or_empty(spark, LANDED_SCHEMA, landing_path)
        fresh = commits.only_committed(spark, landed, landing_path, mark).where(~commits.after(top))
        if generations(spark, compacted_path)[-1:] != ([] if newest is None else [generation]):
            continue   # the landed batches were listed after another compaction
        part = new_part(generation + 1)
        # a folder of its own: two jobs that write into one folder would lose files
        (fresh.select("record", "pd").hint("rebalance", "pd")
         .write.partitionBy("pd").parquet(f"{compacted_path.rstrip('/')}/rows/part={part}"))
        if put_manifest(spark, compacted_path, generation + 1, top, [*parts, part]):
            return top
    raise RuntimeError(f"{compacted_path} was compacted by others {TRIES} times in a row")


def retain_landing(spark: SparkSession, landing_path: str, compacted_path: str) -> int:
    """Remove the landed batches that the compaction before the newest covers,
    and parts of compactions that came second; returns how many folders."""
    gone = commits.remove_covered(spark, landing_path, "pd=*", fence(spark, compacted_path))
    newest = newest_manifest(spark, compacted_path)
    for folder in [] if newest is None else fs.folders(spark, f"{compacted_path.rstrip('/')}/rows/part=*"):
        part = fs.partition_of(folder)["part"]
        if int(part.split("-")[0]) <= newest[0] and part not in newest[2]:
            fs.remove(spark, folder)
            gone += 1
    return gone


def read_landing_compacted(spark: SparkSession, landing_path: str, compacted_path: str) -> DataFrame:
    """``(record, pd)``: every compacted part plus the whole batches landed
    after the newest watermark."""
    root = f"{compacted_path.rstrip('/')}/rows"
    for _ in range(TRIES):
        newest = newest_manifest(spark, compacted_path)
        landed = read_parquet_or_empty(spark, LANDED_SCHEMA, landing_path)
        whole = commits.only_committed(spark, landed, landing_path, newest and newest[1]).select("record", "pd")
        if generations(spark, compacted_path)[-1:] != ([] if newest is None else [newest[0]]):
            continue   # listed after another compaction and what it removed
        if newest is None:
            return whole
        parts = [f"{root}/part={p}" for p in newest[2]]
        return spark.read.schema(COMPACTED_SCHEMA).option("basePath", root).parquet(*parts).select("record", "pd").unionByName(whole)
    raise RuntimeError(f"{compacted_path} was compacted {TRIES} times while it was read")
