"""Live jobs on a Kafka topic: where the stream starts, then ingest / counters.

A checkpoint carries its own positions and wins on restart.  Only when a job
starts on a *new* checkpoint does it need a starting point; then the saved
positions in the ledger are used:

* with ``bounds`` (``topic, partition, earliest, latest``, e.g. from an admin
  lookup): positions are repaired first - past the end or before retention
  restarts at the earliest offset (:func:`tidemark.plans.seed`);
* without bounds: the saved positions as they are, for a given number of
  partitions, new ones at the earliest offset;
* no saved positions: the reset policy (``earliest`` by default).

:func:`choose_checkpoint` decides when a new checkpoint is needed: positions
out of the topic's range (retention passed them, or the topic was recreated)
open the next generation.

The ``kafka`` source is not on this machine's classpath; :func:`source_options`
is tested as data and the jobs run in tests on the file stand-in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.offsets import starting_offsets_option, with_default
from tidemark.plans import ingest, positions, traffic
from tidemark.plans.seed import repaired_starting_offsets
from tidemark.sources import fs, kafka
from tidemark.streaming import ledger
from tidemark.streaming.runner import read_epoch, record_epoch

#: What a Kafka source takes for "the earliest offset" in startingOffsets.
EARLIEST = -2


def saved_positions(spark: SparkSession, ledger_path: str, topic: str,
                    snapshot_path: str | None = None) -> DataFrame | None:
    """Saved positions of a topic from snapshot and ledger; ``None`` when none
    are saved.  A read that fails stops the job: starting over is no answer."""
    pos = ledger.saved_positions(spark, ledger_path, snapshot_path).where(F.col("topic") == topic)
    return pos if pos.take(1) else None


def out_of_range(saved: DataFrame, bounds: DataFrame) -> DataFrame:
    """Saved positions a topic can no longer serve: past ``latest`` or before
    ``earliest`` (both tables hold one row per partition)."""
    b = bounds.select("topic", "partition", "earliest", "latest")
    return (saved.join(b, ["topic", "partition"])
            .where((F.col("offset") > F.col("latest")) | (F.col("offset") < F.col("earliest"))))


def choose_checkpoint(spark: SparkSession, checkpoint_root: str, ledger_path: str, topic: str,
                      bounds: DataFrame | None = None, snapshot_path: str | None = None,
                      newest: int | None = None) -> str:
    """Checkpoint of the current generation, ``<root>/epoch=<n>``, whose epoch
    is ``n``: folder and epoch are decided here, once.

    ``newest`` is the newest epoch in the job's outputs (by default the
    ledger's and its snapshot's).  Its checkpoint is resumed, or the one after
    it where that was opened already.  The next generation is opened when the
    newest epoch has no checkpoint, or when ``bounds`` show that a saved
    position is out of range (the checkpoint would go on from it);
    :func:`source_options` then seeds it from the saved positions with repair.
    """
    root = checkpoint_root.rstrip("/")
    if newest is None:
        newest = ledger.max_epoch(spark, ledger_path, snapshot_path)

    def at(n: int) -> str:
        return f"{root}/epoch={n}"

    def opened(n: int) -> bool:
        return read_epoch(spark, at(n)) is not None

    if newest is None:
        n = 0
    elif opened(newest + 1):
        return at(newest + 1)
    elif not opened(newest):
        n = newest + 1
    else:
        saved = None if bounds is None else saved_positions(spark, ledger_path, topic, snapshot_path)
        if saved is None or not out_of_range(saved, bounds).take(1):
            return at(newest)
        n = newest + 1
    return at(n)


def begun(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a stream has recorded offsets there; they win over any seed."""
    return bool(fs.folders(spark, f"{checkpoint.rstrip('/')}/offsets"))


def source_options(spark: SparkSession, bootstrap_servers: str, topic: str, ledger_path: str,
                   checkpoint: str, bounds: DataFrame | None = None,
                   reset_policy: str = "earliest", max_offsets_per_trigger: int | None = None,
                   strict: bool = False, snapshot_path: str | None = None,
                   partitions: int | None = None) -> dict[str, str]:
    """Kafka reader options for a job on ``checkpoint``.

    ``startingOffsets`` must list every partition, so saved positions seed a
    new checkpoint only with ``bounds`` or the topic's count of
    ``partitions``; those without a saved position start at the earliest.
    """
    starting = None
    if not begun(spark, checkpoint):
        saved = saved_positions(spark, ledger_path, topic, snapshot_path)
        if saved is not None and bounds is not None:
            starting = repaired_starting_offsets(bounds, saved, strict=strict)
        elif saved is not None and partitions is not None:
            known = spark.range(int(partitions)).select(F.lit(topic).alias("topic"), F.col("id").cast("int").alias("partition"))
            starting = starting_offsets_option(with_default(known, saved, EARLIEST), "offset")
        elif saved is not None:
            raise ValueError(f"{topic} has saved positions but no checkpoint: give its bounds or its number of partitions")
    return kafka.reader_options(bootstrap_servers, topic=topic, starting_offsets=starting,
                                reset_policy=reset_policy, max_offsets=max_offsets_per_trigger)


def _opened(spark: SparkSession, checkpoint: str, newest: int | None) -> None:
    """Record the epoch that the checkpoint's folder names, or the next one."""
    if read_epoch(spark, checkpoint) is None:
        name = checkpoint.rstrip("/").rpartition("/")[2]
        own = int(name[6:]) if name.startswith("epoch=") else (0 if newest is None else newest + 1)
        if newest is not None and own <= newest:
            raise ValueError(f"{checkpoint} would reuse an epoch: the outputs are at {newest}")
        record_epoch(spark, checkpoint, own)


def start_live_ingest(spark: SparkSession, bootstrap_servers: str, topic: str,
                      landing_path: str, ledger_path: str, checkpoint: str,
                      bounds: DataFrame | None = None, date_mode: str = "batch",
                      max_offsets_per_trigger: int | None = None,
                      processing_time: str | None = "5 seconds",
                      table: str | None = None, compacted_path: str | None = None,
                      snapshot_path: str | None = None, partitions: int | None = None) -> StreamingQuery:
    """Topic -> date-partitioned landing table, positions in the ledger; with
    ``table`` the landing output is a catalog view."""
    opts = source_options(spark, bootstrap_servers, topic, ledger_path, checkpoint, bounds,
                          max_offsets_per_trigger=max_offsets_per_trigger, snapshot_path=snapshot_path,
                          partitions=partitions)
    _opened(spark, checkpoint, ingest.newest_epoch(spark, landing_path, ledger_path, compacted_path, snapshot_path))
    return ingest.start_ingest_job(spark, kafka.read_stream(spark, opts), landing_path,
                                   ledger_path, checkpoint, date_mode=date_mode,
                                   processing_time=processing_time, table=table,
                                   compacted_path=compacted_path, snapshot_path=snapshot_path)


def start_live_counters(spark: SparkSession, bootstrap_servers: str, topic: str,
                        ledger_path: str, checkpoint: str, bounds: DataFrame | None = None,
                        rejects_path: str | None = None,
                        max_offsets_per_trigger: int | None = None,
                        processing_time: str | None = "10 seconds",
                        snapshot_path: str | None = None,
                        compact_every: int | None = None, partitions: int | None = None) -> StreamingQuery:
    """Topic -> page views, site page views, daily users and positions, one
    ledger write per micro-batch; optionally compacting the ledger every
    ``compact_every`` batches into ``snapshot_path``."""
    opts = source_options(spark, bootstrap_servers, topic, ledger_path, checkpoint, bounds,
                          max_offsets_per_trigger=max_offsets_per_trigger, snapshot_path=snapshot_path,
                          partitions=partitions)
    _opened(spark, checkpoint, ledger.max_epoch(spark, ledger_path, snapshot_path))
    return traffic.start_traffic_job(spark, kafka.read_stream(spark, opts), ledger_path,
                                     checkpoint, processing_time=processing_time,
                                     rejects_path=rejects_path, snapshot_path=snapshot_path,
                                     compact_every=compact_every)


def start_live_positions(spark: SparkSession, bootstrap_servers: str, topic: str,
                         ledger_path: str, checkpoint: str, bounds: DataFrame | None = None,
                         max_offsets_per_trigger: int | None = None,
                         processing_time: str | None = "5 seconds",
                         snapshot_path: str | None = None, partitions: int | None = None) -> StreamingQuery:
    """Topic -> what every micro-batch read, nothing else."""
    opts = source_options(spark, bootstrap_servers, topic, ledger_path, checkpoint, bounds,
                          max_offsets_per_trigger=max_offsets_per_trigger, snapshot_path=snapshot_path,
                          partitions=partitions)
    _opened(spark, checkpoint, ledger.max_epoch(spark, ledger_path, snapshot_path))
    return positions.start_positions_job(spark, kafka.read_stream(spark, opts), ledger_path, checkpoint,
                                         processing_time=processing_time, snapshot_path=snapshot_path)
