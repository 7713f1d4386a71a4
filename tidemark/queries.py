"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir)
-> DataFrame``, plus the equivalent DuckDB SQL over the same parquet tables.

Every query reads the given tables (``events``) or data Spark derives from
them, whole: no id subsets, prefixes or row caps.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.encode import action_of, record_key, user_log_value
from tidemark.functions.logparse import parse_ok
from tidemark.operators import landing, metrics, offsets, parse
from tidemark.operators.joins import checkpointed
from tidemark.plans import ingest, positions, traffic
from tidemark.session import scratch_path
from tidemark.sources import derive, files, fs, scenarios, tables
from tidemark.streaming import counters, ledger
from tidemark.streaming.runner import default_state_partitions, resolve_epoch, run_available, run_batches

QueryFn = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------------------
# Inputs shared by several queries
# --------------------------------------------------------------------------

def _access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.access_log(tables.load(spark, sf_dir, "events",
                                         ["event_id", "ts", "user_id", "event_type"]))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_log(_access_log(spark, sf_dir))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.topic_records(tables.load(spark, sf_dir, "events",
                                            ["event_id", "ts", "user_id", "event_type"]))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-(partition, band) audit of the topic: one pass over the records,
    materialised because every offset scenario reads it several times."""
    return checkpointed(scenarios.band_audit(_records(spark, sf_dir)))


def _landing_job_positions(audit: DataFrame) -> DataFrame:
    saved = offsets.saved_offsets(scenarios.offset_ledger(audit))
    return saved.where(F.col("job") == "landing").drop("job")


def _corrected(audit: DataFrame) -> DataFrame:
    return offsets.correct_offsets(scenarios.retained_bounds(audit),
                                   _landing_job_positions(audit))


def _planned(audit: DataFrame) -> DataFrame:
    return offsets.plan_offset_ranges(
        _corrected(audit), scenarios.retained_bounds(audit),
        max_rate_per_partition=scenarios.RESTART_RATE_PER_PARTITION,
        batch_seconds=scenarios.RESTART_BATCH_SECONDS)


# --------------------------------------------------------------------------
# Parsing and traffic metrics
# --------------------------------------------------------------------------

def q_parse_log(spark, sf_dir):
    return parse.parse_log(_access_log(spark, sf_dir), keep=("event_id",))


def q_parse_rejects(spark, sf_dir):
    return parse.parse_rejects(_access_log(spark, sf_dir), keep=("event_id",))


def q_pv_by_hour(spark, sf_dir):
    return metrics.pv_by_hour(_parsed(spark, sf_dir))


def q_site_pv_by_hour(spark, sf_dir):
    return metrics.site_pv_by_hour(_parsed(spark, sf_dir))


def q_uv_by_day(spark, sf_dir):
    return metrics.uv_by_day(_parsed(spark, sf_dir))


def q_uv_members_by_day(spark, sf_dir):
    return metrics.uv_members_by_day(_parsed(spark, sf_dir))


def q_batch_total(spark, sf_dir):
    return metrics.batch_total(_parsed(spark, sf_dir))


# --------------------------------------------------------------------------
# Offsets: bounds, ledger, repair, planning, positioned reads
# --------------------------------------------------------------------------

def q_offset_bounds(spark, sf_dir):
    return offsets.offset_bounds(_records(spark, sf_dir))


def q_offset_range_audit(spark, sf_dir):
    return _audit(spark, sf_dir).withColumnRenamed("band", "batch_id")


def q_saved_offsets(spark, sf_dir):
    return offsets.saved_offsets(scenarios.offset_ledger(_audit(spark, sf_dir)))


def q_saved_offsets_default(spark, sf_dir):
    """Positions kept as text, typed strictly, with 0 where none is saved: the
    store has an entry without a value for every partition nothing was saved
    for."""
    audit = _audit(spark, sf_dir)
    known = scenarios.retained_bounds(audit)
    stored = (known.select("topic", "partition").join(_landing_job_positions(audit), ["topic", "partition"], "left")
              .select("topic", F.col("partition").cast("string").alias("partition"), F.col("offset").cast("string").alias("offset")))
    return offsets.with_default(known, offsets.typed_offsets(stored), default=0)


def q_correct_offsets(spark, sf_dir):
    return _corrected(_audit(spark, sf_dir))


def q_plan_offset_ranges(spark, sf_dir):
    return _planned(_audit(spark, sf_dir))


def q_positioned_read(spark, sf_dir):
    """Planned ranges read from the landed topic, whose files are sorted by
    offset: the scan skips what lies outside all ranges."""
    topic = files.read_records(spark, _landed_topic(spark, sf_dir))
    return offsets.positioned_read(topic.drop("ts"), _planned(_audit(spark, sf_dir)))


def q_starting_offsets_json(spark, sf_dir):
    return offsets.starting_offsets_json(_corrected(_audit(spark, sf_dir)))


# --------------------------------------------------------------------------
# Landing tables and record encoding
# --------------------------------------------------------------------------

# Injected clock of the batch-date queries: batch b is processed on day
# BATCH_CLOCK_START + b.
BATCH_CLOCK_START = "2024-02-01"


def _batch_day(b: int) -> str:
    import datetime as dt
    return (dt.date.fromisoformat(BATCH_CLOCK_START) + dt.timedelta(days=int(b))).isoformat()


def q_land_batch_date(spark, sf_dir):
    """Each offset band is one batch, inserted into its static date partition."""
    db = landing.create_database(spark)
    table = landing.create_landing_table(spark, f"{db}.landing")
    banded = derive.offset_bands(_records(spark, sf_dir))
    staged = scratch_path(spark, "bands")
    banded.select("value", "band").write.partitionBy("band").parquet(staged)
    staged_df = spark.read.schema("value STRING, band BIGINT").parquet(staged)
    for b in range(derive.DEFAULT_BANDS):
        landing.insert_batch_partition(staged_df.where(F.col("band") == b), table, _batch_day(b))
    return landing.landing_scan(spark, table)


def q_land_row_date(spark, sf_dir):
    db = landing.create_database(spark)
    table = f"{db}.landing_by_row_date"
    landing.append_by_row_date(_access_log(spark, sf_dir), table)
    return landing.landing_scan(spark, table)


def q_landing_partition_counts(spark, sf_dir):
    db = landing.create_database(spark)
    table = f"{db}.landing_by_row_date"
    landing.append_by_row_date(_access_log(spark, sf_dir), table)
    return (landing.landing_scan(spark, table).groupBy("pd")
            .agg(F.count(F.lit(1)).alias("records")))


def q_insert_by_columns(spark, sf_dir):
    """``INSERT INTO t1 (pt_date, record) SELECT ...``: column list in a
    different order than the table's."""
    db = landing.create_database(spark)
    table = f"{db}.t1"
    spark.sql(f"CREATE TABLE {landing.quote_ident(table)} (record STRING, pt_date STRING) "
              "USING parquet PARTITIONED BY (pt_date)")
    src = landing.stamp_row_date(_access_log(spark, sf_dir)).select(
        F.col("pd").alias("pt_date"), "record")
    landing.insert_by_columns(spark, table, ["pt_date", "record"], src)
    return spark.table(table)


def q_insert_values(spark, sf_dir):
    """``INSERT INTO t1 (record, pt_date) VALUES (...)`` with bound parameters:
    two summary rows of the whole log (lines, and lines that parse), computed
    by Spark."""
    db = landing.create_database(spark)
    table = f"{db}.t1"
    spark.sql(f"CREATE TABLE {landing.quote_ident(table)} (record STRING, pt_date STRING) "
              "USING parquet PARTITIONED BY (pt_date)")
    fields = parse.with_log_fields(landing.stamp_row_date(_access_log(spark, sf_dir)), "record")
    total = fields.agg(F.count(F.lit(1)).alias("lines"), F.count(F.when(parse_ok(), 1)).alias("events"),
                       F.min("pd").alias("first"), F.max("pd").alias("last")).first()
    landing.insert_values(spark, table, ["record", "pt_date"],
                          [(f"lines={total['lines']}", total["first"]), (f"events={total['events']}", total["last"])])
    return spark.table(table)


def q_landing_scan(spark, sf_dir):
    """The SQL route: batch as a temp view, ``USE db``, static-partition
    ``INSERT ... SELECT record FROM view``, then ``SELECT * FROM t``."""
    db = landing.create_database(spark)
    landing.create_landing_table(spark, f"{db}.landing")
    landing.payload(_access_log(spark, sf_dir)).createOrReplaceTempView("t2")
    previous = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(db)
    try:
        spark.sql("INSERT INTO landing PARTITION (pd = :d) SELECT record FROM t2",
                  args={"d": BATCH_CLOCK_START})
        return spark.sql("SELECT * FROM landing").select("record", "pd")
    finally:
        spark.catalog.setCurrentDatabase(previous)
        spark.catalog.dropTempView("t2")


def q_encode_user_log(spark, sf_dir):
    ev = tables.load(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    return ev.select(
        record_key("event_id").alias("key"),
        user_log_value("ts", "user_id", F.get_json_object("props", "$.k"), "event_type",
                       action_of("event_type")).alias("value"))


# --------------------------------------------------------------------------
# Streaming: running counters, replay-safe ledger, landing ingest
# --------------------------------------------------------------------------

_LANDED_TOPICS: dict[tuple[str, str], str] = {}
_FILES_PER_BAND: dict[str, int] = {}


def _landed_topic(spark, sf_dir) -> str:
    """The derived topic as files in offset order, written once.

    The topic is input, like a topic that already exists on a broker: it is
    landed once per application and folder and then consumed whole by every
    streaming query (files are never modified after landing).
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in _LANDED_TOPICS and not fs.folders(spark, f"{_LANDED_TOPICS[key]}/slice=*"):
        del _LANDED_TOPICS[key]   # cleaned up: land it again
    if key not in _LANDED_TOPICS:
        path = scratch_path(spark, "topic")
        _FILES_PER_BAND[path] = files.land_records(_records(spark, sf_dir), path)
        _LANDED_TOPICS[key] = path
    return _LANDED_TOPICS[key]


def land_topic(spark, sf_dir) -> None:
    """Land the topic ahead of the streaming queries (so that a timing of the
    first of them doesn't include it)."""
    _landed_topic(spark, sf_dir)


def _topic_stream(spark, path):
    """The landed topic as a stream, one micro-batch for each offset band."""
    return files.record_stream(spark, path, max_files_per_trigger=_FILES_PER_BAND[path])


def _run_complete(spark, result, name, state_store=None):
    out = scratch_path(spark, name)
    writer = counters.complete_to_table(result, out).option(
        "checkpointLocation", scratch_path(spark, name + "_checkpoint"))
    run_available(writer, spark=spark, state_partitions=default_state_partitions(spark),
                  state_store=state_store)
    return counters.read_complete(spark, out, result.schema)


def q_stream_pv_by_hour(spark, sf_dir):
    stream = _topic_stream(spark, _landed_topic(spark, sf_dir))
    return _run_complete(spark, counters.running_pv_by_hour(stream), "pv")


def q_stream_site_pv_by_hour(spark, sf_dir):
    stream = _topic_stream(spark, _landed_topic(spark, sf_dir))
    return _run_complete(spark, counters.running_site_pv_by_hour(stream), "site_pv")


def q_stream_site_pv_updates(spark, sf_dir):
    """Running site page views in update mode: per batch only the changed
    keys are written; the latest value per key is resolved on read."""
    stream = _topic_stream(spark, _landed_topic(spark, sf_dir))
    result = counters.running_site_pv_by_hour(stream)
    out = scratch_path(spark, "site_pv_updates")
    writer = counters.update_to_log(result, out).option(
        "checkpointLocation", scratch_path(spark, "site_pv_updates_checkpoint"))
    run_available(writer, spark=spark, state_partitions=default_state_partitions(spark))
    log = counters.read_update_log(spark, out, result.schema)
    return counters.latest_values(log, ["site_id", "hour"], ["pv"])


def q_stream_site_pv_updates_restart(spark, sf_dir):
    """Two checkpoints on one update log, the second on the whole topic again:
    its values win although its batches are numbered from 0."""
    out = scratch_path(spark, "site_pv_updates")
    for cp in ("first", "second"):
        result = counters.running_site_pv_by_hour(_topic_stream(spark, _landed_topic(spark, sf_dir)))
        checkpoint = scratch_path(spark, cp + "_checkpoint")
        epoch = resolve_epoch(spark, checkpoint, counters.log_epoch(spark, out))
        writer = counters.update_to_log(result, out, epoch).option("checkpointLocation", checkpoint)
        run_available(writer, spark=spark, state_partitions=default_state_partitions(spark))
    return counters.latest_values(counters.read_update_log(spark, out, result.schema), ["site_id", "hour"], ["pv"])


def q_stream_uv_by_day(spark, sf_dir):
    stream = _topic_stream(spark, _landed_topic(spark, sf_dir))
    # The per-day member state grows with the data: keep it in RocksDB.
    return _run_complete(spark, counters.running_uv_by_day(stream), "uv", state_store="rocksdb")


CRASH_BATCH = 2


def _traffic_crash(spark, sf_dir, resume=True, **options):
    """Counters job that dies in batch 2, between its data and its marker, and
    (with ``resume``) goes on; returns ledger, checkpoint and the writer."""
    topic = _landed_topic(spark, sf_dir)
    path, cp = scratch_path(spark, "ledger"), scratch_path(spark, "traffic_checkpoint")

    def write():
        return traffic.traffic_job(spark, path, cp, **options)

    def stream():
        return _topic_stream(spark, topic)
    scenarios.run_with_crash(stream, write, cp, CRASH_BATCH, path, resume=resume)
    return path, lambda: run_batches(stream(), write(), cp)


def _traffic_ledger(spark, sf_dir):
    path, _ = _traffic_crash(spark, sf_dir)
    return ledger.read_ledger(spark, path)


def _traffic_compacted(spark, sf_dir):
    """The counters job's ledger compacted after the crash (its unfinished
    batch stays out), again at the end, and what is covered removed."""
    path, go_on = _traffic_crash(spark, sf_dir, resume=False)
    snap = scratch_path(spark, "snapshot")
    ledger.compact_ledger(spark, path, snap)
    ledger.retain_ledger(spark, path, snap)
    go_on()
    ledger.compact_ledger(spark, path, snap)
    ledger.retain_ledger(spark, path, snap)
    return ledger.read_compacted(spark, path, snap)


def q_stream_parse_rejects(spark, sf_dir):
    """Counters job with a rejects output, a crash in a batch and a restart:
    every unparseable line is kept exactly once with its position."""
    rej = scratch_path(spark, "rejects")
    _traffic_crash(spark, sf_dir, rejects_path=rej)
    return traffic.read_rejects(spark, rej).select("topic", "partition", "offset", "value")


def q_ledger_pv(spark, sf_dir):
    return ledger.ledger_pv(_traffic_ledger(spark, sf_dir))


def q_ledger_site_pv(spark, sf_dir):
    return ledger.ledger_site_pv(_traffic_ledger(spark, sf_dir))


def q_ledger_uv(spark, sf_dir):
    return ledger.ledger_uv(_traffic_ledger(spark, sf_dir))


def q_ledger_uv_members(spark, sf_dir):
    """Union-distinct of the member sets every batch stored."""
    return ledger.ledger_uv_members(_traffic_ledger(spark, sf_dir))


def q_ledger_pv_compacted(spark, sf_dir):
    """Page views through a snapshot taken after a crash and extended at the
    end, with what it covers removed from the ledger: batch 2 counts once."""
    return ledger.ledger_pv(_traffic_compacted(spark, sf_dir))


def q_resume_after_retention(spark, sf_dir):
    """A run, a compaction, retention of all that is covered, and a new
    checkpoint on the whole topic again: its batches come after the snapshot's,
    so page views are twice those of one pass."""
    topic = _landed_topic(spark, sf_dir)
    path, snap = scratch_path(spark, "ledger"), scratch_path(spark, "snapshot")
    for cp in ("first", "second"):
        traffic.start_traffic_job(spark, _topic_stream(spark, topic), path, scratch_path(spark, cp + "_checkpoint"),
                                  snapshot_path=snap)
        if cp == "first":
            ledger.compact_ledger(spark, path, snap)
            ledger.retain_ledger(spark, path, snap)
    return ledger.ledger_pv(ledger.read_compacted(spark, path, snap))


def _ingest_crash(spark, sf_dir, resume=True, **options):
    """Landing ingest that dies in batch 2, between its data and its markers,
    and (with ``resume``) goes on; returns the landing path and the rest."""
    topic = _landed_topic(spark, sf_dir)
    land, path = scratch_path(spark, "landing"), scratch_path(spark, "ledger")
    cp = scratch_path(spark, "ingest_checkpoint")

    def write():
        return ingest.ingest_job(spark, land, path, cp, **options)

    def stream():
        return _topic_stream(spark, topic)
    scenarios.run_with_crash(stream, write, cp, CRASH_BATCH, land, path, resume=resume)
    return land, lambda: run_batches(stream(), write(), cp)


def q_resume_exactly_once(spark, sf_dir):
    """Landing ingest with a crash in a batch and a restart: every record
    lands exactly once."""
    land, _ = _ingest_crash(spark, sf_dir, date_mode="row")
    return ingest.read_landing(spark, land)


def q_ingest_batch_date(spark, sf_dir):
    """Landing ingest with one date a batch, from a clock that moves on a day
    each time it is asked: the batch that is replayed after "midnight" keeps
    the date it recorded first, so batch b has day b."""
    days = itertools.count()
    land, _ = _ingest_crash(spark, sf_dir, date_mode="batch", clock=lambda: _batch_day(next(days)))
    return ingest.read_landing(spark, land)


def _contiguous(audit):
    """Per partition: what was read, and the batches that did not start where
    the one before them ended."""
    before = F.lag("until_offset").over(Window.partitionBy("topic", "partition").orderBy("epoch", "batch_id"))
    return (audit.withColumn("before", before).groupBy("topic", "partition").agg(
        F.min("from_offset").alias("from_offset"),
        F.max("until_offset").alias("until_offset"),
        F.sum("records").alias("records"),
        F.count(F.when(F.col("before") != F.col("from_offset"), 1)).alias("gaps")))


def q_stream_offset_audit(spark, sf_dir):
    """Per-batch read audit of the counters job across a crash and replay,
    rolled up per partition: every offset of every partition read exactly once
    (record counts add up, ranges span the partition, none overlaps another or
    leaves a gap)."""
    return _contiguous(ledger.ledger_offset_audit(_traffic_ledger(spark, sf_dir)))


def q_stream_offset_audit_compacted(spark, sf_dir):
    """The same through snapshots and retention: the audit stays complete."""
    return _contiguous(ledger.ledger_offset_audit(_traffic_compacted(spark, sf_dir)))


def _summed(totals):
    return totals.agg(F.sum("records").alias("records"), F.sum("events").alias("events"),
                      F.count(F.lit(1)).alias("batches"))


def q_stream_batch_total(spark, sf_dir):
    """Per-batch totals of the counters job (lines read, lines parsed) across a
    crash and replay, summed over all batches."""
    return _summed(ledger.ledger_batch_totals(_traffic_ledger(spark, sf_dir)))


def q_stream_batch_total_compacted(spark, sf_dir):
    """The same through snapshots and retention: each batch keeps its totals."""
    return _summed(ledger.ledger_batch_totals(_traffic_compacted(spark, sf_dir)))


def q_landing_compacted(spark, sf_dir):
    """Landing ingest with a crash in batch 2, a compaction of the whole
    batches, a resume, a second compaction and retention; read through the
    compacted generations: every record exactly once."""
    land, go_on = _ingest_crash(spark, sf_dir, resume=False, date_mode="row")
    comp = scratch_path(spark, "landing_compacted")
    ingest.compact_landing(spark, land, comp)
    go_on()
    ingest.compact_landing(spark, land, comp)
    ingest.retain_landing(spark, land, comp)
    return ingest.read_landing_compacted(spark, land, comp)


def q_stream_saved_offsets(spark, sf_dir):
    """Positions-only job, crash in a batch, restart: the saved position of
    every partition is its end."""
    topic = _landed_topic(spark, sf_dir)
    path, cp = scratch_path(spark, "ledger"), scratch_path(spark, "positions_checkpoint")
    scenarios.run_with_crash(lambda: _topic_stream(spark, topic).select("topic", "partition", "offset"),
                             lambda: positions.positions_job(spark, path, cp), cp, CRASH_BATCH, path)
    return ledger.saved_positions(spark, path)


QUERIES: dict[str, QueryFn] = {
    "parse_log": q_parse_log,
    "parse_rejects": q_parse_rejects,
    "pv_by_hour": q_pv_by_hour,
    "site_pv_by_hour": q_site_pv_by_hour,
    "uv_by_day": q_uv_by_day,
    "uv_members_by_day": q_uv_members_by_day,
    "batch_total": q_batch_total,
    "offset_bounds": q_offset_bounds,
    "offset_range_audit": q_offset_range_audit,
    "saved_offsets": q_saved_offsets,
    "saved_offsets_default": q_saved_offsets_default,
    "correct_offsets": q_correct_offsets,
    "plan_offset_ranges": q_plan_offset_ranges,
    "positioned_read": q_positioned_read,
    "starting_offsets_json": q_starting_offsets_json,
    "land_batch_date": q_land_batch_date,
    "land_row_date": q_land_row_date,
    "landing_partition_counts": q_landing_partition_counts,
    "insert_by_columns": q_insert_by_columns,
    "insert_values": q_insert_values,
    "landing_scan": q_landing_scan,
    "encode_user_log": q_encode_user_log,
    "stream_pv_by_hour": q_stream_pv_by_hour,
    "stream_site_pv_by_hour": q_stream_site_pv_by_hour,
    "stream_site_pv_updates": q_stream_site_pv_updates,
    "stream_site_pv_updates_restart": q_stream_site_pv_updates_restart,
    "stream_uv_by_day": q_stream_uv_by_day,
    "stream_parse_rejects": q_stream_parse_rejects,
    "ledger_pv": q_ledger_pv,
    "ledger_site_pv": q_ledger_site_pv,
    "ledger_uv": q_ledger_uv,
    "ledger_uv_members": q_ledger_uv_members,
    "ledger_pv_compacted": q_ledger_pv_compacted,
    "resume_exactly_once": q_resume_exactly_once,
    "landing_compacted": q_landing_compacted,
    "stream_saved_offsets": q_stream_saved_offsets,
    "stream_offset_audit": q_stream_offset_audit,
    "stream_batch_total": q_stream_batch_total,
    "stream_offset_audit_compacted": q_stream_offset_audit_compacted,
    "stream_batch_total_compacted": q_stream_batch_total_compacted,
    "resume_after_retention": q_resume_after_retention,
    "ingest_batch_date": q_ingest_batch_date,
}


# --------------------------------------------------------------------------
# DuckDB oracles
# --------------------------------------------------------------------------

_TS_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"

_ACCESS_LOG = f"""
access_log AS (
  SELECT event_id, ts, user_id,
    CASE WHEN event_id % 97 = 0 THEN 'bad'
         WHEN event_id % 89 = 0 THEN {_TS_TEXT} || '|~|' || event_type
         ELSE {_TS_TEXT} || '|~|' || event_type || '|~|/p?uid=' || CAST(user_id AS VARCHAR)
              || '&sid=' || event_type
    END AS value
  FROM events)"""

_PARSED_ALL = """
split_lines AS (
  SELECT *, string_split_regex(value, '\\|~\\|') AS f FROM access_log),
parsed_all AS (
  SELECT event_id, ts, value,
    CASE WHEN length(f[1]) >= 13 THEN replace(substr(f[1], 1, 13), 'T', '-') END AS hour,
    string_split_regex(f[3], '[=|&]')[2] AS user_id,
    string_split_regex(f[3], '[=|&]')[4] AS site_id
  FROM split_lines),
parsed AS (
  SELECT event_id, hour, user_id, site_id, substr(hour, 1, 10) AS day FROM parsed_all
  WHERE hour IS NOT NULL AND user_id IS NOT NULL AND site_id IS NOT NULL)"""

_WITH_PARSED = f"WITH {_ACCESS_LOG},{_PARSED_ALL}\n"

_RECORDS = """
records AS (
  SELECT 'events' AS topic, CAST(((coalesce(user_id, 0) % 8) + 8) % 8 AS INTEGER) AS partition,
         CAST(row_number() OVER (PARTITION BY ((coalesce(user_id, 0) % 8) + 8) % 8
                                 ORDER BY event_id NULLS FIRST) - 1 AS BIGINT) AS "offset",
         'key-' || CAST(event_id AS VARCHAR) AS key, value, ts
  FROM access_log),
sizes AS (SELECT topic, partition, count(*) AS n FROM records GROUP BY topic, partition),
retained AS (SELECT topic, partition, n // 4 AS earliest, n AS latest FROM sizes),
cases AS (
  SELECT topic, partition,
    CASE ((partition % 4) + 4) % 4 WHEN 1 THEN n + 10 WHEN 2 THEN n // 8 WHEN 3 THEN n // 2 END
      AS until_offset
  FROM sizes),
ledger AS (
  SELECT 'counters' AS job, topic, partition, max("offset") + 1 AS until_offset, 0 AS epoch,
         ("offset" * 5) // n AS batch_id
  FROM records JOIN sizes USING (topic, partition) GROUP BY topic, partition, ("offset" * 5) // n
  UNION ALL
  SELECT 'counters', topic, partition, least(n, n // 4 + 10 * 5), 1, 0 FROM sizes
  UNION ALL
  SELECT 'landing', topic, partition, until_offset, 0, 0 FROM cases WHERE until_offset IS NOT NULL),
last_epoch AS (SELECT job, topic, partition, max(epoch) AS epoch FROM ledger GROUP BY ALL),
saved AS (
  SELECT l.job, l.topic, l.partition, max(l.until_offset) AS "offset"
  FROM ledger l JOIN last_epoch e USING (job, topic, partition, epoch)
  GROUP BY l.job, l.topic, l.partition),
landing_saved AS (SELECT topic, partition, "offset" FROM saved WHERE job = 'landing'),
corrected AS (
  SELECT b.topic, b.partition, b.earliest, coalesce(b.latest, 0) AS latest,
    coalesce(s."offset", 0) AS saved_offset,
    CASE WHEN coalesce(s."offset", 0) > coalesce(b.latest, 0) OR coalesce(s."offset", 0) < b.earliest
         THEN b.earliest ELSE coalesce(s."offset", 0) END AS start_offset,
    (coalesce(s."offset", 0) > coalesce(b.latest, 0) OR coalesce(s."offset", 0) < b.earliest)
      AS repaired
  FROM retained b LEFT JOIN landing_saved s USING (topic, partition)),
planned AS (
  SELECT c.topic, c.partition, c.start_offset AS from_offset,
    greatest(least(b.latest, c.start_offset + 10 * 5), c.start_offset) AS until_offset
  FROM corrected c JOIN retained b USING (topic, partition))"""

_WITH_RECORDS = f"WITH {_ACCESS_LOG},{_RECORDS}\n"
_WITH_ACCESS = f"WITH {_ACCESS_LOG}\n"

ORACLE_SQL: dict[str, str] = {
    "parse_log": _WITH_PARSED + "SELECT event_id, hour, user_id, site_id FROM parsed",
    "parse_rejects": _WITH_PARSED + """
SELECT event_id, value FROM parsed_all
WHERE hour IS NULL OR user_id IS NULL OR site_id IS NULL""",
    "pv_by_hour": _WITH_PARSED + "SELECT hour, count(*) AS pv FROM parsed GROUP BY hour",
    "site_pv_by_hour": _WITH_PARSED
    + "SELECT site_id, hour, count(*) AS pv FROM parsed GROUP BY site_id, hour",
    "uv_by_day": _WITH_PARSED
    + "SELECT day, count(DISTINCT user_id) AS uv FROM parsed GROUP BY day",
    "uv_members_by_day": _WITH_PARSED + "SELECT DISTINCT day, user_id FROM parsed",
    "batch_total": _WITH_PARSED + "SELECT count(*) AS events FROM parsed",
    "offset_bounds": _WITH_RECORDS + """
SELECT topic, partition, min("offset") AS earliest, max("offset") + 1 AS latest
FROM records GROUP BY topic, partition""",
    "offset_range_audit": _WITH_RECORDS + """
SELECT ("offset" * 5) // n AS batch_id, topic, partition, min("offset") AS from_offset,
       max("offset") + 1 AS until_offset, count(*) AS records
FROM records JOIN sizes USING (topic, partition) GROUP BY ALL""",
    "saved_offsets": _WITH_RECORDS + 'SELECT job, topic, partition, "offset" FROM saved',
    "saved_offsets_default": _WITH_RECORDS + """
SELECT b.topic, b.partition, coalesce(s."offset", 0) AS "offset"
FROM retained b LEFT JOIN landing_saved s USING (topic, partition)""",
    "correct_offsets": _WITH_RECORDS + "SELECT * FROM corrected",
    "plan_offset_ranges": _WITH_RECORDS + "SELECT * FROM planned",
    "positioned_read": _WITH_RECORDS + """
SELECT r.topic, r.partition, r."offset", r.key, r.value
FROM records r JOIN planned p USING (topic, partition)
WHERE r."offset" >= p.from_offset AND r."offset" < p.until_offset""",
    "starting_offsets_json": _WITH_RECORDS + """
SELECT topic, '{"' || topic || '":{'
       || string_agg('"' || CAST(partition AS VARCHAR) || '":' || CAST(start_offset AS VARCHAR), ','
                     ORDER BY partition)
       || '}}' AS starting_offsets
FROM corrected GROUP BY topic""",
    "land_batch_date": _WITH_RECORDS + """
SELECT value AS record,
       strftime(DATE '2024-02-01' + CAST(("offset" * 5) // n AS INTEGER), '%Y-%m-%d') AS pd
FROM records JOIN sizes USING (topic, partition)""",
    "land_row_date": _WITH_ACCESS + "SELECT value AS record, strftime(ts, '%Y-%m-%d') AS pd FROM access_log",
    "landing_partition_counts": _WITH_ACCESS + """
SELECT strftime(ts, '%Y-%m-%d') AS pd, count(*) AS records FROM access_log GROUP BY 1""",
    "insert_by_columns": _WITH_ACCESS
    + "SELECT value AS record, strftime(ts, '%Y-%m-%d') AS pt_date FROM access_log",
    "landing_scan": _WITH_ACCESS + "SELECT value AS record, '2024-02-01' AS pd FROM access_log",
    "insert_values": _WITH_PARSED + """
SELECT 'lines=' || CAST(count(*) AS VARCHAR) AS record, strftime(min(ts), '%Y-%m-%d') AS pt_date FROM access_log
UNION ALL
SELECT 'events=' || CAST((SELECT count(*) FROM parsed) AS VARCHAR), strftime(max(ts), '%Y-%m-%d') FROM access_log""",
    "encode_user_log": """
SELECT 'key-' || CAST(event_id AS VARCHAR) AS key,
       strftime(ts, '%Y-%m-%d') || CAST(epoch_us(ts) // 1000 AS VARCHAR) || CAST(user_id AS VARCHAR)
       || json_extract_string(props, '$.k') || event_type
       || CASE WHEN event_type = 'signup' THEN 'Register' ELSE 'View' END AS value
FROM events""",
    "stream_saved_offsets": _WITH_RECORDS + 'SELECT topic, partition, n AS "offset" FROM sizes',
    "stream_offset_audit": _WITH_RECORDS + """
SELECT topic, partition, min("offset") AS from_offset, max("offset") + 1 AS until_offset,
       count(*) AS records, 0 AS gaps
FROM records GROUP BY topic, partition""",
    "resume_exactly_once": _WITH_ACCESS
    + "SELECT value AS record, strftime(ts, '%Y-%m-%d') AS pd FROM access_log",
}
# Streaming and ledger views must equal their batch counterparts.
ORACLE_SQL["stream_pv_by_hour"] = ORACLE_SQL["pv_by_hour"]
ORACLE_SQL["ledger_pv"] = ORACLE_SQL["pv_by_hour"]
ORACLE_SQL["ledger_site_pv"] = ORACLE_SQL["site_pv_by_hour"]
ORACLE_SQL["stream_uv_by_day"] = ORACLE_SQL["uv_by_day"]
ORACLE_SQL["stream_site_pv_by_hour"] = ORACLE_SQL["site_pv_by_hour"]
ORACLE_SQL["stream_site_pv_updates"] = ORACLE_SQL["site_pv_by_hour"]
ORACLE_SQL["stream_parse_rejects"] = _WITH_RECORDS + """,
record_fields AS (
  SELECT topic, partition, "offset", value, string_split_regex(value, '\\|~\\|') AS f FROM records)
SELECT topic, partition, "offset", value FROM record_fields
WHERE (CASE WHEN length(f[1]) >= 13 THEN replace(substr(f[1], 1, 13), 'T', '-') END) IS NULL
   OR string_split_regex(f[3], '[=|&]')[2] IS NULL
   OR string_split_regex(f[3], '[=|&]')[4] IS NULL"""
ORACLE_SQL["ledger_uv"] = ORACLE_SQL["uv_by_day"]
ORACLE_SQL["ledger_uv_members"] = ORACLE_SQL["uv_members_by_day"]
ORACLE_SQL["ledger_pv_compacted"] = ORACLE_SQL["pv_by_hour"]
ORACLE_SQL["landing_compacted"] = ORACLE_SQL["resume_exactly_once"]
ORACLE_SQL["stream_batch_total"] = _WITH_PARSED + """
SELECT (SELECT count(*) FROM access_log) AS records, (SELECT count(*) FROM parsed) AS events, 5 AS batches"""
ORACLE_SQL["stream_site_pv_updates_restart"] = ORACLE_SQL["site_pv_by_hour"]
ORACLE_SQL["stream_offset_audit_compacted"] = ORACLE_SQL["stream_offset_audit"]
ORACLE_SQL["stream_batch_total_compacted"] = ORACLE_SQL["stream_batch_total"]
ORACLE_SQL["resume_after_retention"] = _WITH_PARSED + "SELECT hour, 2 * count(*) AS pv FROM parsed GROUP BY hour"
ORACLE_SQL["ingest_batch_date"] = ORACLE_SQL["land_batch_date"]
