"""Registered queries of positioned streams, the range loop, the offset index,
event-time hours, bitmap sets and stored state, with their DuckDB SQL.

They read the topic of :mod:`tidemark.queries` (``events``, whole).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import queries as q
from tidemark.operators import offsets
from tidemark.operators.joins import checkpointed
from tidemark.plans import ingest, ranges
from tidemark.plans.seed import repaired_starting_offsets
from tidemark.session import scratch_path
from tidemark.sources import files, offset_index, scenarios, topic_stream
from tidemark.streaming import counters, ledger, progress, userbits, windows
from tidemark.streaming.runner import default_state_partitions, run_available, run_batches

_INDEXES: dict[str, str] = {}


def _index(spark, sf_dir) -> str:
    """The landed topic's offset index, written once."""
    topic = q._landed_topic(spark, sf_dir)
    if topic not in _INDEXES:
        _INDEXES[topic] = offset_index.write_index(spark, topic)
    return _INDEXES[topic]


# --------------------------------------------------------------------------
# Offset index and footers
# --------------------------------------------------------------------------

def q_offset_bounds_indexed(spark, sf_dir):
    """Earliest and latest offsets from the zone map; no record is read."""
    return offset_index.index_bounds(offset_index.read_index(spark, _index(spark, sf_dir)))


def q_positioned_read_indexed(spark, sf_dir):
    """Planned ranges read from the files that the zone map names."""
    index = offset_index.read_index(spark, _index(spark, sf_dir))
    return offset_index.indexed_read(spark, index, q._planned(q._audit(spark, sf_dir))).drop("ts")


def q_offset_bounds_footers(spark, sf_dir):
    """Bounds and counts from Parquet footers, by an aggregate in the scan."""
    path = scratch_path(spark, "topic_by_partition")
    offset_index.land_by_partition(files.read_records(spark, q._landed_topic(spark, sf_dir)), path)
    return offset_index.footer_bounds(spark, path)


# --------------------------------------------------------------------------
# Explicit positions
# --------------------------------------------------------------------------

def _published(spark, sf_dir, slices: int, index: str) -> str:
    """An index that shows the first ``slices`` of the landed topic."""
    whole = offset_index.read_index(spark, _index(spark, sf_dir))
    number = F.regexp_extract("file", r"/slice=(\d+)/", 1).cast("int")
    whole.where(number < slices).write.mode("overwrite").parquet(index)
    return index


def q_stream_from_offsets(spark, sf_dir):
    """Saved positions repaired against the topic's bounds, a stream started
    from them while three bands of the topic are there, and resumed from its
    checkpoint when all is: every record from its partition's start on, once.
    The restart is given other offsets, which the checkpoint overrules."""
    audit = q._audit(spark, sf_dir)
    starting = repaired_starting_offsets(scenarios.retained_bounds(audit), q._landing_job_positions(audit))
    land, path, cp, index = (scratch_path(spark, x) for x in ("landing", "ledger", "checkpoint", "published"))
    band = q._FILES_PER_BAND[q._landed_topic(spark, sf_dir)]
    for slices, start in ((3 * band, starting), (1 << 30, "earliest")):
        stream = topic_stream.topic_stream(spark, _published(spark, sf_dir, slices, index), start)
        run_batches(stream, ingest.ingest_job(spark, land, path, cp), cp)
    return ingest.read_landing(spark, land)


def _range_loop(spark, sf_dir) -> tuple[str, str]:
    """The range loop over a topic that retention has cut, from the saved
    positions of another job, with a crash between a batch's data and its
    commit."""
    audit = q._audit(spark, sf_dir)
    bounds = checkpointed(scenarios.retained_bounds(audit))
    land, path = scratch_path(spark, "landing"), scratch_path(spark, "ledger")
    ranges.seed_positions(spark, land, q._landing_job_positions(audit))
    rate = -(-bounds.agg(F.max("latest")).first()[0] // 30)

    def die(_, batch_id):
        if batch_id == q.CRASH_BATCH:
            raise scenarios.InjectedFailure("injected failure before the commit")
    for hook in (die, None):
        try:
            ranges.run_ranges(spark, _index(spark, sf_dir), land, path, rate, 5, bounds, hook)
        except scenarios.InjectedFailure:
            pass
    return land, path


def q_range_loop_audit(spark, sf_dir):
    """What each batch of the range loop read of each partition: no partition
    more than its rate, however far behind, each range once."""
    return ledger.ledger_offset_audit(ledger.read_ledger(spark, _range_loop(spark, sf_dir)[1]))


def q_range_loop_landed(spark, sf_dir):
    """What the range loop landed: every record from its start on, once."""
    return ingest.read_landing(spark, _range_loop(spark, sf_dir)[0])


def q_ingest_batch_date_maintained(spark, sf_dir):
    """Landing ingest with one date a batch that dies in batch 2 before its
    commit; ledger and landing are compacted and retained; the batch is
    replayed on another day, and all is compacted and retained again."""
    days = iter(range(1000))
    topic = q._landed_topic(spark, sf_dir)
    land, path, cp, comp, snap = (scratch_path(spark, x) for x in ("landing", "ledger", "checkpoint", "compacted", "snapshot"))

    def job():
        return ingest.ingest_job(spark, land, path, cp, date_mode="batch", clock=lambda: q._batch_day(next(days)))

    def maintain():
        ledger.compact_ledger(spark, path, snap)
        ledger.retain_ledger(spark, path, snap)
        ingest.compact_landing(spark, land, comp)
        ingest.retain_landing(spark, land, comp)
    scenarios.run_with_crash(lambda: q._topic_stream(spark, topic), job, cp, q.CRASH_BATCH, land, resume=False)
    maintain()
    # the clock would now say the next day; batch 2 keeps the date it settled on
    run_batches(q._topic_stream(spark, topic), job(), cp)
    maintain()
    return ingest.read_landing_compacted(spark, land, comp)


# --------------------------------------------------------------------------
# Event-time hours, bitmap sets, stored state
# --------------------------------------------------------------------------

DELAY, TURNS = "10 days", 5


def q_event_time_hours(spark, sf_dir):
    """A topic that is delivered out of order, each batch every fifth record of
    each partition: hours emitted once when they are over, and the lines that
    came too late for them, by hour."""
    topic = scratch_path(spark, "out_of_order")
    sliced = q._records(spark, sf_dir).withColumn("slice", (F.col("offset") % TURNS).cast("int")).drop("partition_records")
    files.land_slices(sliced, topic, TURNS)

    def stream():
        return files.record_stream(spark, topic, max_files_per_trigger=1)
    out, late = scratch_path(spark, "hours"), scratch_path(spark, "late")
    closed = windows.hours_closed(stream(), DELAY)
    run_available(closed.writeStream.outputMode("append").foreachBatch(windows.append_writer(out))
                  .option("checkpointLocation", scratch_path(spark, "hours_checkpoint")),
                  spark=spark, state_partitions=default_state_partitions(spark))
    run_batches(stream(), windows.late_rows_writer(late, DELAY), scratch_path(spark, "late_checkpoint"))
    missed = windows.read_late(spark, late).groupBy(F.date_format("ts", "yyyy-MM-dd-HH").alias("hour")).agg(F.count(F.lit(1)).alias("events"))
    return (windows.read_hours(spark, out).select(F.lit("closed").alias("kind"), "hour", F.col("pv").alias("events"))
            .unionByName(missed.select(F.lit("late").alias("kind"), "hour", "events")))


def _bitmaps(spark, sf_dir) -> str:
    """Users as bitmaps: folded after a crash of the counters job, and again
    when it has gone on."""
    path, go_on = q._traffic_crash(spark, sf_dir, resume=False)
    users = scratch_path(spark, "users")
    userbits.fold_users(spark, path, users)
    go_on()
    userbits.fold_users(spark, path, users)
    userbits.retain_users(spark, users)
    return users


def q_bitmap_uv(spark, sf_dir):
    return userbits.uv_by_day(spark, _bitmaps(spark, sf_dir))


def q_bitmap_members(spark, sf_dir):
    return userbits.members_by_day(spark, _bitmaps(spark, sf_dir))


def q_state_site_pv(spark, sf_dir):
    """Running site page views read from the query's own state, without an
    output table."""
    cp = scratch_path(spark, "state_checkpoint")
    result = counters.running_site_pv_by_hour(q._topic_stream(spark, q._landed_topic(spark, sf_dir)))
    run_available(result.writeStream.outputMode("update").format("noop").option("checkpointLocation", cp),
                  spark=spark, state_partitions=default_state_partitions(spark))
    return counters.state_table(spark, cp).select("site_id", "hour", F.col("count").alias("pv"))


def q_progress_totals(spark, sf_dir):
    """Lines read and parsed, from the counts that each batch reported while
    it was written."""
    path = scratch_path(spark, "progress")
    progress.land_counted(spark, q._topic_stream(spark, q._landed_topic(spark, sf_dir)), scratch_path(spark, "landing"),
                          scratch_path(spark, "checkpoint"), path)
    return q._summed(progress.read_progress(spark, path).where("records > 0"))


QUERIES = {
    "offset_bounds_indexed": q_offset_bounds_indexed,
    "positioned_read_indexed": q_positioned_read_indexed,
    "offset_bounds_footers": q_offset_bounds_footers,
    "stream_from_offsets": q_stream_from_offsets,
    "range_loop_audit": q_range_loop_audit,
    "range_loop_landed": q_range_loop_landed,
    "ingest_batch_date_maintained": q_ingest_batch_date_maintained,
    "event_time_hours": q_event_time_hours,
    "bitmap_uv": q_bitmap_uv,
    "bitmap_members": q_bitmap_members,
    "state_site_pv": q_state_site_pv,
    "progress_totals": q_progress_totals,
}

_FROM_START = q._WITH_RECORDS + """
SELECT r.value AS record, strftime(r.ts, '%Y-%m-%d') AS pd
FROM records r JOIN corrected c USING (topic, partition) WHERE r."offset" >= c.start_offset"""

ORACLE_SQL = {
    "offset_bounds_indexed": q.ORACLE_SQL["offset_bounds"],
    "positioned_read_indexed": q.ORACLE_SQL["positioned_read"],
    "offset_bounds_footers": q._WITH_RECORDS + """
SELECT partition, min("offset") AS earliest, max("offset") + 1 AS latest, count(*) AS records FROM records GROUP BY partition""",
    "stream_from_offsets": _FROM_START,
    "range_loop_landed": _FROM_START,
    "range_loop_audit": q._WITH_RECORDS + """,
plan AS (SELECT 5 * ((max(n) + 29) // 30) AS cap FROM sizes),
steps AS (
  SELECT topic, partition, n, start_offset, cap, unnest(range(0, (n - start_offset + cap - 1) // cap)) AS k
  FROM corrected JOIN sizes USING (topic, partition), plan)
SELECT 1 AS epoch, k AS batch_id, topic, partition, start_offset + k * cap AS from_offset,
  least(n, start_offset + (k + 1) * cap) AS until_offset, least(n, start_offset + (k + 1) * cap) - start_offset - k * cap AS records
FROM steps""",
    "ingest_batch_date_maintained": q.ORACLE_SQL["ingest_batch_date"],
    # A batch's late lines: their hour was over by the watermark of the batch before it.
    "event_time_hours": q._WITH_RECORDS + """,
fields AS (
  SELECT "offset" % 5 AS band, ts, string_split_regex(value, '\\|~\\|') AS f FROM records),
good AS (
  SELECT band, ts, date_trunc('hour', ts) AS hour FROM fields
  WHERE length(f[1]) >= 13 AND string_split_regex(f[3], '[=|&]')[2] IS NOT NULL AND string_split_regex(f[3], '[=|&]')[4] IS NOT NULL),
marks AS (SELECT b.band, (SELECT max(ts) FROM good WHERE band < b.band - 1) - INTERVAL 10 DAY AS mark FROM (SELECT DISTINCT band FROM good) b),
placed AS (SELECT hour, mark IS NOT NULL AND hour + INTERVAL 1 HOUR <= mark AS late FROM good JOIN marks USING (band))
SELECT CASE WHEN late THEN 'late' ELSE 'closed' END AS kind, strftime(hour, '%Y-%m-%d-%H') AS hour, count(*) AS events
FROM placed WHERE late OR hour + INTERVAL 1 HOUR <= (SELECT max(ts) FROM good) - INTERVAL 10 DAY GROUP BY ALL""",
    "bitmap_uv": q.ORACLE_SQL["uv_by_day"],
    "bitmap_members": q.ORACLE_SQL["uv_members_by_day"],
    "state_site_pv": q.ORACLE_SQL["site_pv_by_hour"],
    "progress_totals": q.ORACLE_SQL["stream_batch_total"],
}
