"""Explicit positions: streams that start from given offsets, the range loop
whose only store is its commits, the offset index and footers; event-time
hours, bitmap sets, stored state and interval triggers."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tidemark import queries as q
from tidemark import queries_positions as qp
from tidemark.operators import offsets, parse
from tidemark.plans import ingest, ranges, traffic
from tidemark.sources import files, offset_index, topic_stream
from tidemark.streaming import commits, counters, ledger, progress, userbits, windows
from tidemark.streaming.runner import default_state_partitions, run_available, run_batches

SF = "/root/testdata/sf0.001"
BOUNDS = "topic STRING, partition INT, earliest BIGINT, latest BIGINT"


def records(spark, sizes, hour=0):
    """A topic of partitions of these sizes."""
    rows = spark.createDataFrame([(p, n) for p, n in enumerate(sizes)], "partition INT, n BIGINT")
    rows = rows.select("partition", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("offset"), F.col("n").alias("partition_records"))
    line = F.concat(F.lit("2024-02-01T10:00:00|~|x|~|/p?uid=u"), F.col("offset"), F.lit("&sid=s"), F.col("partition"))
    return rows.select(F.lit("events").alias("topic"), "partition", "offset", F.lit("k").alias("key"), line.alias("value"),
                       F.lit("2024-02-01 10:00:00").cast("timestamp_ntz").alias("ts"), "partition_records")


@pytest.fixture(scope="module")
def unequal(spark, tmp_path_factory):
    """Eight unequal partitions, landed with an index."""
    path = str(tmp_path_factory.mktemp("topic") / "t")
    sizes = [100, 200, 400, 800, 1600, 3200, 60, 1000]
    files.land_records(records(spark, sizes), path)
    return path, offset_index.write_index(spark, path), sizes


def seen(spark, stream, cp):
    out = []
    run_batches(stream, lambda b, i: out.extend((r["partition"], r["offset"]) for r in b.select("partition", "offset").collect()), cp)
    return sorted(out)


def test_a_stream_starts_from_named_offsets_of_named_partitions(spark, scratch, unequal):
    _, index, sizes = unequal
    start = json.dumps({"events": {"1": 150, "5": -2, "7": -1}})
    cp = scratch("cp")
    stream = topic_stream.topic_stream(spark, index, start, assign={"events": [1, 5, 7]})
    assert seen(spark, stream, cp) == [(1, o) for o in range(150, 200)] + [(5, o) for o in range(3200)]
    # the position in the checkpoint is the map of offsets
    import glob
    newest = max(glob.glob(f"{cp}/offsets/*"), key=lambda f: int(f.rsplit("/", 1)[1]))
    with open(newest) as f:
        assert json.loads(f.read().splitlines()[-1]) == {"events": {"1": 200, "5": 3200, "7": 1000}}
    assert seen(spark, topic_stream.topic_stream(spark, index, start, assign={"events": [1, 5, 7]}), cp) == []


@pytest.mark.parametrize("start, said", [({"events": {"0": 5, "1": 500}}, "is gone"), ({"events": {"0": 5}}, "every partition")])
def test_a_start_that_is_not_there_fails(spark, scratch, unequal, start, said):
    stream = topic_stream.topic_stream(spark, unequal[1], json.dumps(start), assign={"events": [0, 1]})
    with pytest.raises(Exception, match=said):
        seen(spark, stream, scratch("cp"))


def test_a_resumed_stream_whose_offsets_are_gone(spark, scratch, unequal):
    """Retention removes what a checkpoint would go on from."""
    path, index, sizes = unequal
    cp, own = scratch("cp"), scratch("index")
    whole = offset_index.read_index(spark, index)
    whole.where("low < 20").write.parquet(own)
    assert len(seen(spark, topic_stream.topic_stream(spark, own, assign={"events": [5]}), cp)) == 160
    whole.where("partition = 5 AND low >= 1600").write.mode("overwrite").parquet(own)
    with pytest.raises(Exception, match="is gone"):
        seen(spark, topic_stream.topic_stream(spark, own, assign={"events": [5]}), cp)
    got = seen(spark, topic_stream.topic_stream(spark, own, assign={"events": [5]}, strict=False), cp)
    assert got == [(5, o) for o in range(1600, 3200)]
    with pytest.raises(Exception, match="no partition"):
        seen(spark, topic_stream.topic_stream(spark, own, assign={"events": [5, 99]}), scratch("cp2"))


def test_latest_starts_at_the_end(spark, scratch, unequal):
    assert seen(spark, topic_stream.topic_stream(spark, unequal[1], "latest"), scratch("cp")) == []


def test_no_partition_exceeds_its_rate(spark, scratch, unequal):
    """One partition far behind the others, one at its end already."""
    _, index, sizes = unequal
    land, path = scratch("landing"), scratch("ledger")
    start = [n - 30 for n in sizes]
    start[5], start[6] = 2000, 60
    ranges.seed_positions(spark, land, spark.createDataFrame([("events", p, o) for p, o in enumerate(start)], ranges.POSITIONS_SCHEMA))
    with pytest.raises(ValueError, match="already"):
        ranges.seed_positions(spark, land, spark.createDataFrame([("events", 0, 0)], ranges.POSITIONS_SCHEMA))
    done = ranges.run_ranges(spark, index, land, path, 100, 3)
    audit = ledger.ledger_offset_audit(ledger.read_ledger(spark, path)).collect()
    assert done == 4 and all(r["records"] == r["until_offset"] - r["from_offset"] <= 300 for r in audit)
    per = {p: sum(r["records"] for r in audit if r["partition"] == p) for p in range(8)}
    assert per == {p: sizes[p] - start[p] for p in range(8)}
    assert [r["records"] for r in sorted(audit, key=lambda r: r["batch_id"]) if r["partition"] == 5] == [300, 300, 300, 300]
    assert ranges.newest_commit(spark, land)[1] == {"events": {str(p): n for p, n in enumerate(sizes)}}
    assert ingest.read_landing(spark, land).count() == sum(per.values())
    assert ranges.run_ranges(spark, index, land, path, 100, 3) == 0


def test_two_range_loops_share_the_work(spark, scratch, unequal):
    """Another loop commits the batch that this one has written: it goes on
    from there, and every record lands once."""
    _, index, sizes = unequal
    land, path = scratch("landing"), scratch("ledger")
    inner = []

    def overtake(epoch, batch_id):
        if batch_id == 1 and not inner:
            inner.append(ranges.run_ranges(spark, index, land, path, 500, 1, most_batches=1))
    assert ranges.run_ranges(spark, index, land, path, 500, 1, before_commit=overtake) == 7 and inner == [1]
    got = ingest.read_landing(spark, land)
    assert got.count() == sum(sizes) == got.distinct().count()
    audit = ledger.ledger_offset_audit(ledger.read_ledger(spark, path))
    assert audit.agg(F.sum("records")).first()[0] == sum(sizes)
    assert audit.select("batch_id").distinct().count() == 7


def test_a_repair_that_goes_back_opens_an_epoch(spark, scratch, unequal):
    _, index, sizes = unequal
    land, path = scratch("landing"), scratch("ledger")
    ahead = [("events", p, n + 7 if p == 0 else n) for p, n in enumerate(sizes)]
    ranges.seed_positions(spark, land, spark.createDataFrame(ahead, ranges.POSITIONS_SCHEMA))
    assert ranges.run_ranges(spark, index, land, path, None, 1) == 1
    assert ranges.newest_commit(spark, land)[0] == (1, 0)
    assert [tuple(r) for r in ledger.ledger_positions(ledger.read_ledger(spark, path)).collect()] == [("events", 0, 100)]


def test_a_positioned_read_opens_only_the_files_that_hold_it(spark, unequal):
    path, index, sizes = unequal
    known = offset_index.read_index(spark, index)
    wanted = spark.createDataFrame([("events", p, n // 2, n // 2 + 50) for p, n in enumerate(sizes)], ranges.RANGES_SCHEMA)
    holds = {r["file"] for r in known.collect() for p, n in enumerate(sizes)
             if r["partition"] == p and r["low"] < min(n, n // 2 + 50) and r["high"] >= n // 2}
    got = offset_index.indexed_read(spark, known, wanted)
    assert {f.replace("file://", "file:") for f in got.inputFiles()} == {f.replace("file://", "file:") for f in holds}
    assert len(holds) < known.select("file").distinct().count()
    assert got.count() == sum(min(50, n - n // 2) for n in sizes)
    one = spark.createDataFrame([("events", 5, 1000, 1050), ("events", 2, 10, 10)], ranges.RANGES_SCHEMA)
    assert len(offset_index.indexed_read(spark, known, one).inputFiles()) == 1
    none = spark.createDataFrame([("events", 5, 9000, 9050)], ranges.RANGES_SCHEMA)
    assert offset_index.indexed_read(spark, known, none).count() == 0


def test_bounds_from_index_and_footers(spark, scratch, unequal, capsys):
    path, index, sizes = unequal
    rows = files.read_records(spark, path)
    want = sorted(map(tuple, offsets.offset_bounds(rows).collect()))
    assert sorted(map(tuple, offset_index.index_bounds(offset_index.read_index(spark, index)).collect())) == want
    by = scratch("by_partition")
    offset_index.land_by_partition(rows, by)
    found = offset_index.footer_bounds(spark, by)
    assert sorted((r["partition"], r["earliest"], r["latest"]) for r in found.collect()) == [w[1:] for w in want]
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedAggregation: [MIN(offset), MAX(offset), COUNT(*)]" in plan and "PushedGroupBy: [partition]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown", "false") == "false"   # the caller's session is as it was


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_hours_close_once_and_late_lines_are_kept(spark, scratch, zone):
    topic = q._landed_topic(spark, SF)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = qp.q_event_time_hours(spark, SF).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    closed = [r["hour"] for r in rows if r["kind"] == "closed"]
    assert len(closed) == len(set(closed))
    parsed = parse.parse_log(files.read_records(spark, topic))
    newest = max(r["hour"] for r in rows)
    open_ = parsed.where(F.col("hour") > newest).count()
    assert sum(r["events"] for r in rows) + open_ == parsed.count() and any(r["kind"] == "late" for r in rows)


def test_a_late_batch_is_written_once(spark, scratch):
    out = scratch("late")
    write = windows.late_rows_writer(out, "1 hour")
    base = records(spark, [4])
    at = lambda t: base.withColumn("ts", F.lit(t).cast("timestamp_ntz"))
    for b, t in enumerate(["2024-02-01 10:00:00", "2024-02-01 15:30:00", "2024-02-01 09:00:00", "2024-02-01 13:10:00", "2024-02-01 15:00:00"]):
        write(at(t), b)
        write(at(t), b)
    # batch 2 is judged by batch 0's newest time, batches 3 and 4 by batch 1's
    assert {str(r["ts"])[11:16]: r["count"] for r in windows.read_late(spark, out).groupBy("ts").count().collect()} == {"13:10": 4}


def test_bitmaps_write_only_what_is_new(spark, scratch):
    path, users = scratch("ledger"), scratch("users")

    def batch(b, sizes):
        ledger.write_ledger(ledger.batch_ledger_rows(records(spark, sizes), 0, b), path)
        commits.mark_committed(spark, path, 0, b)
    assert userbits.fold_users(spark, path, users) is None
    batch(0, [1000])
    assert userbits.fold_users(spark, path, users) == (0, 0)
    batch(1, [1000])
    assert userbits.fold_users(spark, path, users) == (0, 1)      # the same users: nothing to number
    names = [p for p in ledger.newest_manifest(spark, users)[2] if p[0] == "names"]
    per = [spark.read.parquet(f"{users}/names/part={p}").count() for _, p, _ in names]
    assert per == [1000, 0]
    batch(2, [1500])
    userbits.fold_users(spark, path, users)
    assert [tuple(r) for r in userbits.uv_by_day(spark, users).collect()] == [("2024-02-01", 1500)]
    assert sorted(r["user_id"] for r in userbits.members_by_day(spark, users).collect()) == sorted(f"u{i}" for i in range(1500))
    assert userbits.retain_users(spark, users) > 0
    assert userbits.uv_by_day(spark, users).first()["uv"] == 1500
    n = spark.read.parquet(*[f"{users}/names/part={p}" for k, p, _ in ledger.newest_manifest(spark, users)[2] if k == "names"])
    assert n.select("n").distinct().count() == n.count() == 1500   # one number for each user
    assert n.agg(F.max("n")).first()[0] < 1500 * 4                 # and dense ones
    assert spark.read.parquet(f"{users}/bits").count() <= 3        # a bitmap of a day for each fold, at most


def test_interval_trigger_runs_batch_after_batch(spark, scratch):
    """A fixed-interval trigger: two batches that come at its pace, then stop."""
    topic, path, cp = scratch("topic"), scratch("ledger"), scratch("cp")

    def land(slice_):
        (records(spark, [50]).drop("partition_records").withColumn("offset", F.col("offset") + 50 * slice_).withColumn("slice", F.lit(slice_))
         .write.mode("append").partitionBy("slice").parquet(topic))
    land(0)
    started = traffic.start_traffic_job(spark, files.record_stream(spark, topic), path, cp, processing_time="3 seconds")
    try:
        def wait(n):
            until = time.time() + 60
            while time.time() < until and len(commits.listed(spark, path)) < n:
                time.sleep(.2)
            return len(commits.listed(spark, path)) == n
        assert wait(1)
        land(1)
        assert wait(2)
        assert started.isActive
        starts = [p["timestamp"] for p in started.recentProgress if p["numInputRows"]]
    finally:
        started.stop()
    assert len(starts) == 2 and int(starts[1][17:19]) % 3 == 0     # the first at once, then on the interval's grid
    assert [r["offset"] for r in ledger.saved_positions(spark, path).collect()] == [100]


def test_watermark_state_is_dropped_when_hours_close(spark, scratch):
    """Append mode keeps no state for hours that are over."""
    cp = scratch("cp")
    closed = windows.hours_closed(q._topic_stream(spark, q._landed_topic(spark, SF)), "1 hour")
    run_available(closed.writeStream.outputMode("append").format("noop").option("checkpointLocation", cp),
                  spark=spark, state_partitions=default_state_partitions(spark))
    assert counters.state_table(spark, cp).count() <= 2


def test_progress_rows_cost_no_job_and_have_the_positions(spark, scratch, unequal):
    path, index, sizes = unequal
    land, cp, out = scratch("landing"), scratch("cp"), scratch("progress")
    run = progress.land_counted(spark, files.record_stream(spark, path, files.FILES_PER_BAND), land, cp, out)
    rows = progress.read_progress(spark, out).collect()
    assert len(rows) == 5 and sum(r["records"] for r in rows) == sum(r["events"] for r in rows) == sum(sizes)
    assert all(r["records"] == r["input_rows"] for r in rows)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(run.runId))) == 5      # one a batch
    assert spark.read.parquet(land).count() == sum(sizes)
    # with the topic source, the end position is the map of offsets
    again = scratch("progress2")
    progress.land_counted(spark, topic_stream.topic_stream(spark, index), scratch("landing2"), scratch("cp2"), again)
    end = json.loads(progress.read_progress(spark, again).first()["end_offset"])
    assert end == {"events": {str(p): n for p, n in enumerate(sizes)}}
