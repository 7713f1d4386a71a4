"""One commit for all outputs of a batch, and maintenance beside live jobs:
crashes between outputs, readers that hold an older manifest, compactions at
the same time."""

import threading

import pytest
from pyspark.sql import functions as F

from tidemark import queries as q
from tidemark.plans import ingest, traffic
from tidemark.sources import files, fs
from tidemark.streaming import commits, ledger
from tidemark.streaming.runner import run_batches

SF = "/root/testdata/sf0.001"
TOPIC = "topic STRING, partition INT, offset BIGINT, key STRING, value STRING, ts TIMESTAMP_NTZ"


@pytest.fixture(scope="module")
def topic(spark):
    return q._landed_topic(spark, SF)


def records(spark, first, n, hour="10"):
    line = F.concat(F.lit(f"2024-02-01T{hour}:00:00|~|x|~|/p?uid=u"), F.col("id"), F.lit("&sid=s"))
    return spark.range(first, first + n).select(
        F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.lit("k").alias("key"), line.alias("value"), F.lit("2024-02-01 10:00:00").cast("timestamp_ntz").alias("ts"))


def put_batch(spark, path, b, n=10, epoch=0):
    ledger.write_ledger(ledger.batch_ledger_rows(records(spark, b * n, n), epoch, b), path)
    assert commits.mark_committed(spark, path, epoch, b)


def pv(led):
    return ledger.ledger_pv(led).agg(F.sum("pv")).first()[0]


def test_only_one_writer_creates_a_file(spark, scratch):
    path = f"{scratch('x')}/log/commit.json"
    won, start = [], threading.Barrier(8)

    def put(i):
        start.wait()
        if fs.put_if_absent(spark, path, f"writer {i}"):
            won.append(i)
    threads = [threading.Thread(target=put, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1 and fs.read_text(spark, path) == f"writer {won[0]}"
    assert len(fs.files(spark, f"{path.rpartition('/')[0]}/*")) == 1          # no hidden files stay


def test_the_second_attempt_at_a_batch_is_never_read(spark, scratch):
    """Two drivers at the same batch: each writes whole outputs, one commits."""
    land, path = scratch("landing"), scratch("ledger")
    commits.share(spark, land, path)
    commits.share(spark, land, path)
    with pytest.raises(ValueError, match="already"):
        commits.share(spark, scratch("other"), path)
    for attempt, day, n in (("a", "2024-02-01", 10), ("b", "2024-02-02", 7)):
        recs = records(spark, 0, n)
        ingest.write_landed(recs.select(F.col("value").alias("record"), F.lit(day).alias("pd")), land, 0, 0, attempt)
        ledger.write_ledger(ledger.batch_ledger_rows(recs, 0, 0), path, attempt)
    assert commits.mark_committed(spark, land, 0, 0, "b") and not commits.mark_committed(spark, land, 0, 0, "a")
    assert [tuple(r) for r in ingest.read_landing(spark, land).groupBy("pd").count().collect()] == [("2024-02-02", 7)]
    assert pv(ledger.read_ledger(spark, path)) == 7


class Died(RuntimeError):
    pass


@pytest.mark.parametrize("where", ["landed", "positions", "commit"])
def test_a_batch_lands_once_through_crash_maintenance_and_midnight(spark, scratch, monkeypatch, where):
    """The job dies between two of its outputs, everything is compacted and
    retained, and the batch is replayed on another day."""
    source = scratch("topic")
    records(spark, 0, 10).withColumn("slice", F.lit(0)).write.partitionBy("slice").parquet(source)
    land, path, cp, comp, snap = (scratch(x) for x in ("landing", "ledger", "cp", "compacted", "snapshot"))

    def run(day):
        write = ingest.ingest_job(spark, land, path, cp, date_mode="batch", clock=lambda: day)
        run_batches(files.record_stream(spark, source), write, cp)

    def maintain():
        for _ in range(2):
            ledger.compact_ledger(spark, path, snap)
            ledger.retain_ledger(spark, path, snap)
            ingest.compact_landing(spark, land, comp)
            ingest.retain_landing(spark, land, comp)

    def die(*_, **__):
        raise Died("died here")
    target = {"landed": (ingest, "write_landed"), "positions": (ingest, "write_ledger"), "commit": (commits, "mark_committed")}[where]
    with monkeypatch.context() as m:
        m.setattr(*target, die)
        with pytest.raises(Exception, match="died here"):
            run("2024-02-01")
    maintain()
    run("2024-02-02")
    # and a later batch, so that maintenance covers and removes the first
    records(spark, 10, 10).withColumn("slice", F.lit(1)).write.mode("append").partitionBy("slice").parquet(source)
    run("2024-02-03")
    maintain()
    run("2024-02-04")
    for read in (ingest.read_landing_compacted(spark, land, comp),):
        assert {tuple(r) for r in read.groupBy("pd").count().collect()} == {("2024-02-01", 10), ("2024-02-03", 10)}
    assert [r["offset"] for r in ledger.saved_positions(spark, path, snap).collect()] == [20]


def test_a_replay_of_a_batch_that_was_committed_and_retained(spark, scratch):
    """The newest commit of an epoch stays, so its batch is known at a replay
    although its rows were removed."""
    path, snap = scratch("ledger"), scratch("snapshot")
    for b in range(3):
        put_batch(spark, path, b)
        ledger.compact_ledger(spark, path, snap)
    put_batch(spark, path, 0, epoch=1)
    ledger.compact_ledger(spark, path, snap)
    ledger.retain_ledger(spark, path, snap)
    assert commits.listed(spark, path) == [(0, 2), (1, 0)]
    traffic.traffic_batch_writer(path, 0)(records(spark, 20, 10), 2)
    assert pv(ledger.read_compacted(spark, path, snap)) == 40


def test_a_reader_of_the_manifest_before_loses_nothing(spark, scratch, monkeypatch):
    """A reader takes the manifest; then two batches are compacted and all
    that is covered is removed; then it lists the ledger."""
    path, snap = scratch("ledger"), scratch("snapshot")
    put_batch(spark, path, 0)
    ledger.compact_ledger(spark, path, snap)
    put_batch(spark, path, 1)
    seen, real = [], ledger.read_snapshot

    def slow(*args):
        got = real(*args)
        if len(seen) < 3:                      # maintenance overtakes the reader three times
            seen.append(got[0])
            put_batch(spark, path, 1 + len(seen))
            ledger.compact_ledger(spark, path, snap)
            ledger.retain_ledger(spark, path, snap)
        return got
    monkeypatch.setattr(ledger, "read_snapshot", slow)
    assert pv(ledger.read_compacted(spark, path, snap)) == 50 and len(seen) == 3
    # what a reader had listed before one compaction is still there when it reads
    held = ledger.read_compacted(spark, path, snap)
    put_batch(spark, path, 9)
    ledger.compact_ledger(spark, path, snap)
    ledger.retain_ledger(spark, path, snap)
    assert pv(held) == 50


def test_two_compactions_at_once_count_once(spark, scratch, monkeypatch):
    path, snap, land, comp = (scratch(x) for x in ("ledger", "snapshot", "landing", "compacted"))
    put_batch(spark, path, 0)
    ledger.compact_ledger(spark, path, snap)
    put_batch(spark, path, 1)
    ingest.write_landed(records(spark, 0, 10).select(F.col("value").alias("record"), F.lit("d").alias("pd")), land, 0, 0)
    commits.mark_committed(spark, land, 0, 0)
    real, inner = ledger.put_manifest, []

    def late(spark_, root, *args):
        if not inner:                          # another compaction comes first, from rows to manifest
            inner.append(True)
            (ledger.compact_ledger(spark, path, snap) if root == snap else ingest.compact_landing(spark, land, comp))
        return real(spark_, root, *args)
    monkeypatch.setattr(ledger, "put_manifest", late)
    monkeypatch.setattr(ingest, "put_manifest", late)
    assert ledger.compact_ledger(spark, path, snap) == (0, 1)
    assert pv(ledger.read_compacted(spark, path, snap)) == 20
    inner.clear()
    assert ingest.compact_landing(spark, land, comp) == (0, 0)
    assert ingest.read_landing_compacted(spark, land, comp).count() == 10
    # the parts that came second are removed, the others stay
    put_batch(spark, path, 2)
    ledger.compact_ledger(spark, path, snap)
    assert ledger.retain_ledger(spark, path, snap) > 0 and ingest.retain_landing(spark, land, comp) == 1
    assert pv(ledger.read_compacted(spark, path, snap)) == 30
    assert ingest.read_landing_compacted(spark, land, comp).count() == 10


def test_compactions_in_threads_count_once(spark, scratch):
    path, snap = scratch("ledger"), scratch("snapshot")
    for b in range(4):
        put_batch(spark, path, b)
    marks = []
    threads = [threading.Thread(target=lambda: marks.append(ledger.compact_ledger(spark, path, snap))) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert marks == [(0, 3)] * 3 and pv(ledger.read_compacted(spark, path, snap)) == 40


def test_audit_parts_grow_with_the_logarithm_of_compactions(spark, scratch):
    path, snap = scratch("ledger"), scratch("snapshot")
    for b in range(9):
        put_batch(spark, path, b, n=3)
        ledger.compact_ledger(spark, path, snap)
    parts = ledger.newest_manifest(spark, snap)[2]
    for name in ledger.ADDED:
        assert sorted(p[3] for p in parts if p[0] == name) == [1, 8]
    ledger.retain_ledger(spark, path, snap)
    led = ledger.read_compacted(spark, path, snap)
    assert ledger.ledger_offset_audit(led).count() == 9
    assert {(r["records"], r["events"]) for r in ledger.ledger_batch_totals(led).collect()} == {(3, 3)}


def test_a_commit_costs_no_spark_job(spark, scratch, topic):
    path = scratch("ledger")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    commits.mark_committed(spark, path, 0, 0, "a", date="2024-01-01")
    assert commits.is_committed(spark, path, 0, 0) and commits.settled(spark, path, 0, 1, "date", lambda: "x") == "x"
    assert commits.settled(spark, path, 0, 1, "date", lambda: "y") == "x" and commits.newest_after(spark, path, None) == (0, 0)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
