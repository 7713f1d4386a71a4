"""Streaming jobs: crash after a batch's write + restart gives exact totals;
batch date survives replay; epochs; batch == stream."""

import pytest
from pyspark.sql import functions as F

from tidemark import queries as q
from tidemark.operators import metrics, parse
from tidemark.plans import ingest, traffic
from tidemark.sources import files, fs, scenarios
from tidemark.streaming import commits, counters, ledger
from tidemark.streaming.runner import read_epoch, run_available, run_batches

SF = "/root/testdata/sf0.01"
VIEWS = (ledger.ledger_pv, ledger.ledger_site_pv, ledger.ledger_uv, ledger.ledger_uv_members,
         ledger.ledger_positions, ledger.ledger_offset_audit, ledger.ledger_batch_totals)


@pytest.fixture(scope="module")
def topic(spark):
    """The landed topic, once for all tests (it is only read)."""
    return q._landed_topic(spark, SF)


def _stream(spark, path):
    return files.record_stream(spark, path, files.FILES_PER_BAND)


def _crash_traffic(spark, topic, path, cp, crash=2, unmark=True, resume=True, **options):
    return scenarios.run_with_crash(lambda: _stream(spark, topic), lambda: traffic.traffic_job(spark, path, cp, **options),
                                    cp, crash, *([path] if unmark else []), resume=resume)


def _crash_ingest(spark, topic, land, path, cp, crash=2, unmark=True, resume=True, **options):
    return scenarios.run_with_crash(lambda: _stream(spark, topic), lambda: ingest.ingest_job(spark, land, path, cp, **options),
                                    cp, crash, *([land, path] if unmark else []), resume=resume)


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("unmark", [True, False])
def test_traffic_job_exactly_once_after_crash(spark, scratch, topic, unmark):
    path, cp = scratch("ledger"), scratch("cp")
    assert _crash_traffic(spark, topic, path, cp, unmark=unmark)
    led = ledger.read_ledger(spark, path)
    batch = parse.parse_log(q._access_log(spark, SF))
    _same(ledger.ledger_pv(led), metrics.pv_by_hour(batch))
    _same(ledger.ledger_uv(led), metrics.uv_by_day(batch))
    # one batch for each band, and batch 2 exists exactly once
    assert led.where("metric = 'offset'").select("batch_id").distinct().count() == 5


def test_bands_are_even_and_batches_contiguous(spark, scratch, topic):
    sizes = q._records(spark, SF)
    from tidemark.sources import derive
    per = derive.offset_bands(sizes).groupBy("partition", "band").count()
    spread = per.groupBy("partition").agg((F.max("count") - F.min("count")).alias("d"), F.count("*").alias("n")).collect()
    assert all(r["d"] <= 1 and r["n"] == 5 for r in spread)
    path = scratch("ledger")
    traffic.start_traffic_job(spark, _stream(spark, topic), path, scratch("cp"))
    audit = q._contiguous(ledger.ledger_offset_audit(ledger.read_ledger(spark, path))).collect()
    assert all(r["gaps"] == 0 and r["from_offset"] == 0 and r["records"] == r["until_offset"] for r in audit)


def test_new_checkpoint_opens_new_epoch(spark, scratch, topic):
    path = scratch("ledger")
    cp1, cp2 = scratch("cp1"), scratch("cp2")
    traffic.start_traffic_job(spark, _stream(spark, topic), path, cp1)
    traffic.start_traffic_job(spark, _stream(spark, topic), path, cp2)
    assert (read_epoch(spark, cp1), read_epoch(spark, cp2)) == (0, 1)
    # the second checkpoint re-read the topic: its epoch holds a full count
    led = ledger.read_ledger(spark, path).where("metric = 'pv' AND epoch = 1")
    assert led.agg(F.sum("delta")).first()[0] == parse.parse_log(q._access_log(spark, SF)).count()
    pos = {r["partition"]: r["offset"] for r in ledger.ledger_positions(ledger.read_ledger(spark, path)).collect()}
    sizes = {r["partition"]: r["n"] for r in q._records(spark, SF).groupBy("partition").agg(F.count("*").alias("n")).collect()}
    assert pos == sizes


def test_batch_date_is_stable_across_replay(spark, scratch, topic):
    land, path, cp = scratch("landing"), scratch("ledger"), scratch("cp")
    clock = iter(["2024-05-01", "2024-05-02", "2024-05-03", "2024-05-04", "2024-05-05",
                  "2024-05-06", "2024-05-07", "2024-05-08", "2024-05-09", "2024-05-10"])
    assert _crash_ingest(spark, topic, land, path, cp, date_mode="batch", clock=lambda: next(clock))
    landed = ingest.read_landing(spark, land)
    assert landed.count() == q._access_log(spark, SF).count()
    # one date per batch; the replayed batch kept its first date
    per_batch = (commits.only_committed(spark, spark.read.schema(ingest.LANDED_SCHEMA).parquet(land), land)
                 .groupBy("batch_id").agg(F.countDistinct("pd").alias("d")).collect())
    assert all(r["d"] == 1 for r in per_batch)
    dates = sorted(r["pd"] for r in landed.select("pd").distinct().collect())
    assert len(dates) == len(per_batch)


def test_stream_equals_batch(spark, scratch, topic):
    out = scratch("out")
    run_available(counters.complete_to_table(
        counters.running_site_pv_by_hour(_stream(spark, topic)), out)
        .option("checkpointLocation", scratch("cp")))
    want = metrics.site_pv_by_hour(parse.parse_log(q._access_log(spark, SF)))
    _same(counters.read_complete(spark, out, want.schema), want)


def test_uv_with_watermark_matches_when_in_order(spark, scratch, topic):
    out = scratch("out")
    run_available(counters.complete_to_table(
        counters.running_uv_by_day(_stream(spark, topic), watermark="2 days"), out)
        .option("checkpointLocation", scratch("cp")))
    got = {r["day"]: r["uv"] for r in counters.read_complete(spark, out, "day STRING, uv BIGINT").collect()}
    want = {r["day"]: r["uv"] for r in metrics.uv_by_day(parse.parse_log(q._access_log(spark, SF))).collect()}
    assert got == want


def test_checkpoint_only_positions_new_checkpoint_keeps_old_data(spark, scratch, topic):
    """Without ledger positions, a second checkpoint still gets a new epoch and
    lands alongside the first run instead of overwriting it."""
    land, path = scratch("landing"), scratch("ledger")
    ingest.start_ingest_job(spark, _stream(spark, topic), land, path, scratch("cp1"),
                            write_positions=False)
    ingest.start_ingest_job(spark, _stream(spark, topic), land, path, scratch("cp2"),
                            write_positions=False)
    n = q._access_log(spark, SF).count()
    assert ingest.read_landing(spark, land).count() == 2 * n


def test_live_source_options_seed_new_checkpoint_from_ledger(spark, scratch, topic):
    import json
    from tidemark.plans import live, positions
    path, cp = scratch("ledger"), scratch("cp")
    # nothing saved yet: reset policy
    opts = live.source_options(spark, "h:9092", "events", path, scratch("new"))
    assert opts["startingOffsets"] == "earliest"
    positions.start_positions_job(spark, _stream(spark, topic), path, cp)
    sizes = {str(r["partition"]): r["n"] for r in
             q._records(spark, SF).groupBy("partition").agg(F.count("*").alias("n")).collect()}
    # a new checkpoint starts where the ledger says
    opts = live.source_options(spark, "h:9092", "events", path, scratch("new2"), partitions=10)
    assert json.loads(opts["startingOffsets"]) == {"events": sizes | {"8": -2, "9": -2}}   # every partition
    with pytest.raises(ValueError, match="bounds"):
        live.source_options(spark, "h:9092", "events", path, scratch("new2"))
    # with bounds: positions past the end are repaired to earliest
    bounds = spark.createDataFrame([("events", int(p), 5, n - 1) for p, n in sizes.items()],
                                   "topic STRING, partition INT, earliest BIGINT, latest BIGINT")
    opts = live.source_options(spark, "h:9092", "events", path, scratch("new3"), bounds=bounds)
    assert json.loads(opts["startingOffsets"]) == {"events": {p: 5 for p in sizes}}
    # the running checkpoint keeps its own positions
    assert live.source_options(spark, "h:9092", "events", path, cp)["startingOffsets"] == "earliest"


def test_out_of_range_positions_open_next_checkpoint_generation(spark, scratch, topic):
    import json
    from tidemark.plans import live, positions
    path, root = scratch("ledger"), scratch("cps")
    assert live.choose_checkpoint(spark, root, path, "events").endswith("/epoch=0")
    cp = live.choose_checkpoint(spark, root, path, "events")
    positions.start_positions_job(spark, _stream(spark, topic), path, cp)
    sizes = {r["partition"]: r["n"] for r in
             q._records(spark, SF).groupBy("partition").agg(F.count("*").alias("n")).collect()}
    ok = spark.createDataFrame([("events", p, 0, n) for p, n in sizes.items()],
                               "topic STRING, partition INT, earliest BIGINT, latest BIGINT")
    assert live.choose_checkpoint(spark, root, path, "events", ok) == cp
    # retention moved past partition 0's saved position
    moved = spark.createDataFrame([("events", p, (n + 5 if p == 0 else 0), n + 10) for p, n in sizes.items()],
                                  "topic STRING, partition INT, earliest BIGINT, latest BIGINT")
    nxt = live.choose_checkpoint(spark, root, path, "events", moved)
    assert nxt.endswith("/epoch=1")
    start = json.loads(live.source_options(spark, "h:9092", "events", path, nxt, bounds=moved)["startingOffsets"])
    assert start["events"]["0"] == sizes[0] + 5          # repaired to earliest
    assert start["events"]["1"] == sizes[1]              # still valid: resumes there


def test_empty_topic_gives_empty_results(spark, scratch):
    empty = scratch("empty_topic")
    spark.createDataFrame([], files.RECORD_SCHEMA + ", slice INT").write.parquet(empty)
    path, land = scratch("ledger"), scratch("landing")
    traffic.start_traffic_job(spark, files.record_stream(spark, empty), path, scratch("cp1"))
    assert ledger.ledger_pv(ledger.read_ledger(spark, path)).count() == 0
    ingest.start_ingest_job(spark, files.record_stream(spark, empty), land, path, scratch("cp2"))
    assert ingest.read_landing(spark, land).count() == 0
    out = scratch("out")
    run_available(counters.complete_to_table(
        counters.running_pv_by_hour(files.record_stream(spark, empty)), out)
        .option("checkpointLocation", scratch("cp3")))
    assert counters.read_complete(spark, out, "hour STRING, pv BIGINT").count() == 0


def test_ledger_compaction_and_retention_keep_every_view(spark, scratch, topic):
    path, snap = scratch("ledger"), scratch("snapshot")
    assert ledger.compact_ledger(spark, path, snap) is None and ledger.retain_ledger(spark, path, snap) == 0
    # two checkpoints (epochs 0 and 1) over the same topic, compaction in between
    traffic.start_traffic_job(spark, _stream(spark, topic), path, scratch("cp1"), snapshot_path=snap)
    first = ledger.compact_ledger(spark, path, snap)
    assert first == (0, 4)
    traffic.start_traffic_job(spark, _stream(spark, topic), path, scratch("cp2"), snapshot_path=snap)
    want = [view(ledger.read_ledger(spark, path)).checkpoint() for view in VIEWS]
    for step in (lambda: None, lambda: ledger.compact_ledger(spark, path, snap), lambda: ledger.retain_ledger(spark, path, snap)):
        step()
        seen = ledger.read_compacted(spark, path, snap)
        for view, rows in zip(VIEWS, want):
            _same(view(seen), rows)
        _same(ledger.saved_positions(spark, path, snap), want[4])
    assert ledger.snapshot_watermark(spark, snap) == (1, 4)
    assert ledger.compact_ledger(spark, path, snap) == (1, 4)     # nothing new
    # retention stays one manifest behind: the batches of the second checkpoint are still there
    assert {fs.partition_of(f)["epoch"] for f in fs.folders(spark, f"{path}/metric=*/epoch=*/batch_id=*")} == {"1"}
    assert ledger.max_epoch(spark, path, snap) == 1
    # two full passes were counted
    one = metrics.pv_by_hour(parse.parse_log(q._access_log(spark, SF))).agg(F.sum("pv")).first()[0]
    assert ledger.ledger_pv(ledger.read_compacted(spark, path, snap)).agg(F.sum("pv")).first()[0] == 2 * one


def test_compaction_writes_only_the_days_that_change(spark, scratch):
    recs = q._records(spark, SF)
    path, snap = scratch("ledger"), scratch("snapshot")
    days = [r[0] for r in recs.select(F.date_format("ts", "yyyy-MM-dd").alias("d")).distinct().orderBy("d").limit(3).collect()]
    for b, day in enumerate(days + days[:1]):
        ledger.write_ledger(ledger.batch_ledger_rows(recs.where(F.date_format("ts", "yyyy-MM-dd") == day), 0, b), path)
        commits.mark_committed(spark, path, 0, b)
        ledger.compact_ledger(spark, path, snap)
    written = {(a["day"], int(a["part"].split("-")[0])) for f in fs.folders(spark, f"{snap}/rows/part=*/metric=uv/day=*")
               if (a := fs.partition_of(f))}
    assert written == {(days[0], 0), (days[1], 1), (days[2], 2), (days[0], 3)}
    _same(ledger.ledger_uv(ledger.read_compacted(spark, path, snap)), ledger.ledger_uv(ledger.read_ledger(spark, path)))
    ledger.retain_ledger(spark, path, snap)   # two newest manifests stay
    assert len(fs.folders(spark, f"{snap}/manifest/generation=*")) == 2
    _same(ledger.ledger_uv(ledger.read_compacted(spark, path, snap)),
          metrics.uv_by_day(parse.parse_log(recs.where(F.date_format("ts", "yyyy-MM-dd").isin(days)))))


def test_snapshot_reads_prune_by_metric(spark, scratch, topic, capsys):
    path, snap = scratch("ledger"), scratch("snapshot")
    traffic.start_traffic_job(spark, _stream(spark, topic), path, scratch("cp"))
    ledger.compact_ledger(spark, path, snap)
    ledger.ledger_pv(ledger.read_compacted(spark, path, snap)).explain()
    plan = capsys.readouterr().out
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("metric" in f.split("PartitionFilters: [")[1].split("]")[0] for f in filters), plan


def test_batches_without_their_marker_stay_out(spark, scratch):
    """Parts of a batch become visible one by one: readers and compactions
    take it whole or not at all, for the ledger and for landed data."""
    recs = q._records(spark, SF).where("offset < 400")
    land, comp, path, snap = scratch("landing"), scratch("compacted"), scratch("ledger"), scratch("snapshot")
    whole = ledger.batch_ledger_rows(recs, 0, 0).checkpoint()
    rows = [("a", "2024-01-01", 0, 0), ("b", "2024-01-01", 0, 1), ("c", "2024-01-02", 0, 1)]

    def land_part(i):
        record, pd, epoch, batch = rows[i]
        ingest.write_landed(spark.createDataFrame([(record, pd)], "record STRING, pd STRING"), land, epoch, batch)

    def landed():
        return sorted(r["record"] for r in ingest.read_landing_compacted(spark, land, comp).collect())
    land_part(0)
    commits.mark_committed(spark, land, 0, 0)
    land_part(1)                                        # first date of batch 1
    assert landed() == ["a"] and ingest.compact_landing(spark, land, comp) == (0, 0)
    land_part(2)                                        # second date of batch 1
    assert landed() == ["a"]
    commits.mark_committed(spark, land, 0, 1)
    assert landed() == ["a", "b", "c"]
    assert ingest.compact_landing(spark, land, comp) == (0, 1) and landed() == ["a", "b", "c"]
    assert ingest.retain_landing(spark, land, comp) > 0 and landed() == ["a", "b", "c"]
    assert {fs.partition_of(f)["batch_id"] for f in fs.folders(spark, f"{land}/pd=*/epoch=*/batch_id=*")} == {"1"}

    ledger.write_ledger(whole.where("metric = 'pv'"), path)
    assert ledger.compact_ledger(spark, path, snap) is None
    assert ledger.read_compacted(spark, path, snap).count() == 0
    ledger.write_ledger(whole.where("metric <> 'pv'"), path)
    commits.mark_committed(spark, path, 0, 0)
    assert ledger.compact_ledger(spark, path, snap) == (0, 0)
    for view in VIEWS:
        _same(view(ledger.read_compacted(spark, path, snap)), view(whole))


def test_an_unreadable_ledger_fails_the_job(spark, scratch, topic):
    """No read error may look like "nothing saved": the job would start over."""
    from tidemark.plans import live
    path, cp = scratch("ledger"), scratch("cp")
    traffic.start_traffic_job(spark, _stream(spark, topic), path, cp)
    folder = fs.folders(spark, f"{path}/metric=offset/epoch=0/batch_id=4/attempt=*")[0].removeprefix("file:")
    import glob
    for f in glob.glob(folder + "/*.parquet"):
        with open(f, "wb") as out:
            out.write(b"not parquet")
    for f in glob.glob(folder + "/.*.crc"):
        with open(f, "wb") as out:
            out.write(b"")
    with pytest.raises(Exception):
        live.saved_positions(spark, path, "events")
    with pytest.raises(Exception):
        live.source_options(spark, "h:9092", "events", path, scratch("new"), partitions=8)


def test_restarts_keep_one_checkpoint_generation(spark, scratch, topic):
    """With landed data but no ledger, the next generation is opened once and
    then resumed; its folder names its epoch."""
    from tidemark.plans import live
    land, path, root = scratch("landing"), scratch("ledger"), scratch("cps")
    ingest.start_ingest_job(spark, _stream(spark, topic), land, path, f"{root}/epoch=0", write_positions=False)
    n = q._access_log(spark, SF).count()
    fs.remove(spark, f"{root}/epoch=0")
    fs.remove(spark, f"{root}/epoch=0_epoch")
    for _ in range(3):
        cp = live.choose_checkpoint(spark, root, path, "events", newest=ingest.newest_epoch(spark, land, path))
        assert cp == f"{root}/epoch=1"
        live._opened(spark, cp, ingest.newest_epoch(spark, land, path))
        ingest.start_ingest_job(spark, _stream(spark, topic), land, path, cp, write_positions=False)
        assert read_epoch(spark, cp) == 1
        assert ingest.read_landing(spark, land).count() == 2 * n
    with pytest.raises(ValueError, match="reuse"):
        live._opened(spark, f"{root}/other/epoch=1", 1)


def test_launcher_repairs_positions_first(spark, scratch, topic):
    """From parsed arguments: bounds that moved past a saved position open the
    next generation, seeded at the repaired positions."""
    import json
    from tidemark import __main__ as launcher
    from tidemark.plans import live, positions
    root, bounds = scratch("root"), scratch("bounds")
    args = launcher.parse_args(["positions", "h:9092", "events", "--root", root, "--bounds", bounds])
    sizes = {r["partition"]: r["n"] for r in q._records(spark, SF).groupBy("partition").agg(F.count("*").alias("n")).collect()}
    schema = "topic STRING, partition INT, earliest BIGINT, latest BIGINT"
    spark.createDataFrame([("events", p, 0, n) for p, n in sizes.items()], schema).write.parquet(bounds)
    at, cp, options = launcher.prepared(spark, args, root)
    assert cp == f"{at.checkpoints}/epoch=0"
    positions.start_positions_job(spark, _stream(spark, topic), at.ledger, cp, snapshot_path=at.snapshot)
    assert launcher.prepared(spark, args, root)[1] == cp          # in range: resumed
    assert launcher.maintain(spark, args, root) == 0              # all of the ledger is covered, for one compaction
    assert launcher.prepared(spark, args, root)[1] == cp
    (spark.createDataFrame([("events", p, n + 5 if p == 0 else 0, n + 10) for p, n in sizes.items()] + [("events", 8, 3, 9)], schema)
     .write.mode("overwrite").parquet(bounds))
    at, cp, options = launcher.prepared(spark, args, root)
    assert cp == f"{at.checkpoints}/epoch=1"
    start = json.loads(live.source_options(spark, "h:9092", "events", at.ledger, cp, options["bounds"],
                                           snapshot_path=at.snapshot)["startingOffsets"])["events"]
    assert start == {str(p): (n + 5 if p == 0 else n) for p, n in sizes.items()} | {"8": 3}


def test_update_log_of_two_checkpoints(spark, scratch):
    counts = metrics.pv_by_hour(parse.parse_log(q._records(spark, SF))).checkpoint()
    log = scratch("updates")
    counters.write_update_batch(counts.withColumn("pv", F.col("pv") - 1), 9, log, epoch=0)
    assert counters.log_epoch(spark, log) == 0
    counters.write_update_batch(counts, 0, log, epoch=1)           # a new checkpoint counts from batch 0

    def latest():
        return counters.latest_values(counters.read_update_log(spark, log, counts.schema), ["hour"], ["pv"])
    _same(latest(), counts)
    assert counters.compact_update_log(spark, log, counts.schema, ["hour"], ["pv"]) == 1
    _same(latest(), counts)


def test_complete_output_survives_a_crash_in_the_middle(spark, scratch):
    out = scratch("out")
    one = spark.createDataFrame([("h", 1)], "hour STRING, pv BIGINT")
    body = []

    class Writer:
        def outputMode(self, _):
            return self

        def foreachBatch(self, fn):
            body.append(fn)

    class Result:
        writeStream = Writer()
    counters.complete_to_table(Result(), out)
    for b in range(5):
        body[0](one.withColumn("pv", F.lit(b).cast("bigint")), b)
    assert counters.read_complete(spark, out, one.schema).first()["pv"] == 4
    one.write.parquet(f"{out}/version=5")                          # written, not marked
    assert counters.read_complete(spark, out, one.schema).first()["pv"] == 4
    assert len(fs.folders(spark, f"{out}/version=*")) <= 4


@pytest.mark.parametrize("crash_after", [0, 4])
def test_ledger_exact_for_crash_at_first_and_last_batch(spark, scratch, topic, crash_after):
    path, cp = scratch("ledger"), scratch("cp")
    assert _crash_traffic(spark, topic, path, cp, crash=crash_after)
    led = ledger.read_ledger(spark, path)
    batch = parse.parse_log(q._access_log(spark, SF))
    want = {r["site_id"] + r["hour"]: r["pv"] for r in metrics.site_pv_by_hour(batch).collect()}
    got = {r["site_id"] + r["hour"]: r["pv"] for r in ledger.ledger_site_pv(led).collect()}
    assert got == want
    audit = ledger.ledger_offset_audit(led)
    assert audit.agg(F.sum("records")).first()[0] == q._access_log(spark, SF).count()


def test_landing_output_is_queryable_by_name(spark, scratch, topic):
    """A view over the folders: current without a statement for each batch,
    also through compaction and retention."""
    from tidemark.operators import landing
    land, path, comp = scratch("landing"), scratch("ledger"), scratch("compacted")
    db = landing.create_database(spark)
    table, cp = f"{db}.landing", scratch("cp")
    assert ingest.register_landing(spark, table, land, comp) == table
    n = q._access_log(spark, SF).count()
    name = landing.quote_ident(table)

    def count(where="true"):
        for t in ("batches", "commits"):
            spark.catalog.refreshTable(f"{table}_{t}")
        return spark.sql(f"SELECT count(*) FROM {name} WHERE {where}").first()[0]
    assert count() == 0
    _crash_ingest(spark, topic, land, path, cp)
    assert count() == n and spark.table(table).columns == ["record", "pd"]
    assert 0 < count("pd = '2024-01-05'") < n
    ingest.compact_landing(spark, land, comp)
    assert count() == n                                   # the old view still holds
    ingest.register_landing(spark, table, land, comp)
    assert ingest.retain_landing(spark, land, comp) == 0   # the only compaction may still be unknown to a reader
    assert count() == n
    ingest.start_ingest_job(spark, _stream(spark, topic), land, path, scratch("cp2"), table=table, compacted_path=comp)
    for t in ("batches", "commits"):
        spark.catalog.refreshTable(f"{table}_{t}")
    assert count() == 2 * n
    ingest.compact_landing(spark, land, comp)
    assert ingest.retain_landing(spark, land, comp) > 0
    assert count() == 2 * n                               # a view one compaction behind
    ingest.register_landing(spark, table, land, comp)
    assert count() == 2 * n


def test_unique_users_on_rocksdb_state(spark, scratch, topic):
    out = scratch("out")
    result = counters.running_uv_by_day(_stream(spark, topic))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    run_available(counters.complete_to_table(result, out).option("checkpointLocation", scratch("cp")),
                  spark=spark, state_partitions=4, state_store="rocksdb")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    got = {r["day"]: r["uv"] for r in counters.read_complete(spark, out, "day STRING, uv BIGINT").collect()}
    want = {r["day"]: r["uv"] for r in metrics.uv_by_day(parse.parse_log(q._access_log(spark, SF))).collect()}
    assert got == want


def test_sinks_are_idempotent_under_replay(spark, scratch):
    """Writing the same batch twice (a replay after a crash) leaves the same
    result as writing it once: ledger, update log and rejects."""
    recs = q._records(spark, SF).where("offset < 500")
    path = scratch("ledger")
    for _ in range(2):
        ledger.write_ledger(ledger.batch_ledger_rows(recs, 0, 7), path)
    once = scratch("ledger_once")
    ledger.write_ledger(ledger.batch_ledger_rows(recs, 0, 7), once)
    for out in (path, once):
        commits.mark_committed(spark, out, 0, 7)
    for view in (ledger.ledger_pv, ledger.ledger_uv, ledger.ledger_positions):
        a, b = view(ledger.read_ledger(spark, path)), view(ledger.read_ledger(spark, once))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    counts = metrics.pv_by_hour(parse.parse_log(recs))
    log = scratch("updates")
    for _ in range(2):                      # update-mode body, batch 3 replayed
        counters.write_update_batch(counts, 3, log)
    latest = counters.latest_values(counters.read_update_log(spark, log, counts.schema), ["hour"], ["pv"])
    assert latest.exceptAll(counts).count() == 0 and counts.exceptAll(latest).count() == 0

    rej = scratch("rejects")
    for _ in range(2):
        traffic.write_rejects(recs, rej, 0, 7)
    assert traffic.read_rejects(spark, rej).count() == parse.parse_rejects(recs).count()


def test_counters_job_compacts_its_ledger(spark, scratch, topic):
    path, snap = scratch("ledger"), scratch("snapshot")
    _crash_traffic(spark, topic, path, scratch("cp"), snapshot_path=snap, compact_every=2)
    assert ledger.snapshot_watermark(spark, snap) == (0, 3)
    full, folded = ledger.read_ledger(spark, path), ledger.read_compacted(spark, path, snap)
    for view in VIEWS:
        _same(view(full), view(folded))


def test_landing_compaction_is_incremental_and_whole(spark, scratch, topic):
    land, path, comp, cp = scratch("landing"), scratch("ledger"), scratch("compacted"), scratch("cp")
    assert ingest.compact_landing(spark, land, comp) is None
    _crash_ingest(spark, topic, land, path, cp, resume=False)
    first = ingest.compact_landing(spark, land, comp)       # covers batches 0 and 1; 2 is not whole
    ingest.start_ingest_job(spark, _stream(spark, topic), land, path, cp)
    second = ingest.compact_landing(spark, land, comp)
    assert (first, second) == ((0, 1), (0, 4))
    assert ingest.compact_landing(spark, land, comp) == second            # nothing new
    assert len(fs.folders(spark, f"{comp}/rows/part=*")) == 2
    want = ingest.read_landing(spark, land).checkpoint()
    assert want.count() == q._access_log(spark, SF).count()
    _same(ingest.read_landing_compacted(spark, land, comp), want)
    ingest.retain_landing(spark, land, comp)
    left = {int(fs.partition_of(f)["batch_id"]) for f in fs.folders(spark, f"{land}/pd=*/epoch=*/batch_id=*")}
    assert left == {2, 3, 4}                              # what the first compaction covers is gone
    _same(ingest.read_landing_compacted(spark, land, comp), want)
    assert ingest.newest_epoch(spark, land, path, comp) == 0


@pytest.mark.parametrize("crash_after", [0, 4])
def test_ingest_exact_for_crash_at_first_and_last_batch(spark, scratch, topic, crash_after):
    land, path, cp = scratch("landing"), scratch("ledger"), scratch("cp")
    assert _crash_ingest(spark, topic, land, path, cp, crash=crash_after)
    got = ingest.read_landing(spark, land)
    want = q._access_log(spark, SF).select(F.col("value").alias("record"),
                                           F.date_format("ts", "yyyy-MM-dd").alias("pd"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
