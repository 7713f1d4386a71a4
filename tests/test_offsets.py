"""Offset operators: repair truth table, ledger precedence, planning, reads."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import offsets
from tidemark.sources import kafka

BOUNDS = "topic STRING, partition INT, earliest BIGINT, latest BIGINT"
SAVED = "topic STRING, partition INT, offset BIGINT"


def _repair(spark, bounds, saved, strict=False):
    b = spark.createDataFrame(bounds, BOUNDS)
    s = spark.createDataFrame(saved, SAVED)
    return {r["partition"]: r for r in offsets.correct_offsets(b, s, strict).collect()}


def test_repair_truth_table(spark):
    # earliest 10, latest 20 everywhere
    bounds = [("t", p, 10, 20) for p in range(7)] + [("t", 7, 10, None)]
    saved = [
        # p0: no saved position -> 0 < earliest -> earliest
        ("t", 1, 5),    # below earliest -> earliest
        ("t", 2, 10),   # equal earliest -> saved
        ("t", 3, 15),   # inside -> saved
        ("t", 4, 20),   # equal latest -> saved
        ("t", 5, 21),   # above latest -> earliest
        ("t", 6, 0),
        ("t", 7, 12),   # latest missing -> treated as 0 -> too new -> earliest
        ("t", 99, 7),   # partition unknown to the topic -> disappears
    ]
    got = _repair(spark, bounds, saved)
    assert set(got) == set(range(8))
    start = {p: r["start_offset"] for p, r in got.items()}
    assert start == {0: 10, 1: 10, 2: 10, 3: 15, 4: 20, 5: 10, 6: 10, 7: 10}
    assert got[3]["repaired"] is False and got[5]["repaired"] is True
    assert got[0]["saved_offset"] == 0 and got[7]["latest"] == 0


def test_repair_strict_fails_on_missing_latest(spark):
    with pytest.raises(Exception):
        b = spark.createDataFrame([("t", 0, 1, None)], BOUNDS)
        s = spark.createDataFrame([("t", 0, 3)], SAVED)
        offsets.correct_offsets(b, s, strict=True).collect()


def test_saved_offsets_newest_epoch_wins(spark):
    ledger = spark.createDataFrame([
        ("j", "t", 0, 100, 0, 0), ("j", "t", 0, 250, 0, 1), ("j", "t", 0, 180, 0, 2),
        ("j", "t", 0, 40, 1, 0),            # repaired restart: moves backwards
        ("j", "t", 1, 70, 0, 5),
        ("k", "t", 0, 9, 3, 0),
    ], "job STRING, topic STRING, partition INT, until_offset BIGINT, epoch INT, batch_id BIGINT")
    got = {(r["job"], r["partition"]): r["offset"] for r in offsets.saved_offsets(ledger).collect()}
    assert got == {("j", 0): 40, ("j", 1): 70, ("k", 0): 9}


def test_typed_offsets_ansi(spark):
    raw = spark.createDataFrame([("t", "0", "12"), ("t", "1", None)],
                                "topic STRING, partition STRING, offset STRING")
    got = {r["partition"]: r["offset"] for r in offsets.typed_offsets(raw, default=0).collect()}
    assert got == {0: 12, 1: 0}
    for bad in ("12x", " 12", ""):
        junk = spark.createDataFrame([("t", "0", bad)], "topic STRING, partition STRING, offset STRING")
        with pytest.raises(Exception):
            offsets.typed_offsets(junk).collect()
    previous = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            offsets.typed_offsets(junk).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", previous)


def test_with_default(spark):
    known = spark.createDataFrame([("t", 0, 0, 9), ("t", 1, 0, 9), ("t", 2, 0, 9)], BOUNDS)
    saved = spark.createDataFrame([("t", 1, 4), ("t", 7, 3)], SAVED)
    got = {r["partition"]: r["offset"] for r in offsets.with_default(known, saved).collect()}
    assert got == {0: 0, 1: 4, 2: 0}


def test_plan_and_positioned_read(spark):
    bounds = spark.createDataFrame([("t", 0, 0, 100), ("t", 1, 0, 30)], BOUNDS)
    starts = spark.createDataFrame([("t", 0, 10), ("t", 1, 25)], "topic STRING, partition INT, start_offset BIGINT")
    ranges = offsets.plan_offset_ranges(starts, bounds, max_rate_per_partition=10, batch_seconds=5)
    got = {r["partition"]: (r["from_offset"], r["until_offset"]) for r in ranges.collect()}
    assert got == {0: (10, 60), 1: (25, 30)}
    records = spark.range(0, 100).select(
        F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"),
        F.expr("id div 2").alias("offset"), F.col("id").cast("string").alias("value"))
    read = offsets.positioned_read(records, ranges).collect()
    per = {}
    for r in read:
        per.setdefault(r["partition"], []).append(r["offset"])
    assert sorted(per[0]) == list(range(10, 50))      # partition 0 only has offsets < 50
    assert sorted(per[1]) == list(range(25, 30))       # half-open: 30 excluded


def test_positioned_read_broadcasts_checked_side(spark, capsys):
    ranges = spark.createDataFrame([("t", 0, 0, 5)], "topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT")
    records = spark.range(20).select(F.concat(F.lit("t"), F.expr("substr('', 1, id % 1)")).alias("topic"),
                                     F.expr("cast(id % 2 as int)").alias("partition"),
                                     F.expr("id div 2").alias("offset"))
    offsets.positioned_read(records, ranges).explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
    # beyond the bound: no broadcast hint, still correct
    got = offsets.positioned_read(records, ranges, max_broadcast_rows=0).count()
    assert got == 5


def test_offset_bounds_and_audit(spark):
    records = spark.createDataFrame([("t", 0, o) for o in range(3, 9)] + [("t", 1, 0)],
                                    "topic STRING, partition INT, offset BIGINT")
    b = {r["partition"]: (r["earliest"], r["latest"]) for r in offsets.offset_bounds(records).collect()}
    assert b == {0: (3, 9), 1: (0, 1)}
    a = {r["partition"]: (r["from_offset"], r["until_offset"], r["records"])
         for r in offsets.offset_range_audit(records).collect()}
    assert a == {0: (3, 9, 6), 1: (0, 1, 1)}


def test_starting_offsets_json(spark):
    starts = spark.createDataFrame([("a", 10, 5), ("a", 2, 7), ("b", 0, 1)],
                                   "topic STRING, partition INT, start_offset BIGINT")
    per = {r["topic"]: r["starting_offsets"] for r in offsets.starting_offsets_json(starts).collect()}
    assert per["a"] == '{"a":{"2":7,"10":5}}'
    whole = json.loads(offsets.starting_offsets_option(starts))
    assert whole == {"a": {"2": 7, "10": 5}, "b": {"0": 1}}


@pytest.mark.parametrize("text,seconds", [("5 seconds", 5), ("1 minute", 60), ("2 minutes", 120), ("500 milliseconds", 0.5),
                                          ("500 ms", 0.5), ("1 hour", 3600), ("1.5 sec", 1.5)])
def test_intervals_have_units(text, seconds):
    from tidemark.__main__ import interval_seconds
    assert interval_seconds(text) == pytest.approx(seconds)
    assert kafka.max_offsets_per_trigger(10, interval_seconds(text), 3) == max(1, int(30 * seconds))


@pytest.mark.parametrize("text", ["5", "five seconds", "3 fortnights", "", "0 seconds", "-1 second"])
def test_unknown_intervals_are_refused(text):
    from tidemark.__main__ import interval_seconds
    with pytest.raises(SystemExit):
        interval_seconds(text)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_decode_gives_the_utc_clock_in_any_session(spark, zone):
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = spark.sql("SELECT 't' AS topic, 0 AS partition, 0L AS offset, CAST(NULL AS BINARY) AS key, "
                        "CAST('x' AS BINARY) AS value, timestamp_micros(1704139200123456) AS timestamp")
        ts = kafka.decode(raw).selectExpr("cast(ts as string) AS t", "date_format(ts, 'yyyy-MM-dd') AS d").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    assert (ts["t"], ts["d"]) == ("2024-01-01 20:00:00.123456", "2024-01-01")


def test_kafka_options():
    o = kafka.reader_options("h:9092", topic="t", starting_offsets='{"t":{"0":5}}',
                             max_offsets=kafka.max_offsets_per_trigger(10, 5, 3))
    assert o["subscribe"] == "t" and o["maxOffsetsPerTrigger"] == "150"
    assert o["failOnDataLoss"] == "true"
    a = kafka.reader_options("h:9092", assign={"t": [1, 0]})
    assert a["assign"] == '{"t":[0,1]}' and a["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka.reader_options("h:9092", topic="t", reset_policy="none")
    with pytest.raises(ValueError):
        kafka.reader_options("h:9092")


def test_range_offsets_options_feed_a_positioned_kafka_read(spark):
    ranges = spark.createDataFrame([("t", 1, 5, 9), ("t", 0, 0, 3)],
                                   "topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT")
    start, end = offsets.range_offsets_options(ranges)
    assert json.loads(start) == {"t": {"0": 0, "1": 5}}
    assert json.loads(end) == {"t": {"0": 3, "1": 9}}
    opts = kafka.reader_options("h:9092", topic="t", starting_offsets=start, ending_offsets=end)
    assert opts["endingOffsets"] == end


def test_topic_records_keep_rows_with_null_keys(spark):
    from tidemark.sources import derive
    ev = spark.createDataFrame(
        [(1, "2024-01-01 00:00:01", None, "view"), (None, "2024-01-01 00:00:02", 3, "view"),
         (2, "2024-01-01 00:00:03", 8, "click"), (3, "2024-01-01 00:00:04", 3, "view")],
        "event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING"
    ).withColumn("ts", F.to_timestamp_ntz("ts"))
    got = sorted((r["partition"], r["offset"], r["key"]) for r in derive.topic_records(ev).collect())
    # partition 0: the NULL user (event 1) and user 8 (event 2); partition 3: NULL id first, then 3
    assert got == [(0, 0, "key-1"), (0, 1, "key-2"), (3, 0, None), (3, 1, "key-3")]


@pytest.mark.parametrize("block_size", [97, 1000])
def test_dense_offsets_across_many_blocks_match_row_number(spark, block_size):
    """Offsets built from per-block running sums equal a plain per-partition
    row_number (computed by DuckDB) when partitions span many blocks."""
    import duckdb
    from tidemark.sources import derive, tables
    sf = "/root/testdata/sf0.01"
    ev = tables.load(spark, sf, "events", ["event_id", "ts", "user_id", "event_type"])
    got = sorted((r["partition"], r["offset"], r["key"]) for r in
                 derive.topic_records(ev, block_size=block_size).select("partition", "offset", "key").collect())
    want = sorted(duckdb.sql(f"""
        SELECT CAST(((user_id % 8) + 8) % 8 AS INTEGER) AS p,
               row_number() OVER (PARTITION BY ((user_id % 8) + 8) % 8 ORDER BY event_id) - 1 AS o,
               'key-' || CAST(event_id AS VARCHAR) AS k
        FROM read_parquet('{sf}/events.parquet')""").fetchall())
    assert got == want


def test_saved_offsets_random_ledgers_match_model(spark):
    import random
    rng = random.Random(5)
    rows = []
    for key in range(300):
        for _ in range(rng.randint(1, 8)):
            rows.append(("j", "t", key, rng.randint(0, 1000), rng.randint(0, 3), rng.randint(0, 6)))
    ledger = spark.createDataFrame(
        rows, "job STRING, topic STRING, partition INT, until_offset BIGINT, epoch INT, batch_id BIGINT")
    got = {r["partition"]: r["offset"] for r in offsets.saved_offsets(ledger).collect()}
    want = {}
    for key in {r[2] for r in rows}:
        mine = [r for r in rows if r[2] == key]
        newest = max(r[4] for r in mine)
        want[key] = max(r[3] for r in mine if r[4] == newest)
    assert got == want


def test_correct_offsets_random_cases_match_model(spark):
    import random
    rng = random.Random(9)
    bounds, saved, model = [], [], {}
    for p in range(500):
        earliest = rng.randint(0, 100)
        latest = None if rng.random() < 0.1 else earliest + rng.randint(0, 100)
        bounds.append(("t", p, earliest, latest))
        s = None if rng.random() < 0.2 else rng.randint(-5, (latest or earliest) + 10)
        if s is not None:
            saved.append(("t", p, s))
        s0, l0 = (s if s is not None else 0), (latest if latest is not None else 0)
        model[p] = earliest if (s0 > l0 or s0 < earliest) else s0
    got = _repair(spark, bounds, saved)
    assert {p: r["start_offset"] for p, r in got.items()} == model


def test_launcher_arguments():
    from tidemark.__main__ import parse_args
    a = parse_args(["ingest", "b1:9092,b2:9092", "events", "kafka_db", "landing",
                    "--max-rate-per-partition", "10", "--partitions", "3"])
    assert (a.job, a.brokers, a.topic, a.database, a.table, a.date_mode) == \
        ("ingest", "b1:9092,b2:9092", "events", "kafka_db", "landing", "batch")
    assert a.max_rate_per_partition == 10 and a.partitions == 3 and not a.hive and a.bounds is None
    b = parse_args(["ingest", "b:9092", "events", "db", "t", "--bounds", "/x", "--hive"])
    assert b.hive and b.bounds == "/x"
    m = parse_args(["maintain", "events", "db", "t"])
    assert (m.job, m.topic, m.database, m.table) == ("maintain", "events", "db", "t")
    with pytest.raises(SystemExit):
        parse_args(["positions", "b:9092", "events", "--trigger", "soon"])
    c = parse_args(["counters", "b:9092", "access_log", "--trigger", "10 seconds",
                    "--compact-every", "720"])
    assert (c.job, c.trigger, c.compact_every) == ("counters", "10 seconds", 720)
    with pytest.raises(SystemExit):
        parse_args(["ingest", "b:9092", "events"])          # database and table required


def test_kafka_decode_on_source_shaped_rows(spark):
    """Rows shaped like the Kafka source's output decode to the columns every
    job consumes, and the ledger aggregation runs on them."""
    import datetime as dt
    from tidemark.streaming.ledger import batch_ledger_rows, ledger_pv
    raw = spark.createDataFrame(
        [(b"key-1", b"2024-01-01T10:00:00|~|x|~|/p?uid=u1&sid=s1", "events", 0, 7,
          dt.datetime(2024, 1, 1, 10, 0, 0), 0),
         (None, None, "events", 1, 3, dt.datetime(2024, 1, 1, 10, 0, 1), 0)],
        "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
        "timestamp TIMESTAMP, timestampType INT")
    dec = kafka.decode(raw)
    assert dec.columns == list(kafka.DECODED_COLUMNS)
    assert dict(dec.dtypes) == {"topic": "string", "partition": "int", "offset": "bigint",
                                "key": "string", "value": "string", "ts": "timestamp_ntz"}
    rows = batch_ledger_rows(dec, 0, 0)
    assert [tuple(r) for r in ledger_pv(rows).collect()] == [("2024-01-01-10", 1)]
    got = {r["partition"]: (r["from_offset"], r["until_offset"]) for r in
           rows.where("metric = 'offset'").collect()}
    assert got == {0: (7, 8), 1: (3, 4)}       # the tombstone still advances its partition


def test_ranges_reader_options(spark):
    ranges = spark.createDataFrame([("t", 1, 5, 9), ("t", 0, 0, 3), ("u", 2, 4, 4)],
                                   "topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT")
    o = kafka.ranges_reader_options("h:9092", ranges)
    assert json.loads(o["assign"]) == {"t": [0, 1], "u": [2]}
    assert json.loads(o["startingOffsets"]) == {"t": {"0": 0, "1": 5}, "u": {"2": 4}}
    assert json.loads(o["endingOffsets"]) == {"t": {"0": 3, "1": 9}, "u": {"2": 4}}
    assert o["failOnDataLoss"] == "true" and "subscribe" not in o
