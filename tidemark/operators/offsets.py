"""Consumer positions as tables.

A position is a row ``(topic, partition, offset)``: the next offset to read.
The operators here replace a key-value store of positions with ordinary Spark
tables, so positions can be audited, repaired and planned with joins and
aggregates:

* :func:`offset_bounds`      earliest / latest (next to be written) per partition
* :func:`offset_range_audit` per-batch ``[from, until)`` report of what was read
* :func:`ledger_offset_rows` batch ranges -> rows of the offset ledger
* :func:`saved_offsets`      current position per ``(job, topic, partition)``
* :func:`with_default`       known partitions without a saved position start at 0
* :func:`typed_offsets`      string positions -> ``INT`` / ``BIGINT`` (ANSI: junk raises)
* :func:`correct_offsets`    repair saved positions against the bounds
* :func:`plan_offset_ranges` rate-limited ``[from, until)`` per partition
* :func:`positioned_read`    records inside planned ranges
* :func:`starting_offsets_json` positions in the JSON form a Kafka source takes
* :func:`range_offsets_options` planned ranges as ``startingOffsets`` / ``endingOffsets``
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, materialize_small

KEY = ["topic", "partition"]


def offset_bounds(records: DataFrame) -> DataFrame:
    """``(topic, partition, earliest, latest)``; ``latest`` is one past the last
    record, i.e. the offset the next record will get."""
    return records.groupBy(*KEY).agg(
        F.min("offset").alias("earliest"),
        (F.max("offset") + 1).alias("latest"))


def offset_range_audit(records: DataFrame, batch_cols: tuple[str, ...] = ()) -> DataFrame:
    """``(*batch_cols, topic, partition, from_offset, until_offset, records)``.

    What each batch read from each partition, half-open.  Grouped by column
    values, never by task index, so it is independent of how tasks were laid out.
    """
    return records.groupBy(*batch_cols, *KEY).agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
        F.count(F.lit(1)).alias("records"))


def ledger_offset_rows(audit: DataFrame, job: str | None = None,
                       epoch: int | None = None, batch_col: str | None = None) -> DataFrame:
    """Audit rows -> offset-ledger rows ``(job, topic, partition, until_offset,
    epoch, batch_id)``.  ``job`` / ``epoch`` default to existing columns."""
    return audit.select(
        (F.lit(job) if job is not None else F.col("job")).alias("job"),
        "topic", F.col("partition").cast("int").alias("partition"),
        F.col("until_offset").cast("bigint").alias("until_offset"),
        (F.lit(epoch) if epoch is not None else F.col("epoch")).cast("int").alias("epoch"),
        F.col(batch_col or "batch_id").cast("bigint").alias("batch_id"))


def saved_offsets(ledger: DataFrame, keys: tuple[str, ...] = ("job",)) -> DataFrame:
    """``(*keys, topic, partition, offset)``: the current saved position.

    The last write wins, where "last" is the newest *epoch* (a checkpoint
    lifetime) and, inside an epoch, the furthest position: a topic hands out
    offsets in order, so inside one epoch positions only move forward.  A
    repair that restarts earlier opens a new epoch, so a plain ``max`` over all
    rows would be wrong.  ``max(struct(epoch, until_offset))`` is a single
    partial-aggregatable aggregate (no window, no sort of the ledger).
    """
    latest = F.max(F.struct(F.col("epoch"), F.col("until_offset"))).alias("last")
    return (ledger.groupBy(*keys, *KEY).agg(latest)
            .select(*keys, *KEY, F.col("last.until_offset").alias("offset")))


_INTEGER_TEXT = r"^-?[0-9]+$"


def _strict_integer(name: str, typ: str):
    raw = F.col(name)
    bad = raw.isNotNull() & ~raw.cast("string").rlike(_INTEGER_TEXT)
    return F.when(bad, F.raise_error(F.concat(F.lit(f"non-numeric saved {name}: "),
                                              raw.cast("string")))).otherwise(raw.cast(typ))


def typed_offsets(raw: DataFrame, default: int | None = None) -> DataFrame:
    """Cast string ``partition`` / ``offset`` to ``INT`` / ``BIGINT``.

    A value that is not plain digits (including padded ones) fails the job
    instead of silently restarting somewhere else, whatever the session's ANSI
    setting.  A NULL offset becomes ``default`` when one is given.
    """
    offset = _strict_integer("offset", "bigint")
    if default is not None:
        offset = F.coalesce(offset, F.lit(default).cast("bigint"))
    return raw.withColumn("partition", _strict_integer("partition", "int")).withColumn("offset", offset)


def with_default(known: DataFrame, saved: DataFrame, default: int = 0) -> DataFrame:
    """``(topic, partition, offset)`` for every known partition; partitions
    without a saved position start at ``default``.  Saved positions of
    partitions the topic does not have are dropped."""
    return (known.select(*KEY).distinct()
            .join(saved.select(*KEY, "offset"), KEY, "left")
            .select(*KEY, F.coalesce(F.col("offset"), F.lit(default).cast("bigint")).alias("offset")))


def correct_offsets(bounds: DataFrame, saved: DataFrame, strict: bool = False) -> DataFrame:
    """Repair saved positions against the topic's bounds.

    For every partition that has an ``earliest`` bound: a missing saved
    position counts as 0 and a missing ``latest`` as 0 (``strict=True`` fails
    instead); when ``saved > latest`` or ``saved < earliest`` the read starts
    at ``earliest``, otherwise at ``saved``.

    Output ``(topic, partition, earliest, latest, saved_offset, start_offset,
    repaired)``.  Both inputs have one row per partition; AQE broadcasts them
    at run time after measuring them.
    """
    b = bounds.where(F.col("earliest").isNotNull())
    latest = F.col("latest")
    if strict:
        latest = F.when(latest.isNull(), F.raise_error(
            F.concat(F.lit("no latest offset for partition "), F.col("partition").cast("string")))
        ).otherwise(latest)
    joined = b.join(saved.select(*KEY, F.col("offset").alias("saved_raw")), KEY, "left")
    saved_off = F.coalesce(F.col("saved_raw"), F.lit(0).cast("bigint"))
    latest_off = F.coalesce(latest, F.lit(0).cast("bigint"))
    out_of_range = (saved_off > latest_off) | (saved_off < F.col("earliest"))
    return joined.select(
        *KEY, "earliest", latest_off.alias("latest"), saved_off.alias("saved_offset"),
        F.when(out_of_range, F.col("earliest")).otherwise(saved_off).alias("start_offset"),
        out_of_range.alias("repaired"))


def plan_offset_ranges(starts: DataFrame, bounds: DataFrame,
                       max_rate_per_partition: int | None = None,
                       batch_seconds: int = 1, start_col: str = "start_offset") -> DataFrame:
    """``(topic, partition, from_offset, until_offset)``, half-open.

    ``until = least(latest, from + rate * seconds)``: at most ``rate`` records
    per partition per second of batch interval (no limit when ``rate`` is None).
    """
    s = starts.select(*KEY, F.col(start_col).cast("bigint").alias("from_offset"))
    j = s.join(bounds.select(*KEY, "latest"), KEY)
    until = F.col("latest")
    if max_rate_per_partition is not None:
        cap = F.col("from_offset") + F.lit(int(max_rate_per_partition) * int(batch_seconds))
        until = F.least(until, cap)
    return j.select(*KEY, "from_offset",
                    F.greatest(until, F.col("from_offset")).cast("bigint").alias("until_offset"))


def positioned_read(records: DataFrame, ranges: DataFrame,
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Records with ``from_offset <= offset < until_offset`` of their partition.

    The range table (one row per partition) is broadcast after a size check,
    so the records are filtered where they are read, without a shuffle, even
    when one partition holds most of them.  The span of its offsets goes to
    the records as plain predicates, so that a scan sorted by offset skips the
    row groups outside.
    """
    r, n = materialize_small(ranges.select(*KEY, "from_offset", "until_offset").where("from_offset < until_offset"))
    span = r.agg(F.min("from_offset").alias("a"), F.max("until_offset").alias("b"),
                 F.min("partition").alias("p"), F.max("partition").alias("q")).first()
    if span["a"] is None:
        return records.where(F.lit(False))
    records = records.where((F.col("offset") >= span["a"]) & (F.col("offset") < span["b"])
                            & F.col("partition").between(span["p"], span["q"]))
    r = F.broadcast(r) if n <= max_broadcast_rows else r
    return (records.join(r, KEY)
            .where((F.col("offset") >= F.col("from_offset")) & (F.col("offset") < F.col("until_offset")))
            .drop("from_offset", "until_offset"))


def starting_offsets_json(starts: DataFrame, offset_col: str = "start_offset") -> DataFrame:
    """``(topic, starting_offsets)``: ``{"<topic>":{"<p>":<offset>,...}}`` per
    topic, partitions in ascending order - the value of the Kafka source's
    ``startingOffsets`` option (which must list every partition)."""
    entry = F.struct(F.col("partition").cast("int").alias("p"),
                     F.col(offset_col).cast("bigint").alias("o"))
    pairs = F.transform(F.array_sort(F.collect_list(entry)),
                        lambda x: F.concat(F.lit('"'), x["p"].cast("string"), F.lit('":'),
                                           x["o"].cast("string")))
    body = F.concat(F.lit('{"'), F.col("topic"), F.lit('":{'), F.array_join(pairs, ","), F.lit("}}"))
    return starts.groupBy("topic").agg(body.alias("starting_offsets"))


def range_offsets_options(ranges: DataFrame) -> tuple[str, str]:
    """Planned ranges -> ``(startingOffsets, endingOffsets)`` JSON for a
    positioned batch read of a Kafka topic (``spark.read.format('kafka')``);
    the source reads each partition's half-open ``[from, until)``."""
    return (starting_offsets_option(ranges, "from_offset"),
            starting_offsets_option(ranges, "until_offset"))


def starting_offsets_option(starts: DataFrame, offset_col: str = "start_offset") -> str:
    """One JSON object covering every topic in ``starts`` (driver-side string;
    its size is one entry per topic partition)."""
    per_topic = starting_offsets_json(starts, offset_col)
    parts = [r["starting_offsets"][1:-1] for r in
             per_topic.orderBy("topic").select("starting_offsets").collect()]
    return "{" + ",".join(parts) + "}"
