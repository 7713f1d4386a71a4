"""Kafka source and sink options, and the decode step shared by all readers.

The ``kafka`` data source ships as a separate package
(``spark-sql-kafka-0-10``); it is not on this machine's classpath, so these
builders are exercised as data (option dictionaries) in tests and the jobs run
against the file stand-in (:mod:`tidemark.sources.files`) which yields the
same decoded columns.

Mapping from consumer settings to source options:

=============================  ==============================================
subscribe to a topic           ``subscribe``
read only named partitions     ``assign`` = ``{"t":[0,1]}``
start from explicit positions  ``startingOffsets`` = JSON listing *every* partition
no valid start: earliest       ``startingOffsets='earliest'``
no valid start: fail           explicit JSON + ``failOnDataLoss=true``
positioned batch read          ``startingOffsets`` + ``endingOffsets`` (half-open)
records / partition / second   ``maxOffsetsPerTrigger`` (a *total* per trigger)
=============================  ==============================================

Positions are kept in Spark's checkpoint (offset log + commit log); the consumer
group's own commits are not used to resume.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DECODED_COLUMNS = ("topic", "partition", "offset", "key", "value", "ts")


def assign_json(partitions: dict[str, list[int]]) -> str:
    return json.dumps({t: sorted(int(p) for p in ps) for t, ps in partitions.items()},
                      separators=(",", ":"))


def max_offsets_per_trigger(rate_per_partition: int, batch_seconds: float, num_partitions: int) -> int:
    """Per-partition rate limit expressed as the source's total per trigger, at
    least one record.  The source shares the total out by backlog, so a
    partition far behind the others may exceed its own rate; for a limit that
    holds for each partition, plan ranges
    (:func:`tidemark.operators.offsets.plan_offset_ranges`) and read them with
    :func:`read_ranges`."""
    return max(1, int(rate_per_partition * batch_seconds * int(num_partitions)))


def reader_options(bootstrap_servers: str, topic: str | None = None,
                   assign: dict[str, list[int]] | None = None,
                   starting_offsets: str | None = None, ending_offsets: str | None = None,
                   reset_policy: str = "earliest", max_offsets: int | None = None,
                   min_partitions: int | None = None, group_id_prefix: str | None = None,
                   extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options for ``spark.read(Stream).format('kafka')``.

    ``reset_policy`` is used when ``starting_offsets`` is not given:
    ``earliest`` / ``latest`` start there; ``none`` refuses to guess.
    """
    if (topic is None) == (assign is None):
        raise ValueError("give exactly one of topic or assign")
    opts = {"kafka.bootstrap.servers": bootstrap_servers}
    if topic is not None:
        opts["subscribe"] = topic
    else:
        opts["assign"] = assign_json(assign)
    if starting_offsets is None:
        if reset_policy == "none":
            raise ValueError("reset policy 'none' needs explicit starting offsets")
        if reset_policy not in ("earliest", "latest"):
            raise ValueError(f"unknown reset policy {reset_policy!r}")
        starting_offsets = reset_policy
    opts["startingOffsets"] = starting_offsets
    opts["failOnDataLoss"] = "true"
    if ending_offsets is not None:
        opts["endingOffsets"] = ending_offsets
    if max_offsets is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets))
    if min_partitions is not None:
        opts["minPartitions"] = str(int(min_partitions))
    if group_id_prefix is not None:
        opts["groupIdPrefix"] = group_id_prefix
    opts.update(extra or {})
    return opts


def utc_clock(name: str) -> Column:
    """An instant as its UTC wall clock, whatever the session's time zone (a
    cast would use that zone, and so move records to another date)."""
    since = F.expr(f"make_dt_interval(0, 0, 0, cast(unix_micros({name}) as decimal(18, 0)) / 1000000)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def decode(raw: DataFrame) -> DataFrame:
    """Kafka rows -> ``(topic, partition, offset, key, value, ts)`` as strings."""
    return raw.select(
        "topic", F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        utc_clock("timestamp").alias("ts"))


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return decode(spark.readStream.format("kafka").options(**options).load())


def read_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Positioned batch read ``[startingOffsets, endingOffsets)``."""
    return decode(spark.read.format("kafka").options(**options).load())


def ranges_reader_options(bootstrap_servers: str, ranges: DataFrame) -> dict[str, str]:
    """Options for a positioned batch read of planned ``[from, until)`` ranges
    (``assign`` lists exactly the planned partitions)."""
    from tidemark.operators.offsets import range_offsets_options
    start, end = range_offsets_options(ranges)
    parts: dict[str, list[int]] = {}
    for topic, offsets_by_partition in json.loads(start).items():
        parts[topic] = [int(p) for p in offsets_by_partition]
    return reader_options(bootstrap_servers, assign=parts, starting_offsets=start,
                          ending_offsets=end)


def read_ranges(spark: SparkSession, bootstrap_servers: str, ranges: DataFrame) -> DataFrame:
    """The records of planned ranges, read from the topic (live form of
    :func:`tidemark.operators.offsets.positioned_read`)."""
    return read_batch(spark, ranges_reader_options(bootstrap_servers, ranges))


def writer_options(bootstrap_servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}


def write_records(df: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Write ``(key, value)`` string records to a topic."""
    (df.select(F.col("key").cast("string"), F.col("value").cast("string"))
     .write.format("kafka").options(**writer_options(bootstrap_servers, topic)).save())
