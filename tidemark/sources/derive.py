"""Record streams derived from the ``events`` table.

The engine's inputs are keyed string records with a position: the shape a
topic delivers.  Here they are derived from ``events`` with Spark so that the
work grows with the table:

* :func:`access_log` - one log line per event (``<ts>|~|<type>|~|<uri>``),
  with a deterministic share of malformed lines.
* :func:`topic_records` - the lines as a topic: ``partition`` from a hash of
  the user, dense per-partition ``offset`` in ``event_id`` order.
* :func:`offset_bands` - cuts a partition's offsets into consecutive bands,
  the unit a micro-batch reads.

Dense offsets without a global sort: rows are bucketed into ``(partition,
block)`` groups of at most ``block_size`` event ids; a tiny table of block
counts gives each block its starting offset (running sum per partition), and
``row_number`` inside the block adds the rest.  No task ever holds more than one
block, so a partition holding a third of all rows still spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import log_timestamp_text
from tidemark.functions.encode import record_key

# Fixed values of the derivation (shared with the SQL oracles):
#   every event whose id is a multiple of 97 becomes the malformed line "bad";
#   else every id that is a multiple of 89 loses its uri field;
#   the uri of a good line is  /p?uid=<user_id>&sid=<event_type>
BAD_LINE_EVERY = 97
NO_URI_EVERY = 89
BAD_LINE = "bad"
FIELD_SEPARATOR = "|~|"
URI_PREFIX = "/p?uid="
URI_SITE = "&sid="

DEFAULT_TOPIC = "events"
DEFAULT_TOPIC_PARTITIONS = 8
DEFAULT_BLOCK_SIZE = 1 << 20
DEFAULT_BANDS = 5


def access_log(events: DataFrame) -> DataFrame:
    """``(event_id, ts, user_id, value)``: one access-log line per event."""
    ts_text = log_timestamp_text("ts")
    head = F.concat(ts_text, F.lit(FIELD_SEPARATOR), F.col("event_type"))
    uri = F.concat(F.lit(URI_PREFIX), F.col("user_id").cast("string"), F.lit(URI_SITE),
                   F.col("event_type"))
    value = (F.when(F.col("event_id") % BAD_LINE_EVERY == 0, F.lit(BAD_LINE))
             .when(F.col("event_id") % NO_URI_EVERY == 0, head)
             .otherwise(F.concat(head, F.lit(FIELD_SEPARATOR), uri)))
    return events.select("event_id", "ts", "user_id", value.alias("value"))


def topic_records(events: DataFrame, topic: str = DEFAULT_TOPIC,
                  num_partitions: int = DEFAULT_TOPIC_PARTITIONS,
                  block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(topic, partition, offset, key, value, ts, partition_records)`` with
    dense offsets; the last column is the partition's number of records.

    ``offset`` = rank of the event (by ``event_id``, NULL first) inside its
    partition, starting at 0; ``partition`` = ``pmod(user_id, num_partitions)``,
    a NULL user going to partition 0.  No row is dropped: join keys are never
    NULL.
    """
    lines = access_log(events).select(
        F.lit(topic).alias("topic"),
        F.pmod(F.coalesce(F.col("user_id"), F.lit(0)), F.lit(num_partitions)).cast("int")
        .alias("partition"),
        # NULL ids form block -1, ahead of every other block (NULLs sort first).
        F.coalesce(F.expr(f"event_id div {int(block_size)}"), F.lit(-1).cast("bigint")).alias("block"),
        "event_id", "ts", "value")

    # Starting offset of every block: running count of the earlier blocks of the
    # same partition.  One row per (partition, block): tiny next to the data.
    block_rows = lines.groupBy("partition", "block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("partition").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = block_rows.select(
        "partition", "block",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("block_start"),
        F.sum("n").over(Window.partitionBy("partition")).alias("partition_records"))

    in_block = Window.partitionBy("partition", "block").orderBy(F.col("event_id").asc_nulls_first())
    return (lines.join(starts, ["partition", "block"])
            .select("topic", "partition",
                    (F.col("block_start") + F.row_number().over(in_block) - 1).cast("bigint")
                    .alias("offset"),
                    record_key("event_id").alias("key"),
                    "value", "ts", "partition_records"))


def offset_bands(records: DataFrame, bands: int = DEFAULT_BANDS) -> DataFrame:
    """Adds ``band`` = ``offset * bands div partition_records``.

    Bands are contiguous offset intervals of a partition, equal but for one
    record at any size; replaying them in order reproduces how a topic hands
    out consecutive micro-batches.
    """
    return records.withColumn("band", F.expr(f"(offset * {int(bands)}) div partition_records"))
