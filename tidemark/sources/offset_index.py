"""Zone map of a landed topic: which offsets of which partition each file holds.

One row for each file and partition in it, written beside the topic when it is
landed.  It answers the earliest and latest offsets without reading records,
and names the files that planned ranges need, so a positioned read opens only
those.  The index is what a topic shows: files it doesn't name are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.offsets import KEY, positioned_read
from tidemark.sources.files import RECORD_SCHEMA, read_parquet_or_empty

INDEX_SCHEMA = "file STRING, topic STRING, partition INT, low BIGINT, high BIGINT, records BIGINT"
BY_PARTITION_SCHEMA = "topic STRING, offset BIGINT, key STRING, value STRING, ts TIMESTAMP_NTZ, partition INT"


def index_path(topic_path: str) -> str:
    return topic_path.rstrip("/") + "_index"


def file_ranges(spark: SparkSession, topic_path: str) -> DataFrame:
    """``(file, topic, partition, low, high, records)`` of a landed topic;
    ``high`` is the last offset."""
    rows = spark.read.schema(RECORD_SCHEMA).parquet(topic_path)
    return rows.groupBy(F.col("_metadata.file_path").alias("file"), *KEY).agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"), F.count(F.lit(1)).alias("records"))


def write_index(spark: SparkSession, topic_path: str, index: str | None = None) -> str:
    """Index what is landed; returns where the index is."""
    at = index or index_path(topic_path)
    file_ranges(spark, topic_path).write.mode("overwrite").parquet(at)
    return at


def read_index(spark: SparkSession, index: str) -> DataFrame:
    return read_parquet_or_empty(spark, INDEX_SCHEMA, index)


def index_bounds(index: DataFrame) -> DataFrame:
    """``(topic, partition, earliest, latest)``, as
    :func:`tidemark.operators.offsets.offset_bounds` finds in the records."""
    return index.groupBy(*KEY).agg(F.min("low").alias("earliest"), (F.max("high") + 1).alias("latest"))


def files_of(index: DataFrame, ranges: DataFrame) -> list[str]:
    """The files that hold records of ``ranges`` (``from_offset`` to before
    ``until_offset``); as many names as a scan of them lists."""
    meets = (F.col("low") < F.col("until_offset")) & (F.col("high") >= F.col("from_offset"))
    wanted = ranges.where("from_offset < until_offset").select(*KEY, "from_offset", "until_offset")
    return sorted(r["file"] for r in index.join(wanted, KEY).where(meets).select("file").distinct().collect())


def indexed_read(spark: SparkSession, index: DataFrame, ranges: DataFrame) -> DataFrame:
    """Records inside ``ranges``, from the files that hold them."""
    found = files_of(index, ranges)
    if not found:
        return spark.createDataFrame([], RECORD_SCHEMA)
    return positioned_read(spark.read.schema(RECORD_SCHEMA).parquet(*found), ranges)


def land_by_partition(records: DataFrame, path: str) -> None:
    """A topic as a folder for each of its partitions, sorted by offset."""
    (records.select("topic", "offset", "key", "value", "ts", "partition").repartitionByRange("partition", "offset")
     .sortWithinPartitions("partition", "offset").write.partitionBy("partition").parquet(path))


def footer_bounds(spark: SparkSession, path: str) -> DataFrame:
    """``(partition, earliest, latest, records)`` of a topic landed by
    partition, from the files' footers: the aggregate is pushed into the scan
    and no data page is read."""
    own = spark.newSession()   # the settings hold for this read only
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    # footers are read by place: the schema has the columns of the files
    rows = own.read.schema(BY_PARTITION_SCHEMA).parquet(path)
    return rows.groupBy("partition").agg(F.min("offset").alias("earliest"), F.max("offset").alias("newest"), F.count(F.lit(1)).alias("records")).select(
        "partition", "earliest", (F.col("newest") + 1).alias("latest"), "records")
