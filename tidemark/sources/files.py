"""File stand-in for a topic: decoded records landed as Parquet files.

:func:`land_records` writes records in slices of their offsets with ordered
file times, so a file stream replays them the way a topic hands out
consecutive micro-batches.  :func:`record_stream` reads them back as a
streaming DataFrame with the decoded Kafka columns.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import fs
from tidemark.sources.derive import DEFAULT_BANDS, offset_bands

RECORD_SCHEMA = ("topic STRING, partition INT, offset BIGINT, key STRING, value STRING, "
                 "ts TIMESTAMP_NTZ")
FILES_PER_BAND = 4
#: Records of a file; a larger topic has more files a band.
FILE_RECORDS = 4_000_000


def land_records(records: DataFrame, path: str, bands: int = DEFAULT_BANDS,
                 files_per_band: int | None = None) -> int:
    """Write the records of a topic under ``path`` as ``bands * files_per_band``
    slices, once, and return the files of a band (by the number of records
    where none is given).

    A slice is a contiguous interval of every partition's offsets, sorted by
    ``(partition, offset)`` so that row groups can be skipped, in one file.
    File times follow the slices, so a file stream that takes a band's files
    at a time reads whole bands in order.
    """
    if files_per_band is None:
        files_per_band = max(FILES_PER_BAND, -(-records.count() // (bands * FILE_RECORDS)))
    sliced = offset_bands(records, bands * files_per_band).withColumnRenamed("band", "slice")
    land_slices(sliced.drop("partition_records"), path, bands * files_per_band)
    return files_per_band


def land_slices(sliced: DataFrame, path: str, n: int) -> None:
    """Write records by their ``slice`` from 0 to ``n - 1``: a file for each,
    which a file stream reads in this order."""
    spark = sliced.sparkSession
    # a slice's rows are in one task, so it is one file
    (sliced.repartitionByRange(n, "slice").sortWithinPartitions("slice", "partition", "offset")
     .write.mode("overwrite").partitionBy("slice").parquet(path))
    base = fs.modified(spark, path) - n * 1000
    for i in range(n):
        fs.set_modified(spark, f"{path}/slice={i}/part-*", base + i * 1000)


def read_or_empty(spark: SparkSession, schema, path: str, source: str) -> DataFrame:
    """What was written under ``path``; an empty frame of that schema when
    nothing was written there yet (e.g. a stream with no batches)."""
    try:
        return spark.read.schema(schema).format(source).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_parquet_or_empty(spark: SparkSession, schema, path: str) -> DataFrame:
    return read_or_empty(spark, schema, path, "parquet")


def read_json_or_empty(spark: SparkSession, schema, path: str) -> DataFrame:
    return read_or_empty(spark, schema, path, "json")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The landed topic as a table."""
    return spark.read.schema(RECORD_SCHEMA + ", slice INT").parquet(path).drop("slice")


def record_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The landed topic as a stream; oldest files first."""
    reader = spark.readStream.schema(RECORD_SCHEMA + ", slice INT").format("parquet")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    return reader.load(path).drop("slice")
