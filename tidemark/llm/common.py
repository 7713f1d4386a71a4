"""Helpers shared by the operators: written intermediate tables, row identity
and the Arrow plumbing of the Python stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from tidemark.session import scratch_path

#: Whitespace of the word and strip rules: ``[\x20\x09-\x0D]``.  Python's
#: ``bytes.split()`` and ``bytes.strip()`` without arguments use the same set.
WHITESPACE = " \t\n\x0b\x0c\r"

#: Rows of one Arrow batch handed to Python.  Documents are up to megabytes
#: long, so the default of 10,000 rows would not bound a worker's memory.
BATCH_ROWS = 500


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage, is computed once however many branches read it, and
    survives lost executors (the folder comes from ``spark.checkpoint.dir``).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch (a lower setting is left alone)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def row_key() -> list[Column]:
    """Two 64-bit hashes of ``(doc_id, text)`` as ``k1``, ``k2``.

    They identify a document even where ``doc_id`` is null or repeated; rows
    that agree in both columns share a key and get the same decision, which is
    also what they would get one by one.
    """
    return [F.xxhash64(F.lit(i), F.col("doc_id"), F.col("text")).alias(f"k{i}") for i in (1, 2)]


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as ``(k1, k2, text, row)``: ``row`` holds all other columns as
    they came, so that extra columns can't clash with working ones."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(*row_key(), F.col("text"), F.struct(*others).alias("row"))


def unpacked(df: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The documents of ``packed`` in their former columns and order, with the
    column ``text`` as their text."""
    return df.select(*[F.col(text).alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


def fields(row: StructType | None, ddl: str) -> StructType:
    """A schema of ``row`` and the columns of ``ddl``."""
    own = StructType.fromDDL(ddl)
    return own if row is None else StructType([StructField("row", row), *own.fields])


def in_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` for a function from one batch to columns by name."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kind = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield pa.RecordBatch.from_arrays(
                    [as_array(out[f.name], f.type) for f in kind], schema=kind)

    return df.mapInArrow(run, schema)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 ``bytes`` objects; null becomes empty."""
    col = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [x or b"" for x in col.cast(kind).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def longs(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """A long column without nulls as a numpy array."""
    return column(batch, name).to_numpy(zero_copy_only=False)


def signed(x: int) -> int:
    """An unsigned 64-bit value as the long of the same bits."""
    return x - (1 << 64) if x >= 1 << 63 else x
