"""Landing tables: payload records in date-partitioned Parquet tables.

Shape: ``record STRING`` partitioned by ``pd STRING`` (``yyyy-MM-dd``).  All
statements go through the catalog with quoted identifiers or the DataFrame
writer; no names or values are spliced into SQL text.

* :func:`create_database` / :func:`create_landing_table` - DDL (``USING parquet``,
  no Hive needed; the database lives in the shared folder).
* :func:`insert_batch_partition` - a batch into one static partition
  (``INSERT INTO t PARTITION (pd='<date>') SELECT record ...``).
* :func:`append_by_row_date` - append with ``pd`` from each record's timestamp.
* :func:`insert_by_columns` / :func:`insert_values` - insert by column list.
* :func:`landing_scan` - the table, optionally restricted to partitions
  (the predicate becomes a ``PartitionFilters`` entry: pruned directories are
  never listed or read).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import partition_date
from tidemark.session import scratch_path

_DATE_RE = re.compile(r"^\d{4}-\d{2}-\d{2}$")
_IDENT_RE = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def quote_ident(name: str) -> str:
    """``db.table`` -> ```db`.`table```; rejects anything but plain identifiers."""
    parts = name.split(".")
    for p in parts:
        if not _IDENT_RE.match(p):
            raise ValueError(f"not a plain identifier: {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def quote_path(path: str) -> str:
    """A location as a SQL string literal; rejects characters that could end it."""
    if any(ch in path for ch in ("'", "\\", "\n", "\r")):
        raise ValueError(f"unsupported character in location: {path!r}")
    return f"'{path}'"


def create_database(spark: SparkSession, name: str | None = None, location: str | None = None) -> str:
    """Create a database in the shared folder; returns its name."""
    name = name or f"tidemark_{uuid.uuid4().hex[:12]}"
    location = location or scratch_path(spark, "db", name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_ident(name)} LOCATION {quote_path(location)}")
    return name


def create_landing_table(spark: SparkSession, table: str, partition_col: str = "pd",
                         payload_col: str = "record", location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS t (record STRING, pd STRING) USING parquet
    PARTITIONED BY (pd) [LOCATION ...]``."""
    loc = f" LOCATION {quote_path(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quote_ident(table)} "
              f"({quote_ident(payload_col)} STRING, {quote_ident(partition_col)} STRING) "
              f"USING parquet PARTITIONED BY ({quote_ident(partition_col)}){loc}")
    return table


def payload(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Keep the record value, drop key and position: ``(record)``."""
    return df.select(F.col(value_col).cast("string").alias("record"))


def stamp_batch_date(df: DataFrame, batch_date: str, value_col: str = "value") -> DataFrame:
    """``(record, pd)`` with one date for the whole batch."""
    if not _DATE_RE.match(batch_date):
        raise ValueError(f"batch date must be yyyy-MM-dd, got {batch_date!r}")
    return payload(df, value_col).withColumn("pd", F.lit(batch_date))


def stamp_row_date(df: DataFrame, value_col: str = "value", ts_col: str = "ts") -> DataFrame:
    """``(record, pd)`` with ``pd`` from each record's own timestamp."""
    return df.select(F.col(value_col).cast("string").alias("record"),
                     partition_date(ts_col).alias("pd"))


def insert_batch_partition(df: DataFrame, table: str, batch_date: str,
                           value_col: str = "value") -> None:
    """Append a batch into the static partition ``pd = batch_date``.

    ``insertInto`` matches columns by position: ``(record, pd)``.
    """
    stamp_batch_date(df, batch_date, value_col).write.insertInto(table)


def append_by_row_date(df: DataFrame, table: str, value_col: str = "value",
                       ts_col: str = "ts", rebalance: bool = True) -> None:
    """Append to a managed Parquet table partitioned by the record's date.

    ``rebalance`` routes rows by ``pd`` through an AQE rebalance before the
    write: each date gets a few right-sized files instead of one small file
    per input task, and a date holding a large share of the rows is split
    over several tasks instead of landing in one.
    """
    stamped = stamp_row_date(df, value_col, ts_col)
    if rebalance:
        stamped = stamped.hint("rebalance", "pd")
    stamped.write.format("parquet").mode("append").partitionBy("pd").saveAsTable(table)


def insert_by_columns(spark: SparkSession, table: str, columns: list[str], df: DataFrame) -> None:
    """``INSERT INTO t (c1, c2, ...) SELECT ...``: ``df``'s columns are taken in
    order and matched to ``columns`` by name, not by table position."""
    view = f"_tidemark_insert_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        cols = ", ".join(quote_ident(c) for c in columns)
        sel = ", ".join(quote_ident(c) for c in df.columns)
        spark.sql(f"INSERT INTO {quote_ident(table)} ({cols}) SELECT {sel} FROM {quote_ident(view)}")
    finally:
        spark.catalog.dropTempView(view)


def insert_values(spark: SparkSession, table: str, columns: list[str], rows: list[tuple]) -> None:
    """``INSERT INTO t (c1, ...) VALUES (...), ...`` with bound parameters.

    Named markers (``:r<i>_<j>``) bind by name; positional ``?`` markers in a
    multi-row ``VALUES`` list are not guaranteed to bind in row order.
    """
    if not rows:
        return
    width = len(columns)
    if any(len(r) != width for r in rows):
        raise ValueError("every row needs one value per column")
    marks = ", ".join("(" + ", ".join(f":r{i}_{j}" for j in range(width)) + ")"
                      for i in range(len(rows)))
    args = {f"r{i}_{j}": v for i, r in enumerate(rows) for j, v in enumerate(r)}
    cols = ", ".join(quote_ident(c) for c in columns)
    spark.sql(f"INSERT INTO {quote_ident(table)} ({cols}) VALUES {marks}", args=args)


def landing_scan(spark: SparkSession, table: str, pd: str | list[str] | None = None,
                 partition_col: str = "pd") -> DataFrame:
    """``SELECT * FROM t [WHERE pd IN (...)]``."""
    df = spark.table(table)
    if pd is not None:
        days = [pd] if isinstance(pd, str) else list(pd)
        df = df.where(F.col(partition_col).isin(*days))
    return df
