"""Landing tables: DDL, static-partition insert, row-date append, column-list
inserts, partition pruning."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import landing


def _lines(spark):
    return spark.createDataFrame(
        [("a", "2024-01-01 23:59:59"), ("b", "2024-01-02 00:00:01"), ("c", "2024-01-02 10:00:00")],
        "value STRING, ts STRING").withColumn("ts", F.to_timestamp_ntz("ts"))


def test_static_partition_insert_and_scan(spark):
    db = landing.create_database(spark)
    t = landing.create_landing_table(spark, f"{db}.landing")
    landing.insert_batch_partition(_lines(spark), t, "2024-03-01")
    landing.insert_batch_partition(_lines(spark).limit(1), t, "2024-03-02")
    rows = sorted(tuple(r) for r in landing.landing_scan(spark, t).collect())
    assert rows == [("a", "2024-03-01"), ("a", "2024-03-02"), ("b", "2024-03-01"), ("c", "2024-03-01")]
    with pytest.raises(ValueError):
        landing.insert_batch_partition(_lines(spark), t, "2024-03-01' OR 1=1")


def test_row_date_split_at_midnight(spark):
    db = landing.create_database(spark)
    t = f"{db}.by_row"
    landing.append_by_row_date(_lines(spark), t)
    got = {r["pd"]: r["n"] for r in spark.table(t).groupBy("pd").agg(F.count("*").alias("n")).collect()}
    assert got == {"2024-01-01": 1, "2024-01-02": 2}


def test_partition_pruning(spark, capsys):
    db = landing.create_database(spark)
    t = f"{db}.by_row"
    landing.append_by_row_date(_lines(spark), t)
    scan = landing.landing_scan(spark, t, pd="2024-01-02").select("record")
    scan.explain(mode="formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters" in plan and "2024-01-02" in plan
    assert sorted(r["record"] for r in scan.collect()) == ["b", "c"]


def test_insert_by_columns_and_values(spark):
    db = landing.create_database(spark)
    t = f"{db}.t1"
    spark.sql(f"CREATE TABLE {landing.quote_ident(t)} (record STRING, pt_date STRING) "
              "USING parquet PARTITIONED BY (pt_date)")
    src = spark.createDataFrame([("2019-02-09", "x")], "pt_date STRING, record STRING")
    landing.insert_by_columns(spark, t, ["pt_date", "record"], src)
    landing.insert_values(spark, t, ["record", "pt_date"], [("tt", "2019-02-09"), ("uu", "2019-02-10")])
    rows = sorted(tuple(r) for r in spark.table(t).collect())
    assert rows == [("tt", "2019-02-09"), ("uu", "2019-02-10"), ("x", "2019-02-09")]
    # many rows: every value stays in its own row and column
    many = [(f"rec-{i}", f"2020-01-{i % 28 + 1:02d}") for i in range(50)]
    landing.insert_values(spark, t, ["pt_date", "record"], [(d, r) for r, d in many])
    got = sorted(tuple(r) for r in spark.table(t).where("record LIKE 'rec-%'").collect())
    assert got == sorted(many)


def test_quote_ident_rejects_injection():
    with pytest.raises(ValueError):
        landing.quote_ident("db.t; DROP TABLE x")
    assert landing.quote_ident("db.t") == "`db`.`t`"
    with pytest.raises(ValueError):
        landing.quote_path("/data/x' OR '1'='1")
    assert landing.quote_path("hdfs:///a/b") == "'hdfs:///a/b'"


def test_external_location_table(spark, scratch):
    db = landing.create_database(spark)
    loc = scratch("external_landing")
    t = landing.create_landing_table(spark, f"{db}.ext", location=loc)
    landing.insert_batch_partition(_lines(spark), t, "2024-03-01")
    back = spark.read.schema("record STRING, pd STRING").parquet(loc)
    assert sorted(r["record"] for r in back.collect()) == ["a", "b", "c"]


def test_rebalanced_write_splits_a_hot_date(spark):
    """One date holding most rows is written by several tasks (AQE splits the
    skewed rebalance partition), not funnelled through one."""
    rows = spark.range(60000).select(
        F.concat(F.lit("line-"), F.col("id").cast("string"), F.lit("-" + "x" * 40)).alias("value"),
        F.when(F.col("id") % 10 < 8, F.lit("2024-01-01 12:00:00"))
        .otherwise(F.concat(F.lit("2024-01-0"), (F.col("id") % 10).cast("string"), F.lit(" 01:00:00")))
        .alias("ts")).withColumn("ts", F.to_timestamp_ntz("ts"))
    db = landing.create_database(spark)
    t = f"{db}.hot"
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    previous = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        landing.append_by_row_date(rows, t)
    finally:
        spark.conf.set(key, previous)
    hot = [f for f in spark.table(t).inputFiles() if "pd=2024-01-01" in f]
    assert len(hot) > 1
    assert spark.table(t).where("pd = '2024-01-01'").count() == 48000
