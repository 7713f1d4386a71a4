"""Exact sets of users as bitmaps.

A user gets a number once, from a dictionary that only grows; a day's users are
bitmaps over these numbers, so sets are merged by OR and counted by their bits
instead of rewriting member rows.  A fold takes the batches that came since the
last one: it numbers the users not seen before and writes the bits of the new
batches, as a part of its own.  What it writes follows what is new; parts are
merged two of a size at a time.

Numbers are given by group of users (a hash), each group counting for itself,
so no single task numbers all users; the groups' numbers alternate, so all of
them together are as dense as the groups are even, and few users share few
buckets.

Layout: ``<path>/names/part=<p>`` ``(group_id, user_id, n)``, ``<path>/bits/part=<p>``
``(day, bucket, bits)`` and manifests as for snapshots
(:mod:`tidemark.streaming.ledger`), naming ``[kind, part, span]``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.operators.joins import checkpointed
from tidemark.sources import fs
from tidemark.streaming import commits
from tidemark.streaming.ledger import (TRIES, fence, generations, new_part, newest_manifest, put_manifest, read_ledger,
                                       read_manifest)

NAMES_SCHEMA = "group_id INT, user_id STRING, n BIGINT, part STRING"
BITS_SCHEMA = "day STRING, bucket BIGINT, bits BINARY, part STRING"
#: Groups of users that are numbered at the same time.
GROUPS = 256


def _read(spark: SparkSession, path: str, kind: str, parts: list) -> DataFrame:
    schema = NAMES_SCHEMA if kind == "names" else BITS_SCHEMA
    root = f"{path.rstrip('/')}/{kind}"
    paths = [f"{root}/part={p}" for k, p, _ in parts if k == kind]
    if not paths:
        return spark.createDataFrame([], schema).drop("part")
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).drop("part")


def _binary_counter(parts: list) -> tuple[list, list, int]:
    """Bitmap parts that a new one takes in, those that stay, and its span."""
    rest, taken, span = sorted(parts, key=lambda p: -p[2]), [], 1
    while rest and rest[-1][2] <= span:
        taken.append(rest.pop())
        span += taken[-1][2]
    return taken, rest, span


def _or(rows: DataFrame) -> DataFrame:
    return rows.groupBy("day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def fold_users(spark: SparkSession, ledger_path: str, path: str) -> tuple[int, int] | None:
    """Take the whole batches since the last fold into the bitmaps; returns
    the watermark.  Of two at a time one wins and the other starts again."""
    root = path.rstrip("/")
    for _ in range(TRIES):
        newest = newest_manifest(spark, path)
        generation, mark, parts = newest if newest is not None else (-1, None, [])
        top = commits.newest_after(spark, ledger_path, mark)
        if top is None:
            return mark
        fresh = read_ledger(spark, ledger_path, mark).where(~commits.after(top) & (F.col("metric") == "uv"))
        if generations(spark, path)[-1:] != ([] if newest is None else [generation]):
            continue
        part = new_part(generation + 1)
        members = checkpointed(fresh.select(F.col("k").alias("day"), F.col("member").alias("user_id")).distinct())
        names = _read(spark, path, "names", parts)
        group = F.pmod(F.xxhash64("user_id"), F.lit(GROUPS)).cast("int").alias("group_id")
        unknown = members.select(group, "user_id").distinct().join(names, ["group_id", "user_id"], "left_anti")
        given = names.groupBy("group_id").agg(F.max("n").alias("last"))
        rank = F.row_number().over(Window.partitionBy("group_id").orderBy("user_id"))
        # the k-th user of group g has the number (k - 1) * GROUPS + g + 1
        before = F.coalesce(F.col("last"), F.col("group_id") + 1 - GROUPS)
        (unknown.withColumn("rank", rank).join(given, "group_id", "left")
         .select("group_id", "user_id", (before + F.col("rank") * GROUPS).cast("bigint").alias("n"))
         .write.parquet(f"{root}/names/part={part}"))
        now = [*[p for p in parts if p[0] == "names"], ["names", part, 1]]
        numbered = members.select("day", group, "user_id").join(_read(spark, path, "names", now), ["group_id", "user_id"])
        bits = (numbered.groupBy("day", F.bitmap_bucket_number("n").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")))
        taken, stay, span = _binary_counter([p for p in parts if p[0] == "bits"])
        _or(bits.unionByName(_read(spark, path, "bits", taken))).write.parquet(f"{root}/bits/part={part}")
        if put_manifest(spark, path, generation + 1, top, [*now, *stay, ["bits", part, span]]):
            return top
    raise RuntimeError(f"{path} was folded by others {TRIES} times in a row")


def retain_users(spark: SparkSession, path: str) -> int:
    """Remove parts that neither of the two newest manifests names."""
    known, gone = generations(spark, path), 0
    if fence(spark, path) is None:
        return 0
    named = {(k, p) for g in known[-2:] for k, p, _ in read_manifest(spark, path, g)["parts"]}
    for kind in ("names", "bits"):
        for folder in fs.folders(spark, f"{path.rstrip('/')}/{kind}/part=*"):
            part = fs.partition_of(folder)["part"]
            if int(part.split("-")[0]) <= known[-1] and (kind, part) not in named:
                fs.remove(spark, folder)
                gone += 1
    return gone


def _parts(spark: SparkSession, path: str) -> list:
    newest = newest_manifest(spark, path)
    return [] if newest is None else newest[2]


def uv_by_day(spark: SparkSession, path: str) -> DataFrame:
    """``(day, uv)``: exact distinct users, counted from the bits."""
    bits = _or(_read(spark, path, "bits", _parts(spark, path)))
    return bits.groupBy("day").agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("uv"))


def members_by_day(spark: SparkSession, path: str) -> DataFrame:
    """``(day, user_id)``: the users that the bits stand for."""
    parts = _parts(spark, path)
    bits = _or(_read(spark, path, "bits", parts))
    # the bits of a bucket as hexadecimal bytes: byte i has the positions 8 i to 8 i + 7
    byte = F.conv(F.substr(F.hex("bits"), F.lit(1) + F.col("i") * 2, F.lit(2)), 16, 10).cast("int")
    cells = (bits.select("day", "bucket", "bits", F.explode(F.sequence(F.lit(0), F.octet_length("bits") - 1)).alias("i"))
             .select("day", "bucket", "i", byte.alias("byte")).where("byte > 0")
             .select("day", "bucket", "i", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("j"))
             .where(F.expr("(shiftright(byte, j) & 1) = 1")))
    # bucket b has the numbers 32768 (b - 1) + 1 to 32768 b
    numbers = cells.select("day", ((F.col("bucket") - 1) * 32768 + F.col("i") * 8 + F.col("j") + 1).alias("n"))
    return numbers.join(_read(spark, path, "names", parts), "n").select("day", "user_id")
