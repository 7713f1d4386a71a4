"""Traffic metrics over parsed events: page views per hour, per site and hour,
exact unique users per day.

All are plain ``groupBy`` aggregations: Spark plans a partial (map-side)
aggregate before the shuffle, so a hot hour or site ships one partial row per
task, not its raw rows.  Exact distinct users shuffle on ``(day, user_id)``
first (deduplicated map-side), then count per day: a hot day is spread over
all reducers by user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.logparse import day_key


def with_day(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("day", day_key("hour"))


def pv_by_hour(parsed: DataFrame) -> DataFrame:
    """``(hour, pv)``."""
    return parsed.groupBy("hour").agg(F.count(F.lit(1)).alias("pv"))


def site_pv_by_hour(parsed: DataFrame) -> DataFrame:
    """``(site_id, hour, pv)``."""
    return parsed.groupBy("site_id", "hour").agg(F.count(F.lit(1)).alias("pv"))


def uv_members_by_day(parsed: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """``(day, user_id)``: the set of users seen per day.

    ``stored`` (same columns) is a set kept from earlier batches; the result is
    their union-distinct, i.e. adding today's members to the stored set.
    """
    members = with_day(parsed).select("day", "user_id")
    if stored is not None:
        members = members.unionByName(stored.select("day", "user_id"))
    return members.distinct()


def uv_by_day(parsed: DataFrame) -> DataFrame:
    """``(day, uv)``: exact distinct users per day."""
    return (with_day(parsed).groupBy("day")
            .agg(F.count_distinct("user_id").alias("uv")))


def uv_from_members(members: DataFrame) -> DataFrame:
    """``(day, uv)`` from a ``(day, user_id)`` member set (duplicates allowed)."""
    return members.groupBy("day").agg(F.count_distinct("user_id").alias("uv"))


def batch_total(parsed: DataFrame) -> DataFrame:
    """``(events)``: number of parsed events in the batch."""
    return parsed.agg(F.count(F.lit(1)).alias("events"))
