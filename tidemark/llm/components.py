"""Connected components of a table of links, by alternating stars.

Each round links every node to the least node it knows of (Kiveris et al.,
"Connected Components in MapReduce and Beyond", 2014).  Rounds end when the
links no longer change.  Links stay in written tables; the driver sees two
numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _least(both: DataFrame) -> DataFrame:
    """``(u, m)``: the least of each node and its neighbours."""
    return both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.where("v > u").join(_least(both), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    near = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``links`` ``(u, v)``: ``root`` is the
    least node that can be reached, in the order of the column."""
    links = written(links.select("u", "v").where("u <> v").distinct(), "links")
    before = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
        links = written(_small_star(written(_large_star(links), "links")), "links")
