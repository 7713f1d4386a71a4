"""Joins against small per-key tables, with a checked broadcast.

Offset tables (bounds, saved positions, planned ranges) have one row per
``(topic, partition)``; the record side can be 100 TB and one partition can
hold a third of all rows.  A shuffle join on ``(topic, partition)`` would send
that third to one reducer, so the small side is broadcast instead - but only
after its size is *checked*: it is materialised with a reliable
``checkpoint()`` (shared folder, survives executor loss) and counted.  Beyond
the bound the join falls back to a regular shuffle join, where AQE's skew-join
handling splits oversized partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# Largest small side we broadcast (rows).  Offset tables hold one row per
# topic partition; clusters run at most tens of thousands of those.
DEFAULT_MAX_BROADCAST_ROWS = 200_000


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and its lineage cut into the shared checkpoint
    folder (reliable: survives executor loss).  For small derived tables read
    by several branches of a plan, where column pruning would otherwise give
    every branch its own copy of the upstream work."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_small(df: DataFrame) -> tuple[DataFrame, int]:
    """Cut the lineage of a small table into the shared checkpoint folder and
    return it with its exact row count."""
    small = checkpointed(df)
    return small, small.count()


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``big.join(small)`` broadcasting ``small`` when it has at most ``max_rows``."""
    small, n = materialize_small(small)
    if n <= max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
