"""Seeding a new checkpoint from saved positions, with offset repair.

A checkpoint carries its own positions; ``startingOffsets`` is honoured only
when a query starts on a *new* checkpoint.  When saved positions must be
used (a new checkpoint, a migrated job), they are first repaired against the
topic's bounds - a position past the end or before retention restarts at the
earliest offset - and rendered as the ``startingOffsets`` JSON, which must list
every partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.offsets import correct_offsets, starting_offsets_option


def repaired_starting_offsets(bounds: DataFrame, positions: DataFrame, strict: bool = False) -> str:
    """``bounds`` ``(topic, partition, earliest, latest)`` and saved
    ``positions`` ``(topic, partition, offset)`` -> ``startingOffsets`` JSON."""
    return starting_offsets_option(correct_offsets(bounds, positions, strict=strict))
