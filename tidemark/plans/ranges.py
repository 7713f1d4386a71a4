"""Range loop: a job without a checkpoint whose only position store is its
commit log.

Each batch: read the positions of the newest commit, repair them against the
topic's bounds, plan at most ``rate * seconds`` records for EACH partition, read
those ranges, write records and audit, and commit them with the new positions.
What was written but not committed is never read, and the next run plans the
same ranges again; of two loops on one log, one commits a batch and the other
goes on from it.  A partition far behind the others keeps its own rate.

A repair that goes back opens the next epoch, as the newest epoch's positions
are the ones that count.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.landing import stamp_row_date
from tidemark.operators.offsets import correct_offsets, plan_offset_ranges
from tidemark.plans.ingest import write_landed
from tidemark.sources import fs
from tidemark.sources.offset_index import index_bounds, indexed_read, read_index
from tidemark.streaming import commits
from tidemark.streaming.ledger import ledger_rows, write_ledger

Positions = dict[str, dict[str, int]]
POSITIONS_SCHEMA = "topic STRING, partition INT, offset BIGINT"
RANGES_SCHEMA = "topic STRING, partition INT, from_offset BIGINT, until_offset BIGINT"


def newest_commit(spark: SparkSession, output: str) -> tuple[tuple[int, int] | None, Positions]:
    """The newest committed batch and the positions it left; no Spark job."""
    done = commits.listed(spark, output)
    if not done:
        return None, {}
    e, b = done[-1]
    said = json.loads(fs.read_text(spark, f"{commits.log_of(spark, output)}/epoch={e}/batch_id={b}/commit.json"))
    return (e, b), said["positions"]


def seed_positions(spark: SparkSession, output: str, positions: DataFrame) -> None:
    """Take over ``(topic, partition, offset)`` from another job, once."""
    said: Positions = {}
    for r in positions.select("topic", "partition", "offset").collect():   # a row for each partition
        said.setdefault(r["topic"], {})[str(r["partition"])] = r["offset"]
    if not commits.mark_committed(spark, output, 0, 0, positions=said):
        raise ValueError(f"{output} has positions already")


def next_ranges(spark: SparkSession, positions: Positions, bounds: DataFrame, rate: int | None, seconds: int,
                strict: bool = False) -> tuple[list[tuple], bool]:
    """``(topic, partition, from_offset, until_offset)`` of the next batch, one
    for each partition that has something, and whether a repair went back."""
    saved = spark.createDataFrame([(t, int(p), o) for t, ps in positions.items() for p, o in ps.items()], POSITIONS_SCHEMA)
    fixed = correct_offsets(bounds, saved, strict=strict)
    plan = plan_offset_ranges(fixed, bounds, rate, seconds)
    rows = plan.join(fixed.select("topic", "partition", "saved_offset"), ["topic", "partition"]).collect()
    back = any(r["from_offset"] < r["saved_offset"] for r in rows)
    return sorted((r["topic"], r["partition"], r["from_offset"], r["until_offset"]) for r in rows if r["from_offset"] < r["until_offset"]), back


def run_batch(spark: SparkSession, index: str, landing_path: str, ledger_path: str, rate: int | None, seconds: int,
              bounds: DataFrame | None = None, before_commit: Callable[[int, int], None] | None = None) -> bool:
    """One batch; False when there is nothing to read."""
    known = read_index(spark, index)
    newest, positions = newest_commit(spark, landing_path)
    ranges, back = next_ranges(spark, positions, index_bounds(known) if bounds is None else bounds, rate, seconds)
    if not ranges:
        return False
    epoch, batch_id = (0, 0) if newest is None else (newest[0] + 1, 0) if back else (newest[0], newest[1] + 1)
    attempt, seen = uuid.uuid4().hex, Observation("range_batch")
    here = [F.count(F.when((F.col("topic") == t) & (F.col("partition") == p), 1)).alias(f"n{i}") for i, (t, p, *_) in enumerate(ranges)]
    rows = indexed_read(spark, known, spark.createDataFrame(ranges, RANGES_SCHEMA))
    write_landed(stamp_row_date(rows.observe(seen, *here)), landing_path, epoch, batch_id, attempt)
    counted = seen.get   # from the write itself: no second pass
    audit = spark.createDataFrame([(*r, counted[f"n{i}"]) for i, r in enumerate(ranges)], RANGES_SCHEMA + ", records BIGINT")
    write_ledger(ledger_rows(audit, "offset", topic=F.col("topic"), partition=F.col("partition"), until_offset=F.col("until_offset"),
                             from_offset=F.col("from_offset"), delta=F.col("records"))
                 .withColumn("epoch", F.lit(epoch)).withColumn("batch_id", F.lit(batch_id).cast("bigint")), ledger_path, attempt)
    if before_commit is not None:
        before_commit(epoch, batch_id)
    left = {t: dict(ps) for t, ps in positions.items()}
    for t, p, _, until in ranges:
        left.setdefault(t, {})[str(p)] = until
    commits.mark_committed(spark, landing_path, epoch, batch_id, attempt, positions=left, outputs=[landing_path, ledger_path])
    return True


def run_ranges(spark: SparkSession, index: str, landing_path: str, ledger_path: str, rate: int | None, seconds: int,
               bounds: DataFrame | None = None, before_commit: Callable[[int, int], None] | None = None,
               until_idle: bool = True, most_batches: int | None = None) -> int:
    """Batches until nothing is left (or for good, one each ``seconds``, with
    ``until_idle=False``); returns how many were read."""
    commits.share(spark, landing_path, ledger_path)
    done = 0
    while most_batches is None or done < most_batches:
        began = time.monotonic()
        if run_batch(spark, index, landing_path, ledger_path, rate, seconds, bounds, before_commit):
            done += 1
        elif until_idle:
            break
        if not until_idle:
            time.sleep(max(0.0, seconds - (time.monotonic() - began)))
    return done
