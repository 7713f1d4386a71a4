"""Offset states derived from the record topic, for repair and ledger queries.

A live deployment reads these from the broker and from its own ledger; here
they are computed from :func:`tidemark.sources.derive.topic_records` - through
one per-band audit aggregate, :func:`band_audit` - so that Spark and the SQL
oracle see the same facts:

* :func:`retained_bounds` - the topic after retention removed the first
  quarter of every partition: ``earliest = n div 4``, ``latest = n``.
* :func:`repair_case_positions` - saved positions of a job that covers each
  repair case, chosen per partition (``pmod(partition, 4)``):
  0 -> nothing saved, 1 -> ``n + 10`` (ahead of the topic),
  2 -> ``n div 8`` (behind retention), 3 -> ``n div 2`` (valid).
* :func:`offset_ledger` - ledger rows of two jobs: ``counters`` read the
  topic in offset bands during epoch 0, then restarted from retention in
  epoch 1 with one rate-limited batch (its position moves *backwards*);
  ``landing`` holds the repair cases.
* :func:`crash_after` - a job that fails in the middle of a batch's writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.offsets import KEY, ledger_offset_rows, offset_range_audit
from tidemark.sources import fs
from tidemark.sources.derive import offset_bands
from tidemark.streaming.commits import log_of
from tidemark.streaming.runner import run_batches

# Fixed values of the scenarios (shared with the SQL oracles).
RETENTION_DIVISOR = 4
AHEAD_BY = 10
BEHIND_DIVISOR = 8
VALID_DIVISOR = 2
RESTART_RATE_PER_PARTITION = 10
RESTART_BATCH_SECONDS = 5


def band_audit(records: DataFrame) -> DataFrame:
    """``(band, topic, partition, from_offset, until_offset, records)``: the one
    pass over the records every scenario below is derived from (the same
    DataFrame used several times lets Spark reuse its exchange)."""
    return offset_range_audit(offset_bands(records), ("band",))


def partition_sizes(audit: DataFrame) -> DataFrame:
    return audit.groupBy(*KEY).agg(F.sum("records").alias("n"))


def retained_bounds(audit: DataFrame) -> DataFrame:
    """``(topic, partition, earliest, latest)`` after retention."""
    return partition_sizes(audit).select(
        *KEY, F.expr(f"n div {RETENTION_DIVISOR}").alias("earliest"), F.col("n").alias("latest"))


def repair_case_positions(audit: DataFrame) -> DataFrame:
    """``(topic, partition, until_offset)``: saved positions covering the cases."""
    case = F.pmod(F.col("partition"), F.lit(4))
    until = (F.when(case == 1, F.col("n") + AHEAD_BY)
             .when(case == 2, F.expr(f"n div {BEHIND_DIVISOR}"))
             .when(case == 3, F.expr(f"n div {VALID_DIVISOR}")))
    return (partition_sizes(audit).select(*KEY, until.cast("bigint").alias("until_offset"))
            .where(F.col("until_offset").isNotNull()))


def offset_ledger(audit: DataFrame) -> DataFrame:
    """``(job, topic, partition, until_offset, epoch, batch_id)``."""
    epoch0 = ledger_offset_rows(audit, job="counters", epoch=0, batch_col="band")

    sizes = partition_sizes(audit)
    restart_from = F.expr(f"n div {RETENTION_DIVISOR}")
    epoch1 = sizes.select(
        F.lit("counters").alias("job"), *KEY,
        F.least(F.col("n"), restart_from + RESTART_RATE_PER_PARTITION * RESTART_BATCH_SECONDS)
        .cast("bigint").alias("until_offset"),
        F.lit(1).alias("epoch"), F.lit(0).cast("bigint").alias("batch_id"))

    landing = repair_case_positions(audit).select(
        F.lit("landing").alias("job"), *KEY, "until_offset",
        F.lit(0).alias("epoch"), F.lit(0).cast("bigint").alias("batch_id"))
    return epoch0.unionByName(epoch1).unionByName(landing)


class InjectedFailure(RuntimeError):
    """Raised on purpose (crash and replay scenarios)."""


def crash_after(write, crash_batch: int, *unmarked: str):
    """A ``foreachBatch`` body that fails at the end of ``crash_batch``.  The
    batch's commits of the outputs ``unmarked`` are taken back first, as if
    the job had died between its data and its commit."""
    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == crash_batch:
            for output in unmarked:
                log = log_of(batch.sparkSession, output)
                for commit in fs.files(batch.sparkSession, f"{log}/epoch=*/batch_id={batch_id}/commit.json"):
                    fs.remove(batch.sparkSession, commit)
            raise InjectedFailure(f"injected failure after batch {batch_id}")
    return run


def run_with_crash(records, make_write, checkpoint: str, crash_batch: int, *unmarked: str, resume: bool = True) -> bool:
    """Run a job until it crashes in ``crash_batch``, then (with ``resume``)
    once more on the same checkpoint.  ``records`` and ``make_write`` are
    called for each run.  Returns whether it crashed."""
    crashed = False
    try:
        run_batches(records(), crash_after(make_write(), crash_batch, *unmarked), checkpoint)
    except Exception as e:  # noqa: BLE001 - the stream wraps the failure
        if "injected failure" not in str(e):
            raise
        crashed = True
    if resume:
        run_batches(records(), make_write(), checkpoint)
    return crashed
