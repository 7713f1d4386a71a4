"""Per-batch counts and end positions from the running batch itself.

:func:`counted` lets a stream count its records and the lines that parse while
it flows to its sink, and :class:`BatchProgress` writes these counts with the
source's end position when the engine reports the batch: no second pass, no
cache and no job of its own.

A report comes after the batch is committed, so a driver that dies in between
leaves a batch without its row (the ledger's audit has every batch; this is the
cheap view).  A batch that is replayed replaces its row.

Layout: ``<path>/query=<id>/batch_id=<b>/progress.json``.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from tidemark.functions.logparse import parse_ok
from tidemark.operators.landing import stamp_row_date
from tidemark.operators.parse import with_log_fields
from tidemark.sources import fs
from tidemark.sources.files import read_json_or_empty
from tidemark.streaming.runner import run_available

OBSERVED = "tidemark_batch"
SCHEMA = "records BIGINT, events BIGINT, input_rows BIGINT, end_offset STRING, millis BIGINT, query STRING, batch_id BIGINT"


def counted(records: DataFrame) -> DataFrame:
    """The records, observed: how many, and how many parse."""
    return with_log_fields(records).observe(
        OBSERVED, F.count(F.lit(1)).alias("records"), F.count(F.when(parse_ok(), 1)).alias("events")).select(*records.columns)


class BatchProgress(StreamingQueryListener):
    """Writes a row for each batch of the observed queries of a session."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self._ended = spark, path.rstrip("/"), threading.Condition()
        self._done: set[str] = set()
        self.failed: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(OBSERVED)
        if seen is None:
            return
        try:
            said = {"records": seen["records"], "events": seen["events"], "input_rows": p.numInputRows,
                    "end_offset": p.sources[0].endOffset, "millis": p.durationMs.get("triggerExecution")}
            fs.put(self.spark, f"{self.path}/query={p.id}/batch_id={p.batchId}/progress.json", json.dumps(said))
        except Exception as e:  # noqa: BLE001 - the engine only logs what a listener raises
            self.failed = e

    def onQueryTerminated(self, event) -> None:
        with self._ended:
            self._done.add(str(event.runId))
            self._ended.notify_all()

    def wait_for(self, run_id: str, seconds: float = 60) -> None:
        """Until all reports of a run that has ended are written."""
        with self._ended:
            if not self._ended.wait_for(lambda: str(run_id) in self._done, seconds):
                raise TimeoutError(f"no end of run {run_id} was reported in {seconds} s")
        if self.failed is not None:
            raise self.failed


def land_counted(spark: SparkSession, records: DataFrame, landing_path: str, checkpoint: str, progress_path: str):
    """Land a stream by date through the engine's own file sink (exactly once
    by its log), one job a batch, with a progress row for each; returns the
    query that has run."""
    listener = BatchProgress(spark, progress_path)
    spark.streams.addListener(listener)
    try:
        writer: DataStreamWriter = (stamp_row_date(counted(records)).writeStream.format("parquet").partitionBy("pd")
                                    .option("path", landing_path).option("checkpointLocation", checkpoint))
        q = run_available(writer)
        listener.wait_for(q.runId)
        return q
    finally:
        spark.streams.removeListener(listener)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """``(query, batch_id, records, events, input_rows, end_offset, millis)``."""
    return read_json_or_empty(spark, SCHEMA, path).select("query", "batch_id", "records", "events", "input_rows", "end_offset", "millis")
