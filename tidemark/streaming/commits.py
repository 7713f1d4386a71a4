"""Commits: which attempt at a batch is the one that counts.

A batch writes its outputs (landed records, ledger rows) into folders of its
own attempt.  Then one commit file, created only if there is none, names the
attempt for all of them: data, date and positions appear together or not at
all.  Of two drivers at the same batch one wins, what the other wrote is never
read, and a replay of a committed batch writes nothing.  A commit costs no
Spark job.

A job has one commit log.  It lies beside its first output; others refer to it
(:func:`share`), so that readers of each find it.

Layout: ``<output>_commits/epoch=<e>/batch_id=<b>/commit.json``, and beside it
what was settled for the batch before its data was written (:func:`settled`).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import fs
from tidemark.sources.files import read_json_or_empty

SCHEMA = "attempt STRING, date STRING, outputs ARRAY<STRING>, epoch INT, batch_id BIGINT"
#: Attempt of a batch that is written by one writer only.
ONLY = "0"
_SHARED, _OUTPUTS, _COVERED = "_shared_with", "_outputs", "_covered"


def commits_path(output: str) -> str:
    return output.rstrip("/") + "_commits"


def log_of(spark: SparkSession, output: str) -> str:
    """The folder of the commit log that speaks for ``output``."""
    own = commits_path(output)
    return fs.read_text(spark, f"{own}/{_SHARED}") or own


def _name(output: str) -> str:
    return hashlib.md5(output.rstrip("/").encode()).hexdigest()


def share(spark: SparkSession, owner: str, output: str) -> None:
    """Let the log of ``owner`` speak for ``output`` as well."""
    log = commits_path(owner)
    if not fs.put_if_absent(spark, f"{commits_path(output)}/{_SHARED}", log) and log_of(spark, output) != log:
        raise ValueError(f"{output} already has the commit log {log_of(spark, output)}")
    for x in (owner, output):
        fs.put_if_absent(spark, f"{log}/{_OUTPUTS}/{_name(x)}", x)


def _batch(spark: SparkSession, output: str, epoch: int, batch_id: int) -> str:
    return f"{log_of(spark, output)}/epoch={int(epoch)}/batch_id={int(batch_id)}"


def mark_committed(spark: SparkSession, output: str, epoch: int, batch_id: int, attempt: str = ONLY, **facts) -> bool:
    """Commit a batch; False when another attempt was committed first."""
    said = json.dumps({"attempt": attempt, **facts})
    return fs.put_if_absent(spark, f"{_batch(spark, output, epoch, batch_id)}/commit.json", said)


def is_committed(spark: SparkSession, output: str, epoch: int, batch_id: int) -> bool:
    return fs.exists(spark, f"{_batch(spark, output, epoch, batch_id)}/commit.json")


def settled(spark: SparkSession, output: str, epoch: int, batch_id: int, what: str, value: Callable[[], str]) -> str:
    """The value that the first attempt at a batch settled on (say, its date);
    ``value`` is asked only where there is none yet."""
    at = f"{_batch(spark, output, epoch, batch_id)}/_{what}"
    if not fs.exists(spark, at):
        fs.put_if_absent(spark, at, value())
    return fs.read_text(spark, at)


def listed(spark: SparkSession, output: str) -> list[tuple[int, int]]:
    """``(epoch, batch_id)`` of the committed batches still listed, in order."""
    at = [fs.partition_of(f) for f in fs.files(spark, f"{log_of(spark, output)}/epoch=*/batch_id=*/commit.json")]
    return sorted((int(p["epoch"]), int(p["batch_id"])) for p in at)


def commits(spark: SparkSession, output: str) -> DataFrame:
    """``(epoch, batch_id, attempt, date)`` of the committed batches still listed."""
    return read_json_or_empty(spark, SCHEMA, log_of(spark, output)).select("epoch", "batch_id", "attempt", "date")


def only_committed(spark: SparkSession, rows: DataFrame, output: str, mark: tuple[int, int] | None = None) -> DataFrame:
    """``rows`` (with ``epoch``, ``batch_id``, ``attempt``) of committed
    attempts later than ``mark``.  The log has a file for each batch since the
    last retention; files up to the mark are not read, as they may go."""
    done = commits(spark, output).where(after(mark))
    return rows.where(after(mark)).join(done, ["epoch", "batch_id", "attempt"], "left_semi")


def after(mark: tuple[int, int] | None) -> Column:
    """Batches later than a watermark ``(epoch, batch_id)``; all for None."""
    if mark is None:
        return F.lit(True)
    e, b = mark
    return (F.col("epoch") > e) | ((F.col("epoch") == e) & (F.col("batch_id") > b))


def newest_after(spark: SparkSession, output: str, mark: tuple[int, int] | None) -> tuple[int, int] | None:
    """The newest committed batch later than ``mark``."""
    return next((x for x in reversed(listed(spark, output)) if mark is None or x > mark), None)


def remove_covered(spark: SparkSession, output: str, layout: str, mark: tuple[int, int] | None) -> int:
    """Remove the batch folders of ``output`` up to ``mark``, of all attempts;
    ``layout`` is the glob above ``epoch=``.  A commit goes when all outputs of
    its log are covered that far, but the newest of each epoch stays: that
    batch may be replayed.  Returns how many folders."""
    if mark is None:
        return 0
    gone = 0
    for folder in fs.folders(spark, f"{output.rstrip('/')}/{layout}".rstrip("/") + "/epoch=*/batch_id=*"):
        at = fs.partition_of(folder)
        if (int(at["epoch"]), int(at["batch_id"])) <= mark:
            fs.remove(spark, folder)
            gone += 1
    log = log_of(spark, output)
    fs.put(spark, f"{log}/{_COVERED}/{_name(output)}", json.dumps(mark))
    names = [f.rpartition("/")[2] for f in fs.files(spark, f"{log}/{_OUTPUTS}/*")] or [_name(output)]
    marks = [fs.read_text(spark, f"{log}/{_COVERED}/{n}") for n in names]
    if None in marks:
        return gone
    upto = min(tuple(json.loads(m)) for m in marks)
    done = listed(spark, output)
    last = {e: b for e, b in done}
    for e, b in done:
        if (e, b) <= upto and b < last[e]:
            fs.remove(spark, f"{log}/epoch={e}/batch_id={b}")
            gone += 1
    return gone
