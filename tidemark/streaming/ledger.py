"""Replay-safe ledger sink: every micro-batch's metric deltas and source
positions in ONE write, keyed by ``(epoch, batch_id)``.

Why this is exactly-once: a micro-batch is identified by ``batch_id`` inside a
checkpoint lifetime (``epoch``).  Each attempt at it writes folders of its own,
and one commit (:mod:`tidemark.streaming.commits`) names the attempt that
counts.  If a crash happens after the write but before the commit, the
restarted query replays the same batch and its new attempt is the one that is
read; after the commit a replay writes nothing.  Readers never see some of a
batch's metrics without the others.  Counters are sums of deltas over the
ledger; distinct users are a union-distinct of the members each batch saw;
positions are the last write per partition.

Layout: ``<path>/metric=<m>/epoch=<e>/batch_id=<b>/attempt=<a>/part-*.parquet``;
reading one metric prunes to its directory.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.logparse import day_key, parse_ok
from tidemark.operators import metrics, offsets
from tidemark.operators.parse import with_log_fields
from tidemark.sources import fs
from tidemark.sources.files import read_parquet_or_empty
from tidemark.streaming import commits

LEDGER_SCHEMA = ("k STRING, site_id STRING, member STRING, delta BIGINT, topic STRING, "
                 "partition INT, until_offset BIGINT, from_offset BIGINT, "
                 "metric STRING, epoch INT, batch_id BIGINT, attempt STRING")
LEDGER_PARTITIONS = ("metric", "epoch", "batch_id", "attempt")
_LEDGER_COLUMNS = ("metric", "k", "site_id", "member", "delta", "topic", "partition",
                   "until_offset", "from_offset", "epoch", "batch_id")

_EMPTY = {"k": "string", "site_id": "string", "member": "string", "delta": "bigint",
          "topic": "string", "partition": "int", "until_offset": "bigint",
          "from_offset": "bigint"}


def ledger_rows(df: DataFrame, metric: str, **cols) -> DataFrame:
    """Rows of one metric in the ledger's column layout (other columns NULL)."""
    out = [F.lit(metric).alias("metric")]
    for name, typ in _EMPTY.items():
        c = cols.get(name)
        out.append((c if c is not None else F.lit(None)).cast(typ).alias(name))
    return df.select(*out)


# grouping_id() of each grouping set over (hour, site_id, day, user_id, topic,
# partition): a bit is 1 when the column is NOT grouped, first column = MSB.
_SETS = {
    "pv": (["hour"], 0b011111),
    "site_pv": (["site_id", "hour"], 0b001111),
    "uv": (["day", "user_id"], 0b110011),
    "offset": (["topic", "partition"], 0b111100),
}
_SET_COLUMNS = ("hour", "site_id", "day", "user_id", "topic", "partition")


def batch_ledger_rows(batch: DataFrame, epoch: int, batch_id: int,
                      line_col: str = "value") -> DataFrame:
    """All ledger rows of one micro-batch of decoded records, from ONE
    aggregation: ``GROUPING SETS ((hour), (site_id, hour), (day, user_id),
    (topic, partition))`` - one Expand, one partial aggregate, one exchange.

    Lines that do not parse still advance the position (they are part of the
    offset range) but count nowhere: ``n`` counts parsed lines only, and metric
    groups with ``n = 0`` are dropped.  Offset rows carry the batch's
    ``[from_offset, until_offset)`` per partition and its record count in
    ``delta``.
    """
    fields = with_log_fields(batch, line_col)
    x = fields.select("topic", "partition", "offset", "hour", "site_id", "user_id",
                      day_key("hour").alias("day"), parse_ok().alias("ok"))
    agg = (x.groupingSets([cols for cols, _ in _SETS.values()], *_SET_COLUMNS)
           .agg(F.count(F.when(F.col("ok"), F.lit(1))).alias("n"),
                F.count(F.lit(1)).alias("records"),
                F.min("offset").alias("from_offset"),
                (F.max("offset") + 1).alias("until_offset"),
                F.grouping_id().alias("gid")))
    gid = F.col("gid")
    metric = F.when(gid == _SETS["pv"][1], F.lit("pv"))
    for name in ("site_pv", "uv", "offset"):
        metric = metric.when(gid == _SETS[name][1], F.lit(name))
    is_offset = gid == _SETS["offset"][1]
    rows = agg.where(is_offset | (F.col("n") > 0)).select(
        metric.alias("metric"),
        F.when(gid == _SETS["uv"][1], F.col("day")).otherwise(F.col("hour")).alias("k"),
        "site_id",
        F.col("user_id").alias("member"),
        F.when(gid == _SETS["uv"][1], F.lit(1))
        .when(is_offset, F.col("records")).otherwise(F.col("n")).cast("bigint").alias("delta"),
        "topic", F.col("partition").cast("int").alias("partition"),
        F.when(is_offset, F.col("until_offset")).cast("bigint").alias("until_offset"),
        F.when(is_offset, F.col("from_offset")).cast("bigint").alias("from_offset"))
    return (rows.withColumn("epoch", F.lit(int(epoch)))
            .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")))


def write_ledger(rows: DataFrame, path: str, attempt: str = commits.ONLY) -> None:
    """Replace what the attempt has of the ``(metric, epoch, batch_id)``
    partitions present in ``rows``."""
    (rows.withColumn("attempt", F.lit(attempt)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*LEDGER_PARTITIONS).parquet(path))


def all_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every row of the ledger, also of attempts that are not committed."""
    return read_parquet_or_empty(spark, LEDGER_SCHEMA, path)


def read_ledger(spark: SparkSession, path: str, mark: tuple[int, int] | None = None) -> DataFrame:
    """The ledger's whole batches (later than ``mark``) with typed partition
    columns (explicit schema, no inference); empty when there are none."""
    return commits.only_committed(spark, all_rows(spark, path), path, mark).select(*_LEDGER_COLUMNS)


# ---------------------------------------------------------------- read views

def ledger_pv(ledger: DataFrame) -> DataFrame:
    """``(hour, pv)``."""
    return (ledger.where(F.col("metric") == "pv")
            .groupBy(F.col("k").alias("hour")).agg(F.sum("delta").alias("pv")))


def ledger_site_pv(ledger: DataFrame) -> DataFrame:
    """``(site_id, hour, pv)``."""
    return (ledger.where(F.col("metric") == "site_pv")
            .groupBy("site_id", F.col("k").alias("hour")).agg(F.sum("delta").alias("pv")))


def ledger_uv_members(ledger: DataFrame) -> DataFrame:
    """``(day, user_id)``: union-distinct of every batch's members."""
    return (ledger.where(F.col("metric") == "uv")
            .select(F.col("k").alias("day"), F.col("member").alias("user_id")).distinct())


def ledger_uv(ledger: DataFrame) -> DataFrame:
    """``(day, uv)``."""
    return metrics.uv_from_members(
        ledger.where(F.col("metric") == "uv")
        .select(F.col("k").alias("day"), F.col("member").alias("user_id")))


def ledger_offset_audit(ledger: DataFrame) -> DataFrame:
    """``(epoch, batch_id, topic, partition, from_offset, until_offset, records)``:
    what every micro-batch read from every partition."""
    return (ledger.where(F.col("metric") == "offset")
            .select("epoch", "batch_id", "topic", "partition", "from_offset", "until_offset",
                    F.col("delta").alias("records")))


def ledger_batch_totals(ledger: DataFrame) -> DataFrame:
    """``(epoch, batch_id, records, events)``: lines each micro-batch read and
    how many of them parsed (page views are counted once per parsed line)."""
    per = ledger.where(F.col("metric").isin("offset", "total")
                       | ((F.col("metric") == "pv") & (F.col("batch_id") >= 0)))
    return per.groupBy("epoch", "batch_id").agg(
        F.sum(F.when(F.col("metric") == "offset", F.col("delta"))).alias("records"),
        F.coalesce(F.sum(F.when(F.col("metric") != "offset", F.col("delta"))), F.lit(0))
        .cast("bigint").alias("events"))


def ledger_positions(ledger: DataFrame) -> DataFrame:
    """``(topic, partition, offset)``: the saved position per partition."""
    rows = ledger.where(F.col("metric").isin("offset", "position")).select(
        "topic", "partition", "until_offset", "epoch", "batch_id")
    return offsets.saved_offsets(rows, keys=())


def saved_positions(spark: SparkSession, path: str, snapshot_path: str | None = None) -> DataFrame:
    """:func:`ledger_positions` without reading the audit that a snapshot keeps:
    its newest positions and the batches after it."""
    if snapshot_path is None:
        return ledger_positions(read_ledger(spark, path))
    def look(mark: tuple[int, int] | None, snap: DataFrame) -> DataFrame:
        return snap.unionByName(read_ledger(spark, path, mark).where(F.col("metric") == "offset"))
    return ledger_positions(_unmoved(spark, snapshot_path, look, ["position"]))


def max_epoch(spark: SparkSession, path: str, snapshot_path: str | None = None) -> int | None:
    """Newest epoch of a ledger, its markers or its snapshot (``None`` when
    there is none).  Folder names are listed, no data is read; batches that are
    not whole count too, as their epoch is taken."""
    root = path.rstrip("/")
    known = fs.partition_values(spark, f"{root}/metric=*/epoch=*", "epoch")
    known += fs.partition_values(spark, f"{commits.log_of(spark, root)}/epoch=*", "epoch")
    if snapshot_path is not None and (mark := snapshot_watermark(spark, snapshot_path)) is not None:
        known.append(mark[0])
    return max(known) if known else None


# ---------------------------------------------------------------- compaction
#
# Read views are decomposable (sums, union-distinct, newest-epoch maximum), so
# the whole batches up to a watermark (epoch, batch_id) can be folded into a
# snapshot; readers take it and the batches after its watermark.  A snapshot is
# kept by metric and day: a compaction writes the days its batches touch and
# refers to the others where they are, so it costs what came since the last one
# and the days that changed.  What each batch read (offset) and parsed (total)
# is added; its parts are merged two of a size at a time, so their number grows
# with the logarithm of the compactions and the audit stays complete.
#
# A compaction writes parts of its own and then creates the manifest of the next
# generation, which names all parts, if there is none: of two at a time one
# wins, and the other starts again from the new manifest.  Retention stays one
# manifest behind, so a reader that holds the one before the newest finds all it
# names; a reader looks at the manifest again after listing the ledger.
#
# Layout: <snapshot>/rows/part=<generation>-<id>/metric=<m>/day=<d> and
# <snapshot>/manifest/generation=<g>/manifest.json.

SNAPSHOT_SCHEMA = ("k STRING, site_id STRING, member STRING, delta BIGINT, topic STRING, partition INT, "
                   "until_offset BIGINT, from_offset BIGINT, epoch INT, batch_id BIGINT, "
                   "part STRING, metric STRING, day STRING")
ADDED = ("offset", "total")
ALL_DAYS = "all"
#: How often a reader looks again, a compaction starts again.
TRIES = 20


def manifest_file(root: str, generation: int) -> str:
    return f"{root.rstrip('/')}/manifest/generation={int(generation)}/manifest.json"


def generations(spark: SparkSession, root: str) -> list[int]:
    """The generations whose manifest is there, in order."""
    return sorted(int(fs.partition_of(f)["generation"]) for f in fs.files(spark, f"{root.rstrip('/')}/manifest/generation=*/manifest.json"))


def read_manifest(spark: SparkSession, root: str, generation: int) -> dict:
    return json.loads(fs.read_text(spark, manifest_file(root, generation)))


def newest_manifest(spark: SparkSession, root: str) -> tuple[int, tuple[int, int], list] | None:
    """Generation, watermark and parts of the newest manifest."""
    known = generations(spark, root)
    if not known:
        return None
    said = read_manifest(spark, root, known[-1])
    return known[-1], tuple(said["through"]), said["parts"]


def put_manifest(spark: SparkSession, root: str, generation: int, through: tuple[int, int], parts: list) -> bool:
    """Make this the manifest of its generation; False when there is one."""
    return fs.put_if_absent(spark, manifest_file(root, generation), json.dumps({"through": list(through), "parts": parts}))


def fence(spark: SparkSession, root: str) -> tuple[int, int] | None:
    """The watermark of the manifest before the newest: what it covers is
    needed by no reader that holds either of the two."""
    known = generations(spark, root)
    return tuple(read_manifest(spark, root, known[-2])["through"]) if len(known) > 1 else None


def new_part(generation: int) -> str:
    return f"{int(generation)}-{uuid.uuid4().hex[:12]}"


def snapshot_watermark(spark: SparkSession, snapshot_path: str) -> tuple[int, int] | None:
    newest = newest_manifest(spark, snapshot_path)
    return None if newest is None else newest[1]


def _snapshot_rows(spark: SparkSession, snapshot_path: str, parts: list,
                   metric_names: list[str] | None = None) -> DataFrame:
    """Rows of the named parts (``metric, day, part, span``); only their
    folders are listed."""
    root = f"{snapshot_path.rstrip('/')}/rows"
    paths = [f"{root}/part={p}/metric={m}/day={fs.escaped(d)}" for m, d, p, _ in parts if metric_names is None or m in metric_names]
    if not paths:
        return spark.createDataFrame([], SNAPSHOT_SCHEMA)
    return spark.read.schema(SNAPSHOT_SCHEMA).option("basePath", root).parquet(*paths)


def read_snapshot(spark: SparkSession, snapshot_path: str, metric_names: list[str] | None = None
                  ) -> tuple[tuple[int, int] | None, DataFrame]:
    """Watermark and rows (the ledger's columns) of the newest snapshot."""
    newest = newest_manifest(spark, snapshot_path)
    if newest is None:
        return None, spark.createDataFrame([], LEDGER_SCHEMA).select(*_LEDGER_COLUMNS)
    return newest[1], _snapshot_rows(spark, snapshot_path, newest[2], metric_names).select(*_LEDGER_COLUMNS)


def _unmoved(spark: SparkSession, snapshot_path: str, look: Callable[[tuple[int, int] | None, DataFrame], DataFrame],
             metric_names: list[str] | None = None) -> DataFrame:
    """``look`` at snapshot and ledger while no compaction moves what lies
    between them: what was listed is taken if the manifest is still the newest."""
    for _ in range(TRIES):
        before = generations(spark, snapshot_path)[-1:]
        seen = look(*read_snapshot(spark, snapshot_path, metric_names))
        if generations(spark, snapshot_path)[-1:] == before:
            return seen
    raise RuntimeError(f"{snapshot_path} was compacted {TRIES} times while it was read")


def read_compacted(spark: SparkSession, ledger_path: str, snapshot_path: str) -> DataFrame:
    """The ledger as seen through its newest snapshot: its rows plus the whole
    batches after its watermark (same columns as :func:`read_ledger`)."""
    return _unmoved(spark, snapshot_path,
                    lambda mark, snap: snap.unionByName(read_ledger(spark, ledger_path, mark)))


def _merged(parts: list) -> tuple[list, list, int]:
    """The added parts of one metric that a new part takes in, the others, and
    the compactions the new one stands for: as binary numbers count."""
    rest, taken, span = sorted(parts, key=lambda p: -p[3]), [], 1
    while rest and rest[-1][3] <= span:
        taken.append(rest.pop())
        span += taken[-1][3]
    return taken, rest, span


def _folded(spark: SparkSession, snapshot_path: str, fresh: DataFrame, parts: list) -> tuple[DataFrame, list, dict]:
    """Rows of the next snapshot that are to be written, the parts that stay,
    and the spans of the added metrics."""
    m = F.col("metric")
    day = F.when(m.isin("pv", "site_pv", "uv"), F.substring("k", 1, 10)).otherwise(F.lit(ALL_DAYS))
    fresh = fresh.where(m.isin("pv", "site_pv", "uv", "offset")).withColumn("day", day)
    folded = fresh.where(m != "offset").select(*_LEDGER_COLUMNS, "day")
    moved = (fresh.where(m == "offset").withColumn("metric", F.lit("position"))
             .select(*_LEDGER_COLUMNS, "day"))
    touched = folded.unionByName(moved)
    # one row for each metric and day that the batches touch
    changed = {(r["metric"], r["day"]) for r in touched.select("metric", "day").distinct().collect()}
    again = [p for p in parts if (p[0], p[1]) in changed and p[0] not in ADDED]
    stay = [p for p in parts if p[0] not in ADDED and (p[0], p[1]) not in changed]
    touched = touched.unionByName(_snapshot_rows(spark, snapshot_path, again).select(*_LEDGER_COLUMNS, "day"))
    sums = (touched.where(m.isin("pv", "site_pv")).groupBy("metric", "day", "k", "site_id")
            .agg(F.sum("delta").alias("delta")))
    members = (touched.where(m == "uv").select("metric", "day", "k", "member").distinct()
               .withColumn("delta", F.lit(1).cast("bigint")))
    positions = (touched.where(m == "position").groupBy("metric", "day", "topic", "partition")
                 .agg(F.max(F.struct("epoch", "until_offset")).alias("last"))
                 .select("metric", "day", "topic", "partition", F.col("last.until_offset").alias("until_offset"),
                         F.col("last.epoch").alias("epoch")))
    audit = fresh.where(m == "offset").select(*_LEDGER_COLUMNS, "day")
    totals = (fresh.where(m == "pv").groupBy("epoch", "batch_id").agg(F.sum("delta").alias("delta"))
              .select(F.lit("total").alias("metric"), F.lit(ALL_DAYS).alias("day"), "epoch", "batch_id", "delta"))
    spans, taken = {}, []
    for name in ADDED:
        mine, others, spans[name] = _merged([p for p in parts if p[0] == name])
        taken += mine
        stay += others
    rows = (sums.unionByName(members, allowMissingColumns=True)
            .unionByName(positions, allowMissingColumns=True)
            .unionByName(audit, allowMissingColumns=True)
            .unionByName(totals, allowMissingColumns=True)
            .unionByName(_snapshot_rows(spark, snapshot_path, taken).select(*_LEDGER_COLUMNS, "day"), allowMissingColumns=True))
    return rows, stay, spans


def compact_ledger(spark: SparkSession, ledger_path: str, snapshot_path: str) -> tuple[int, int] | None:
    """Fold the whole batches since the last snapshot into a new one; returns
    its watermark (the newest one when there is nothing new, ``None`` when
    empty).  Batches that are not committed stay for a later compaction.  The
    ledger itself is not changed: see :func:`retain_ledger`.  Several may run
    at a time, also in a job."""
    root = snapshot_path.rstrip("/")
    for _ in range(TRIES):
        newest = newest_manifest(spark, snapshot_path)
        generation, mark, parts = newest if newest is not None else (-1, None, [])
        top = commits.newest_after(spark, ledger_path, mark)
        if top is None:
            return mark
        fresh = read_ledger(spark, ledger_path, mark).where(~commits.after(top))
        if generations(spark, snapshot_path)[-1:] != ([] if newest is None else [generation]):
            continue   # the ledger was listed after another compaction
        rows, stay, spans = _folded(spark, snapshot_path, fresh, parts)
        part = new_part(generation + 1)
        kinds = [(f.name, f.dataType) for f in spark.createDataFrame([], SNAPSHOT_SCHEMA).schema.fields if f.name != "part"]
        out = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds])
        out = out.withColumn("batch_id", F.coalesce("batch_id", F.lit(-1).cast("bigint")))
        out = out.withColumn("epoch", F.coalesce("epoch", F.lit(top[0])))
        # a folder of its own: two jobs that write into one folder would lose files
        out.write.partitionBy("metric", "day").parquet(f"{root}/rows/part={part}")
        written = [fs.partition_of(f) for f in fs.folders(spark, f"{root}/rows/part={part}/metric=*/day=*")]
        stay += [[p["metric"], p["day"], part, spans.get(p["metric"], 1)] for p in written]
        if put_manifest(spark, snapshot_path, generation + 1, top, sorted(stay)):
            return top
    raise RuntimeError(f"{snapshot_path} was compacted by others {TRIES} times in a row")


def retain_ledger(spark: SparkSession, ledger_path: str, snapshot_path: str) -> int:
    """Remove what neither of the two newest manifests needs: the ledger's
    batches up to the older one's watermark, snapshot parts that neither names
    (also those of compactions that came second), and older manifests.
    Returns the folders removed."""
    gone = commits.remove_covered(spark, ledger_path, "metric=*", fence(spark, snapshot_path))
    root = snapshot_path.rstrip("/")
    known = generations(spark, root)
    named = {tuple(p[:3]) for g in known[-2:] for p in read_manifest(spark, root, g)["parts"]}
    for folder in fs.folders(spark, f"{root}/rows/part=*/metric=*/day=*") if known else []:
        at = fs.partition_of(folder)
        if int(at["part"].split("-")[0]) <= known[-1] and (at["metric"], at["day"], at["part"]) not in named:
            # the last of a part takes the part's folder along
            last = at["part"] not in {p for _, _, p in named}
            fs.remove(spark, folder.split("/metric=")[0] if last else folder)
            gone += 1
    for g in known[:-2]:
        fs.remove(spark, f"{root}/manifest/generation={g}")
        gone += 1
    return gone
