"""Session defaults and the shared scratch root.

Everything the library writes (landing tables, ledgers, checkpoints, streaming
state) goes under one *shared* folder: the one the cluster names in
``spark.checkpoint.dir``.  On a cluster that folder is a distributed file system
path visible to every executor, so lineage cuts and written tables survive the
loss of any executor.  A machine-local temporary folder is only used when the
setting is absent *and* the master is local (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults applied only when we build the session ourselves.  On a cluster the
# submitter's settings win: ``build_session`` sets only what is unset.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    # AQE: runtime re-planning, partition coalescing, skew splitting and
    # broadcast conversion based on *measured* shuffle sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition values such as pd='2024-01-01' stay strings when a path is read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, hive: bool = False) -> SparkSession:
    """Return a session with the library's defaults.

    Defaults fill in what the submitter left unset (``spark-submit --conf``,
    ``spark-defaults.conf``) and what a session that is already running has not
    set; ``extra`` always holds.  ``hive`` keeps the catalog in the Hive
    metastore, where other applications see its tables.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    conf = dict(LOCAL_DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    running = SparkSession.getActiveSession()
    if running is None and "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()  # under spark-submit: its settings become readable
    given = running.sparkContext.getConf() if running is not None else SparkConf()
    conf = {k: v for k, v in conf.items()
            if given.get(k, None) is None and (running is None or running.conf.get(k, None) is None)}
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Turn on AQE features on an existing session when they are unset.

    Results never depend on session settings: every path read has an explicit
    schema (partition values are not type-inferred) and wall-clock timestamps
    are converted without the session time zone.
    """
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.adaptive.coalescePartitions.enabled"):
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, "true")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    When unset, a local-mode session gets a fresh temporary folder (tests);
    a cluster session raises, because a machine-local folder would not survive
    executor loss and is not visible to other executors.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_ROOTS.get(id(sc))
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared (distributed) folder "
                "for checkpoints and written tables")
        # spark.checkpoint.dir is a static setting; remember the fallback here.
        root = tempfile.mkdtemp(prefix="tidemark-")
        _LOCAL_ROOTS[id(sc)] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "rdd-checkpoints"))
    return root.rstrip("/")


_LOCAL_ROOTS: dict[int, str] = {}


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared root; a fresh sub-folder per call by default."""
    segs = [shared_root(spark), "tidemark"]
    if unique:
        segs.append(uuid.uuid4().hex)
        for scope in _SCOPES:
            scope.folders.append("/".join(segs))
    segs.extend(parts)
    return "/".join(segs)


class Scope:
    """Scratch folders made while it was open."""

    def __init__(self) -> None:
        self.folders: list[str] = []
        self._kept: set[str] = set()

    def keep_last(self) -> str | None:
        """Keep the folder that was made last; returns it."""
        last = self.folders[-1] if self.folders else None
        self._kept.add(last)
        return last

    def owned(self) -> list[str]:
        return [f for f in self.folders if f not in self._kept]


_SCOPES: list[Scope] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scope]:
    """Remove the scratch folders made inside, but for those that are kept.

    For work whose result is written somewhere else (or kept) before the scope
    ends: DataFrames that still read a removed folder fail.
    """
    from tidemark.sources import fs
    scope = Scope()
    _SCOPES.append(scope)
    try:
        yield scope
    finally:
        _SCOPES.remove(scope)
        for folder in scope.owned():
            fs.remove(spark, folder)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable (reliable, in the shared root)."""
    shared_root(spark)
