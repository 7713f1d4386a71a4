"""Command-line launcher for the live jobs (``spark-submit`` entry point).

    spark-submit --master yarn --py-files tidemark.zip \
        --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version> \
        tidemark/__main__.py ingest BROKERS TOPIC DB TABLE [--root DIR] [--bounds PATH] [--hive]
    ... tidemark/__main__.py counters  BROKERS TOPIC [--root DIR] [--bounds PATH]
    ... tidemark/__main__.py positions BROKERS TOPIC [--root DIR] [--bounds PATH]
    ... tidemark/__main__.py maintain  TOPIC [DB TABLE] [--root DIR] [--hive]
    python -m tidemark ingest ...            (local)

``--root`` is a shared folder (defaults to ``<spark.checkpoint.dir>/tidemark``)
holding checkpoints, ledgers and landed data.  The consumer group is not an
argument: positions live in the checkpoint and the ledger, keyed by job.

``--bounds`` names a table (Parquet folder) ``(topic, partition, earliest,
latest)`` of the topic, from an admin lookup.  With it, saved positions that
the topic can no longer serve are repaired before the job starts: a new
checkpoint generation is opened at the repaired positions.  ``--hive`` keeps
databases and tables in the Hive metastore of the session, where other
applications see them.

``maintain`` compacts ledger, snapshot and landed data of a topic and removes
what that covers; it may run beside the live jobs.
"""

from __future__ import annotations

import argparse
import re
import sys


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="job", required=True)

    def common(sp):
        sp.add_argument("brokers", help="bootstrap servers, comma separated")
        sp.add_argument("topic")
        sp.add_argument("--root", help="shared folder for checkpoints, ledgers and data")
        sp.add_argument("--trigger", default=None, help="micro-batch interval, e.g. '5 seconds'")
        sp.add_argument("--max-rate-per-partition", type=int, default=None,
                        help="records per partition per second (needs --partitions); applied as a total "
                             "per batch that the source shares out by backlog")
        sp.add_argument("--partitions", type=int, default=None, help="topic partition count")
        sp.add_argument("--bounds", default=None,
                        help="Parquet table (topic, partition, earliest, latest): repair saved positions first")
        sp.add_argument("--hive", action="store_true", help="keep tables in the session's Hive metastore")

    ing = sub.add_parser("ingest", help="topic -> date-partitioned landing table")
    common(ing)
    ing.add_argument("database")
    ing.add_argument("table")
    ing.add_argument("--date-mode", choices=("batch", "row"), default="batch")
    cnt = sub.add_parser("counters", help="page views, site page views, daily users")
    common(cnt)
    cnt.add_argument("--compact-every", type=int, default=None,
                     help="fold the ledger into a snapshot every N batches")
    pos = sub.add_parser("positions", help="record what every batch read")
    common(pos)
    mnt = sub.add_parser("maintain", help="compact and remove what is covered")
    mnt.add_argument("topic")
    mnt.add_argument("database", nargs="?")
    mnt.add_argument("table", nargs="?")
    mnt.add_argument("--root")
    mnt.add_argument("--hive", action="store_true")
    args = p.parse_args(argv)
    if getattr(args, "trigger", None):
        interval_seconds(args.trigger)  # refuse it before anything starts
    return args


_UNITS = {"millisecond": 0.001, "ms": 0.001, "second": 1.0, "sec": 1.0, "s": 1.0,
          "minute": 60.0, "min": 60.0, "m": 60.0, "hour": 3600.0, "h": 3600.0}


def interval_seconds(text: str) -> float:
    """``'5 seconds'``, ``'500 milliseconds'``, ``'1 minute'`` in seconds."""
    m = re.fullmatch(r"\s*([0-9]+(?:\.[0-9]+)?)\s*([a-z]+)\s*", text.lower())
    unit = None if m is None else _UNITS.get(m[2], _UNITS.get(m[2].removesuffix("s")))
    if unit is None or float(m[1]) <= 0:
        raise SystemExit(f"not an interval: {text!r} (e.g. '5 seconds', '500 milliseconds', '1 minute')")
    return float(m[1]) * unit


class Paths:
    """Where a job's outputs are under the root."""

    def __init__(self, root: str, job: str, topic: str, database: str | None = None, table: str | None = None):
        self.ledger = f"{root}/ledger/{job}/{topic}"
        self.snapshot = f"{root}/snapshot/{job}/{topic}"
        self.checkpoints = f"{root}/checkpoints/{job}/{topic}"
        self.rejects = f"{root}/rejects/{topic}"
        self.landing = f"{root}/landing/{database}/{table}"
        self.compacted = f"{root}/compacted/{database}/{table}"


def prepared(spark, args: argparse.Namespace, root: str) -> tuple[Paths, str, dict]:
    """Paths, checkpoint and the options of the job's start, with the saved
    positions checked against the topic's bounds."""
    from tidemark.plans import ingest, live
    from tidemark.sources import kafka

    trigger = args.trigger or ("10 seconds" if args.job == "counters" else "5 seconds")
    most = None
    if args.max_rate_per_partition is not None:
        if args.partitions is None:
            raise SystemExit("--max-rate-per-partition needs --partitions")
        most = kafka.max_offsets_per_trigger(args.max_rate_per_partition, interval_seconds(trigger), args.partitions)
    at = Paths(root, args.job, args.topic, getattr(args, "database", None), getattr(args, "table", None))
    bounds = None if args.bounds is None else spark.read.parquet(args.bounds).where(f"topic = '{args.topic}'")
    newest = None
    if args.job == "ingest":
        newest = ingest.newest_epoch(spark, at.landing, at.ledger, at.compacted, at.snapshot)
    checkpoint = live.choose_checkpoint(spark, at.checkpoints, at.ledger, args.topic, bounds, at.snapshot, newest)
    return at, checkpoint, {"bounds": bounds, "max_offsets_per_trigger": most, "processing_time": trigger,
                            "snapshot_path": at.snapshot, "partitions": args.partitions}


def maintain(spark, args: argparse.Namespace, root: str) -> int:
    """Compact and retain all outputs of a topic; returns the folders removed."""
    from tidemark.plans import ingest
    from tidemark.streaming import ledger

    gone = 0
    for job in ("ingest", "counters", "positions"):
        at = Paths(root, job, args.topic)
        ledger.compact_ledger(spark, at.ledger, at.snapshot)
        gone += ledger.retain_ledger(spark, at.ledger, at.snapshot)
    if getattr(args, "table", None):
        at = Paths(root, "ingest", args.topic, args.database, args.table)
        ingest.compact_landing(spark, at.landing, at.compacted)
        ingest.register_landing(spark, f"{args.database}.{args.table}", at.landing, at.compacted)
        gone += ingest.retain_landing(spark, at.landing, at.compacted)
    return gone


def main(argv: list[str] | None = None) -> None:
    args = parse_args(sys.argv[1:] if argv is None else argv)

    from tidemark.operators import landing
    from tidemark.plans import live
    from tidemark.session import build_session, shared_root

    spark = build_session(app_name=f"tidemark-{args.job}", hive=args.hive)
    root = (args.root or f"{shared_root(spark)}/tidemark").rstrip("/")
    if getattr(args, "database", None):
        landing.create_database(spark, args.database, f"{root}/catalog/{args.database}")
    if args.job == "maintain":
        maintain(spark, args, root)
        return
    at, checkpoint, options = prepared(spark, args, root)
    if args.job == "ingest":
        q = live.start_live_ingest(spark, args.brokers, args.topic, at.landing, at.ledger, checkpoint,
                                   date_mode=args.date_mode, table=f"{args.database}.{args.table}",
                                   compacted_path=at.compacted, **options)
    elif args.job == "counters":
        q = live.start_live_counters(spark, args.brokers, args.topic, at.ledger, checkpoint,
                                     rejects_path=at.rejects, compact_every=args.compact_every, **options)
    else:
        q = live.start_live_positions(spark, args.brokers, args.topic, at.ledger, checkpoint, **options)
    q.awaitTermination()


if __name__ == "__main__":
    main()
