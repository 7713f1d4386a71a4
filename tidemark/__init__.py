"""tidemark: positioned, replay-safe ingest and traffic metrics on Spark.

Sub-packages
------------
``functions``  column expressions (log-line parsing, date keys, record encoding)
``sources``    table loading, topic/record derivations, Kafka / file stream builders
``operators``  DataFrame -> DataFrame building blocks (parse, metrics, offsets, landing)
``streaming``  Structured Streaming jobs: replay-safe ledger sink, running counters
``plans``      end-to-end jobs composed from the above (ingest, traffic counters, ...)
"""

from tidemark.session import build_session, shared_root, scratch_path

__all__ = ["build_session", "shared_root", "scratch_path"]
