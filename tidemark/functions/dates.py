"""Date stamps and time conversions used by landing and encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Partition date format of the landing tables (yyyy-MM-dd) and the
# text form of a record timestamp inside a log line (yyyy-MM-dd'T'HH:mm:ss).
PARTITION_DATE_FORMAT = "yyyy-MM-dd"
LOG_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def partition_date(ts: Column | str) -> Column:
    """Per-row processing date from the record's own timestamp.

    Deterministic: a replayed record lands in the same ``pd`` as the first
    attempt, and a batch that straddles midnight splits correctly.
    """
    return F.date_format(_col(ts), PARTITION_DATE_FORMAT)


def log_timestamp_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), LOG_TIMESTAMP_FORMAT)


def epoch_millis(ts: Column | str, local: bool = True) -> Column:
    """Milliseconds since the epoch, truncated.

    ``local=True`` for ``TIMESTAMP_NTZ`` (wall-clock) columns: measured from the
    wall-clock epoch, so the result does not depend on the session time zone.
    ``local=False`` for ``TIMESTAMP`` (instant) columns such as a topic's
    record timestamp.
    """
    if local:
        return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                _col(ts))
    return F.unix_millis(_col(ts))
