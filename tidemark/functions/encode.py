"""Undelimited user-log encoding of keyed string records.

A user-log record is a string key ``key-<n>`` and a value made of six fields
appended with no separator: partition date, epoch milliseconds, user id, page
id, channel, action.  Built from columns with ``concat`` so it runs in codegen;
the records can then be written to a topic (``tidemark.sources.kafka``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.dates import epoch_millis, partition_date

# Key prefix of produced records, and the two action names.
KEY_PREFIX = "key-"
ACTION_VIEW = "View"
ACTION_REGISTER = "Register"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def record_key(seq: Column | str) -> Column:
    return F.concat(F.lit(KEY_PREFIX), _col(seq).cast("string"))


def user_log_value(ts: Column | str, user_id: Column | str, page_id: Column | str,
                   channel: Column | str, action: Column | str) -> Column:
    return F.concat(
        partition_date(ts),
        epoch_millis(ts).cast("string"),
        _col(user_id).cast("string"),
        _col(page_id).cast("string"),
        _col(channel).cast("string"),
        _col(action).cast("string"),
    )


def action_of(event_type: Column | str, register_types: tuple[str, ...] = ("signup",)) -> Column:
    return F.when(_col(event_type).isin(*register_types), F.lit(ACTION_REGISTER)).otherwise(
        F.lit(ACTION_VIEW))
