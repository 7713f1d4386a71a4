"""Column expressions (JVM-side, whole-stage codegen; no Python per row)."""

from tidemark.functions.dates import epoch_millis, log_timestamp_text, partition_date
from tidemark.functions.encode import action_of, record_key, user_log_value
from tidemark.functions.logparse import day_key, hour_key, log_fields, parse_ok, split_fields

__all__ = [
    "epoch_millis", "log_timestamp_text", "partition_date",
    "action_of", "record_key", "user_log_value",
    "day_key", "hour_key", "log_fields", "parse_ok", "split_fields",
]
