"""Log-line parsing as DataFrame operators (same code for batch and stream).

``parse_log`` keeps the lines that yield all three fields; ``parse_rejects``
keeps the complement, so no line is ever lost silently: together they partition
the input.  A NULL line (tombstone) is a reject, not a task failure.

Row selection uses ``inline(CASE WHEN predicate THEN array(struct(...)) END)``
instead of ``where``: a ``where`` on the parsed fields is pushed below the
projection by the optimizer with the field expressions substituted in, so
every regex split would run twice per line (measured 1.2 s vs 0.48 s per 100k
lines).  The generator form evaluates the fields once and emits zero rows
(NULL array) or one row per line, inside whole-stage codegen (0.34 s).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.logparse import log_fields

PARSED_COLUMNS = ("hour", "user_id", "site_id")


def with_log_fields(df: DataFrame, line_col: str = "value") -> DataFrame:
    """All input columns plus ``hour``, ``user_id``, ``site_id`` (NULL when missing)."""
    fields = log_fields(line_col)
    rest = [c for c in df.columns if c not in PARSED_COLUMNS]
    return df.select(*rest, *[fields[c].alias(c) for c in PARSED_COLUMNS])


def _select_rows(df: DataFrame, columns: list, keep_row) -> DataFrame:
    """``columns`` of the rows for which ``keep_row(struct)`` is true, with the
    column expressions evaluated once per input row."""
    row = F.struct(*columns).alias("_row")
    return df.select(row).select(F.inline(F.when(keep_row(F.col("_row")), F.array("_row"))))


def _ok(x) -> Column:
    return x["hour"].isNotNull() & x["user_id"].isNotNull() & x["site_id"].isNotNull()


def parse_log(df: DataFrame, line_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, hour, user_id, site_id)`` for every line that parses."""
    fields = log_fields(line_col)
    cols = [F.col(c) for c in keep] + [fields[c].alias(c) for c in PARSED_COLUMNS]
    return _select_rows(df, cols, _ok).select(*keep, *PARSED_COLUMNS)


def parse_rejects(df: DataFrame, line_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(*keep, <line_col>)`` for every line that does not parse."""
    fields = log_fields(line_col)
    cols = ([F.col(c) for c in keep] + [F.col(line_col)]
            + [fields[c].alias(c) for c in PARSED_COLUMNS])
    return _select_rows(df, cols, lambda x: ~_ok(x)).select(*keep, line_col)
