"""Access-log line parsing as built-in column expressions.

A line is ``<timestamp>|~|<anything>|~|<uri>[|~|...]``.  The parse is
positional and never validates content:

* ``hour``    first 13 characters of field 0 with every ``T`` replaced by ``-``
              (``2020-01-01T10:11:12`` -> ``2020-01-01-10``); NULL when shorter.
* ``user_id`` piece 1 of field 2 split on any of ``=``, ``|``, ``&``.
* ``site_id`` piece 3 of the same split.  Empty strings are valid ids.

Any missing piece yields NULL; a row with a NULL in any of the three fields is
a parse failure (see :mod:`tidemark.operators.parse`).  Everything stays inside
whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the log format the counters job consumes):
#   field separator of a line: the literal three characters  |~|
#   separator inside the uri field: any one of the characters  =  |  &
#   width of the hour key taken from field 0: 13 characters
#   character replaced inside the hour key: T  (replaced by -)
FIELD_SEPARATOR_REGEX = r"\|~\|"
URI_SEPARATOR_REGEX = r"[=|&]"
HOUR_KEY_WIDTH = 13
HOUR_KEY_REPLACE = ("T", "-")

# Positions (0-based) of the pieces read from a split line.
TIMESTAMP_FIELD = 0
URI_FIELD = 2
USER_PIECE = 1
SITE_PIECE = 3


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(line: Column | str) -> Column:
    """Split keeping trailing empty fields (limit -1)."""
    return F.split(_col(line), FIELD_SEPARATOR_REGEX, -1)


def hour_key(timestamp_text: Column | str) -> Column:
    """``yyyy-MM-ddTHH...`` text -> ``yyyy-MM-dd-HH``; NULL when too short."""
    t = _col(timestamp_text)
    src, dst = HOUR_KEY_REPLACE
    return F.when(F.length(t) >= HOUR_KEY_WIDTH,
                  F.replace(F.substring(t, 1, HOUR_KEY_WIDTH), F.lit(src), F.lit(dst)))


def day_key(hour: Column | str) -> Column:
    """Day bucket derived from an hour key: its first 10 characters."""
    return F.substring(_col(hour), 1, 10)


def log_fields(line: Column | str) -> dict[str, Column]:
    """Column expressions for ``hour``, ``user_id`` and ``site_id`` of a line.

    ``F.get`` returns NULL for an out-of-range index (plain ``arr[i]`` raises
    under ANSI mode), which is exactly "missing piece -> drop the line".
    """
    fields = split_fields(line)
    uri = F.split(F.get(fields, F.lit(URI_FIELD)), URI_SEPARATOR_REGEX, -1)
    return {
        "hour": hour_key(F.get(fields, F.lit(TIMESTAMP_FIELD))),
        "user_id": F.get(uri, F.lit(USER_PIECE)),
        "site_id": F.get(uri, F.lit(SITE_PIECE)),
    }


def parse_ok(hour: Column | str = "hour", user_id: Column | str = "user_id",
             site_id: Column | str = "site_id") -> Column:
    return _col(hour).isNotNull() & _col(user_id).isNotNull() & _col(site_id).isNotNull()
