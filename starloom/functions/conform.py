"""Column-level conformance rules shared by every silver table.

All helpers return Column expressions built from pyspark.sql.functions so
they stay inside whole-stage codegen; none of them is a UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the outputs depend on (must stay as they are for equal results):
#   local time zone of the business: America/Chicago (the source's 'CST' id
#   observes daylight saving in Spark, so both give the same instants);
#   default for a missing timestamp: 1900-01-01 00:00:00;
#   optional open-ended validity default: 9999-12-31 00:00:00;
#   date keys are formatted yyyyMMdd and cast to INT.
LOCAL_TZ = "America/Chicago"
NULL_TS_DEFAULT = "1900-01-01 00:00:00"
OPEN_END_DEFAULT = "9999-12-31 00:00:00"
DATE_KEY_FORMAT = "yyyyMMdd"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: str | Column) -> Column:
    """Strip leading/trailing spaces (SQL trim semantics: spaces only)."""
    return F.trim(_c(c))


def to_local(c: str | Column, tz: str = LOCAL_TZ) -> Column:
    """UTC instant -> local wall-clock time (read with session tz = UTC)."""
    return F.from_utc_timestamp(_c(c), tz)


def local_date(c: str | Column, tz: str = LOCAL_TZ) -> Column:
    """Calendar date in the local zone, for DATE-typed sources that must not
    be shifted to the previous evening."""
    return F.to_date(F.from_utc_timestamp(_c(c), tz))


def ts_default(c: str | Column, default: str = NULL_TS_DEFAULT) -> Column:
    """Replace a NULL timestamp by a fixed default (typed TIMESTAMP in both
    ANSI modes, unlike a CASE mixing a string and a timestamp)."""
    return F.coalesce(_c(c), F.lit(default).cast("timestamp"))


def hash_key(c: str | Column) -> Column:
    """64-bit surrogate hash of a record id: xxhash64 with Spark's seed 42.
    Type-sensitive: hash an id with the type the source gives it."""
    return F.xxhash64(_c(c))


def change_hash(*cols: str | Column) -> Column:
    """Row-change hash over several columns. xxhash64 skips NULL inputs, so
    ('a', NULL) and (NULL, 'a') would collide; each value is paired with a
    null marker first so the positions stay distinguishable."""
    parts = []
    for c in cols:
        cc = _c(c)
        parts.append(F.struct(cc.isNull().alias("n"), cc.alias("v")))
    return F.xxhash64(*parts)


def date_key(c: str | Column) -> Column:
    """INT yyyyMMdd key of a date or timestamp.

    Same value as date_format(c, 'yyyyMMdd') cast to INT for years 1..9999,
    computed with integer arithmetic instead of formatting and parsing text.
    """
    c = _c(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def audit_ts(as_of: _dt.datetime | None = None) -> Column:
    """Load timestamp. Injectable so tests and reruns are deterministic."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp")
