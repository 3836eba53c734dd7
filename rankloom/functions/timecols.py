"""Timestamp helpers that do not depend on the session time zone.

Parquet timestamps arrive as TIMESTAMP_NTZ.  Casting them to TIMESTAMP would read the
wall clock in the session zone (and shift across DST), so the wall clock is rebuilt
as a UTC instant from its fields instead.  All of it stays a native expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def epoch_millis(col: str | Column) -> Column:
    """Milliseconds since 1970-01-01 of a TIMESTAMP_NTZ wall clock read as UTC (truncated)."""
    c = _c(col)
    utc = F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                           F.date_part(F.lit("SECOND"), c),
                           F.lit("UTC"))
    return F.unix_millis(utc)


def year_start_millis(col: str | Column) -> Column:
    """Epoch millis of January 1st (UTC) of the wall clock's year."""
    c = _c(col)
    return F.unix_millis(F.make_timestamp(F.year(c), F.lit(1), F.lit(1), F.lit(0), F.lit(0),
                                          F.lit(0), F.lit("UTC")))
