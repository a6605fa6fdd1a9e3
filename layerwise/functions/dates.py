"""Calendar helpers that give the same answer whatever the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType


def calendar_date(df: DataFrame, name: str) -> Column:
    """Date part of a timestamp column, independent of ``spark.sql.session.timeZone``.

    Wall-clock timestamps (``TIMESTAMP_NTZ``, what tz-naive Parquet is read as)
    are truncated directly; instants (``TIMESTAMP``) are taken in UTC.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, TimestampType):
        days = F.floor(F.unix_micros(F.col(name)) / F.lit(86_400_000_000)).cast("int")
        return F.date_from_unix_date(days)
    if isinstance(dtype, TimestampNTZType):
        return F.to_date(F.col(name))
    return F.col(name).try_cast("date")


def year_start(year: Column) -> Column:
    """Year number → wall-clock timestamp of 1 January 00:00 (chart time axis)."""
    return F.make_timestamp_ntz(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
