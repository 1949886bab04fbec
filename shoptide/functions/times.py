"""Dates and hours of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_text(ts: Column) -> Column:
    """``yyyy-MM-dd`` of a timestamp in the session's time zone."""
    return ts.cast("date").cast("string")


def with_log_date_hour(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Add ``log_date`` (``yyyy-MM-dd``) and ``log_hour`` (``HH``) of epoch milliseconds."""
    at = F.timestamp_millis(ts)
    return df.withColumns({"log_date": date_text(at), "log_hour": F.lpad(F.hour(at).cast("string"), 2, "0")})


def with_order_date_hour(df: DataFrame, create_time: str = "create_time") -> DataFrame:
    """Add ``create_date`` and ``create_hour``, cut out of a ``yyyy-MM-dd HH:mm:ss`` text."""
    halves = F.split(F.col(create_time), " ")
    clock = F.get(halves, F.lit(1))
    return df.withColumns(
        {"create_date": F.get(halves, F.lit(0)), "create_hour": F.get(F.split(clock, ":"), F.lit(0))}
    )


def previous_day(day: Column) -> Column:
    """The day before a ``yyyy-MM-dd`` text, as the same kind of text."""
    return F.date_sub(day.cast("date"), 1).cast("string")


def minute_bucket(ms: Column) -> Column:
    """Whole minutes since the epoch of epoch milliseconds."""
    return F.floor(ms / F.lit(60000)).cast("bigint")
