"""Daily active devices: the first start of a device on a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shoptide.functions.times import with_log_date_hour
from shoptide.operators.keyed import first_by_key

DEVICE_DAY = ["mid", "log_date"]


def first_per_device_day(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The earliest start of every device on every day; ``order`` is the time and something unique."""
    return first_by_key(df, DEVICE_DAY, order)


def first_start_times(df: DataFrame) -> DataFrame:
    """Device, day, time and hour of the earliest starts: all that totals need, by a hash aggregate."""
    return with_log_date_hour(df.groupBy(*DEVICE_DAY).agg(F.min("ts").alias("ts")))


def mark_seen(df: DataFrame) -> DataFrame:
    """The (device, day) pairs to remember; adding them again changes nothing."""
    return df.select(*DEVICE_DAY).distinct()


def drop_seen(df: DataFrame, seen: DataFrame) -> DataFrame:
    """Starts of devices not yet seen on that day.

    ``seen`` grows with the number of devices, so it carries no broadcast hint: Spark broadcasts it while its
    measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond that.
    """
    return df.join(seen.select(*DEVICE_DAY), DEVICE_DAY, "left_anti")


def new_active_devices(batch: DataFrame, seen: DataFrame, order: Sequence[str]) -> DataFrame:
    """First starts of a batch, without the devices earlier batches have seen that day.

    The rows are reduced to one per device and day first. All rows of such a pair are either seen or not, so
    the result is that of filtering first, but the join gets unique keys, already hashed the way it needs.
    """
    return drop_seen(first_per_device_day(batch, order), seen)


def counted(df: DataFrame, observation: Observation, name: str = "rows") -> DataFrame:
    """The same rows, counted on the way to whichever action runs."""
    return df.observe(observation, F.count(F.lit(1)).alias(name))


def first_active_day(dau: DataFrame) -> DataFrame:
    """The first day every device was ever active."""
    # Dates, unlike texts, are compared in a hash aggregate, without sorting the rows.
    first = F.min(F.col("log_date").try_cast("date"))
    return dau.groupBy("mid").agg(first.cast("string").alias("first_date"))
