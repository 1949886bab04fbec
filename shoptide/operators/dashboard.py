"""Dashboard figures of a day: totals, hours, today against yesterday."""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import constants as C

# Date column, hour column and value of the metrics the dashboard knows.
METRICS = {
    C.CARD_DAU[0]: ("log_date", "log_hour"),
    C.CARD_ORDER_AMOUNT[0]: ("create_date", "create_hour"),
}


def day_before(date: str) -> str:
    return (Date.fromisoformat(date) - timedelta(days=1)).isoformat()


def _metric(name: str) -> tuple[str, str]:
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}; known: {', '.join(METRICS)}")
    return METRICS[name]


def _amount(condition: Column | None = None) -> Column:
    """Summed up as decimals, so that the order of the rows does not show."""
    cents = F.col("total_amount").cast("decimal(18,2)")
    return F.sum(cents if condition is None else F.when(condition, cents)).cast("double")


def _value(metric: str, condition: Column | None = None) -> Column:
    if metric == C.CARD_ORDER_AMOUNT[0]:
        return _amount(condition)
    return F.count(F.lit(1)) if condition is None else F.nullif(F.count_if(condition), F.lit(0))


def dau_total(dau: DataFrame, date: str) -> DataFrame:
    """Active devices of the day."""
    return dau.where(F.col("log_date") == date).agg(F.count(F.lit(1)).alias("total"))


def gmv_total(orders: DataFrame, date: str) -> DataFrame:
    """Order amount of the day; null without orders."""
    return orders.where(F.col("create_date") == date).agg(_amount().alias("sum_amount"))


def by_day(df: DataFrame, metric: str) -> DataFrame:
    """The metric of every day."""
    day, _ = _metric(metric)
    return df.groupBy(day).agg(_value(metric).alias("value"))


def by_hour(df: DataFrame, metric: str, date: str | None = None) -> DataFrame:
    """The metric by hour, of one day or of every day."""
    day, hour = _metric(metric)
    if date is None:
        return df.groupBy(day, hour).agg(_value(metric).alias("value"))
    return df.where(F.col(day) == date).groupBy(hour).agg(_value(metric).alias("value"))


def dau_hours(dau: DataFrame, date: str) -> DataFrame:
    return by_hour(dau, C.CARD_DAU[0], date).withColumnRenamed("value", "ct")


def gmv_hours(orders: DataFrame, date: str) -> DataFrame:
    return by_hour(orders, C.CARD_ORDER_AMOUNT[0], date).withColumnRenamed("value", "sum_amount")


def hour_map(df: DataFrame, metric: str) -> DataFrame:
    """A map of hour to value for every day; at most 24 entries each."""
    day, hour = _metric(metric)
    entries = F.array_sort(F.collect_list(F.struct(hour, "value")))
    hours = by_hour(df, metric).where(F.col(hour).isNotNull())
    return hours.groupBy(day).agg(F.map_from_entries(entries).alias("hours"))


def today_vs_yesterday(df: DataFrame, metric: str, date: str) -> DataFrame:
    """The metric of the day and of the day before, side by side by hour; null where an hour has none.

    Both days are read in one pass over two date partitions.
    """
    day, hour = _metric(metric)
    before = day_before(date)
    return (
        df.where(F.col(day).isin(before, date))
        .groupBy(F.col(hour).alias("hour"))
        .agg(
            _value(metric, F.col(day) == date).alias("today"),
            _value(metric, F.col(day) == before).alias("yesterday"),
        )
    )


def dense_hours(hours: DataFrame, hour: str = "hour") -> DataFrame:
    """All 24 hours, with 0 where there was nothing."""
    spark = hours.sparkSession
    day = spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias(hour))
    values = [c for c in hours.columns if c != hour]
    # At most 24 rows on either side, whatever the data's size: the other one is already grouped by hour.
    joined = day.join(hours, hour, "left")
    return joined.select(hour, *[F.coalesce(F.col(c), F.lit(0).cast(hours.schema[c].dataType)).alias(c) for c in values])


def hours_json(hours: DataFrame) -> DataFrame:
    """``{"yesterday": {hour: value}, "today": {hour: value}}``, hours without a value left out."""

    def as_map(column: str) -> Column:
        present = F.filter(F.col("entries"), lambda e: e.getField(column).isNotNull())
        pairs = F.transform(present, lambda e: F.struct(e.getField("hour"), e.getField(column)))
        return F.map_from_entries(pairs).alias(column)

    entries = hours.agg(F.array_sort(F.collect_list(F.struct("hour", "today", "yesterday"))).alias("entries"))
    return entries.select(F.to_json(F.struct(as_map("yesterday"), as_map("today"))).alias("value"))


def new_devices(first_seen: DataFrame, date: str) -> DataFrame:
    """Devices whose first day ever is this one, out of a table of (mid, first_date).

    On a table partitioned by ``first_date`` the day is a partition filter.
    """
    return first_seen.where(F.col("first_date") == date).agg(F.count(F.lit(1)).alias("total"))


def _card(card: tuple[str, str], figure: DataFrame) -> DataFrame:
    identity, name = card
    value = F.col(figure.columns[0]).cast("double")
    return figure.select(F.lit(identity).alias("id"), F.lit(name).alias("name"), value.alias("value"))


def realtime_total(dau: DataFrame, orders: DataFrame, first_seen: DataFrame, date: str) -> DataFrame:
    """Three cards of the day: active devices, new devices, order amount. None of them needs other days' rows."""
    return (
        _card(C.CARD_DAU, dau_total(dau, date))
        .unionByName(_card(C.CARD_NEW_DEVICE, new_devices(first_seen, date)))
        .unionByName(_card(C.CARD_ORDER_AMOUNT, gmv_total(orders, date)))
    )


def cards_json(cards: DataFrame) -> DataFrame:
    """The cards as one JSON list, in the dashboard's order."""
    known = [C.CARD_DAU[0], C.CARD_NEW_DEVICE[0], C.CARD_ORDER_AMOUNT[0]]
    place = F.array_position(F.array(*[F.lit(k) for k in known]), F.col("id"))
    listed = F.array_sort(F.collect_list(F.struct(place.alias("place"), F.struct("id", "name", "value").alias("card"))))
    return cards.agg(F.to_json(F.transform(listed, lambda c: c.getField("card"))).alias("value"))
