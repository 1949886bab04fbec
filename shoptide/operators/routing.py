"""Which topic a log line or a row change goes to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import constants as C
from shoptide.functions.records import object_of_pairs, put_key


def stamp_logs(raw: DataFrame, now_ms: Column | None = None, value: str = "value") -> DataFrame:
    """Log lines with the arrival time as ``ts``; lines that are no JSON object are left out."""
    clock = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    return put_key(raw, value, "ts", clock)


def route_logs(
    raw: DataFrame, value: str = "value", startup: str = C.TOPIC_STARTUP, event: str = C.TOPIC_EVENT
) -> DataFrame:
    """Add the topic: starts to one, everything else, typed or not, to the other."""
    kind = F.get_json_object(F.col(value), "$.type")
    return raw.withColumn("topic", F.when(kind == C.STARTUP_TYPE, F.lit(startup)).otherwise(F.lit(event)))


def route_changes(
    changes: DataFrame,
    order_info: str = C.TOPIC_ORDER_INFO,
    order_detail: str = C.TOPIC_ORDER_DETAIL,
    user_info: str = C.TOPIC_USER_INFO,
) -> DataFrame:
    """Row changes that go on, with their topic: new orders, new lines, new and changed users."""
    table, op = F.col("table"), F.col("op")
    topic = (
        F.when((table == C.CDC_ORDER_TABLE) & (op == "INSERT"), F.lit(order_info))
        .when((table == C.CDC_DETAIL_TABLE) & (op == "INSERT"), F.lit(order_detail))
        .when((table == C.CDC_USER_TABLE) & op.isin("INSERT", "UPDATE"), F.lit(user_info))
    )
    rows = changes.where(F.col("entry_type") == C.CDC_ROW_ENTRY)
    return rows.withColumn("topic", topic).where(F.col("topic").isNotNull())


def after_image_json(changes: DataFrame, keep: tuple[str, ...] = ("topic",)) -> DataFrame:
    """The changed row as a JSON object of its columns, all values as text."""
    return changes.select(*keep, object_of_pairs(F.col("after")).alias("value"))
