"""Order intake: date and hour of creation, masked phone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.functions.fields import mask_phone
from shoptide.functions.times import with_order_date_hour


def ingest_orders(orders: DataFrame) -> DataFrame:
    """Order records as they are stored. Narrow: nothing is shuffled."""
    return mask_phone(with_order_date_hour(orders))


def with_month(orders: DataFrame) -> DataFrame:
    """Add ``create_month`` (``yyyy-MM``), which the order table is partitioned by."""
    return orders.withColumn("create_month", F.substring("create_date", 1, 7))
