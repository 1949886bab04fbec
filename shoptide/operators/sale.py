"""Sale detail: orders joined with their lines, whichever arrives first, and with the buyer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import constants as C
from shoptide import schemas
from shoptide.functions.fields import as_of_day, age_in_years
from shoptide.operators.keyed import missing_in


def _order_part(info: DataFrame, *extra: str) -> DataFrame:
    return info.select(
        F.col("id").alias("order_id"),
        "order_status",
        "create_time",
        F.col("create_date").alias("dt"),
        "user_id",
        *extra,
    )


def _line_part(detail: DataFrame, *extra: str) -> DataFrame:
    return detail.select(
        F.col("id").alias("order_detail_id"),
        F.col("order_id").alias("line_order_id"),
        "sku_id",
        "sku_name",
        F.col("order_price").try_cast("double").alias("sku_price"),
        *extra,
    )


_MERGED = ["order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "sku_price", "sku_name", "dt"]


def join_orders_details(
    info: DataFrame,
    detail: DataFrame,
    bound_s: int | None = C.JOIN_BOUND_S,
    info_time: str = "order_time",
    detail_time: str = "detail_time",
    salts: int = 1,
    of_order: tuple[str, ...] = (),
) -> DataFrame:
    """Every line with its order, if they are at most ``bound_s`` seconds apart.

    With watermarks on both sides this is a stream-stream join that keeps either side just as long as a
    partner may still come. ``bound_s=None`` joins tables whatever their times.

    In batch, adaptive execution splits an order that holds very many lines. A stream has no such help: with
    ``salts`` above 1 the lines of an order go to that many tasks, and the order is sent to each of them.
    ``of_order`` names further columns of ``info`` to carry along.
    """
    timed = bound_s is not None
    orders = _order_part(info, *([info_time] if timed else []), *of_order)
    lines = _line_part(detail, *[c for c in (detail_time, "offset") if timed and c in detail.columns])
    match: Column = F.col("order_id") == F.col("line_order_id")
    if salts > 1:
        orders = orders.withColumn("order_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        lines = lines.withColumn("line_salt", F.pmod(F.xxhash64("order_detail_id"), F.lit(salts)).cast("int"))
        match = match & (F.col("order_salt") == F.col("line_salt"))
    if timed:
        gap = F.make_dt_interval(secs=F.lit(bound_s))
        match = match & F.col(detail_time).between(F.col(info_time) - gap, F.col(info_time) + gap)
    kept = [c for c in (detail_time, "offset") if timed and c in lines.columns]
    return lines.join(orders, match).select(*_MERGED, *of_order, *kept)


# Lines of an order from which on they are joined by several tasks, and the most orders that may be found hot.
HOT_LINES, MOST_HOT = 100_000, 1024


def hot_orders(detail: DataFrame, at_least: int = HOT_LINES) -> DataFrame:
    """Orders with ``at_least`` lines and more than 1 / MOST_HOT of all: ``hot_id``, and ``parts`` to cut their lines into.

    At most MOST_HOT orders can have such a share, whatever the table's size, so the result may be broadcast; the lines
    of any other order are at most that share. Lines are counted with partial sums.
    """
    total = detail.agg(F.count(F.lit(1)).alias("total")).scalar()
    counts = detail.where(F.col("order_id").isNotNull()).groupBy(F.col("order_id").alias("hot_id")).agg(F.count(F.lit(1)).alias("n"))
    shares = counts.where((F.col("n") >= at_least) & (F.col("n") * MOST_HOT > total))
    return shares.select("hot_id", F.least(F.ceil(F.col("n") / at_least), F.lit(MOST_HOT)).cast("int").alias("parts"))


def join_hot_orders(
    info: DataFrame,
    detail: DataFrame,
    hot: DataFrame | None,
    bound_s: int,
    info_time: str = "order_time",
    detail_time: str = "detail_time",
    of_order: tuple[str, ...] = (),
) -> DataFrame:
    """The same as :func:`join_orders_details`, with orders copied only if they are ``hot``, to each part of their lines.

    All other orders are sent once; without ``hot`` all are. Rows of ``info`` and ``detail`` carry ``new_order`` and
    ``new_line`` along.
    """
    orders = _order_part(info, info_time, "new_order", *of_order)
    lines = _line_part(detail, detail_time, "offset", "new_line")
    same = F.col("order_id") == F.col("line_order_id")
    if hot is not None:
        hot = F.broadcast(hot)  # at most MOST_HOT rows
        parts = F.coalesce(F.col("parts"), F.lit(1))
        orders = orders.join(hot, F.col("order_id") == F.col("hot_id"), "left")
        orders = orders.withColumn("order_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("hot_id", "parts")
        lines = lines.join(hot, F.col("line_order_id") == F.col("hot_id"), "left")
        lines = lines.withColumn("line_salt", F.pmod(F.xxhash64("order_detail_id", "offset"), parts).cast("int")).drop("hot_id", "parts")
        same = same & (F.col("order_salt") == F.col("line_salt"))
    gap = F.make_dt_interval(secs=F.lit(bound_s))
    near = F.col(detail_time).between(F.col(info_time) - gap, F.col(info_time) + gap)
    return lines.join(orders, same & near).select(*_MERGED, *of_order, detail_time, "offset", "new_order", "new_line")


def full_outer(info: DataFrame, detail: DataFrame) -> DataFrame:
    """Orders and lines of one batch side by side, either of them possibly absent.

    Spark cannot split a skewed key in a full outer join. Lines with their order are a left join, which it
    can split, and orders without lines an anti join against the distinct order ids of the lines.
    """
    orders = info.select(F.col("id").alias("info_id"), "user_id", "order_status")
    lines = detail.select(F.col("id").alias("order_detail_id"), "order_id", "sku_id")
    with_line = lines.join(orders, F.col("order_id") == F.col("info_id"), "left")
    alone = missing_in(orders.withColumn("order_id", F.col("info_id")), lines, ["order_id"])
    return with_line.unionByName(alone, allowMissingColumns=True)


def pending(info: DataFrame, detail: DataFrame) -> DataFrame:
    """What waits for a partner: lines without an order, and orders without lines."""
    lines = missing_in(detail, info.select(F.col("id").alias("order_id")), ["order_id"])
    orders = missing_in(info, detail.select(F.col("order_id").alias("id")), ["id"])
    return lines.select(F.lit("line").alias("side"), F.col("id").alias("record_id"), "order_id").unionByName(
        orders.select(F.lit("order").alias("side"), F.col("id").alias("record_id"), F.col("id").alias("order_id"))
    )


def add_buyer(df: DataFrame, users: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """Add age, gender and level of ``user_id``; rows of unknown users stay, with null there.

    A user with very many sales is on the left of a left join, where adaptive execution can split them.
    """
    buyer = users.select(
        F.col("id").alias("buyer_id"),
        age_in_years(F.col("birthday"), as_of_day(as_of)).alias("user_age"),
        F.col("gender").alias("user_gender"),
        "user_level",
    )
    joined = df.join(buyer, F.col("user_id") == F.col("buyer_id"), "left")
    return joined.withColumn("user_id", F.coalesce("buyer_id", "user_id")).drop("buyer_id")


BUYER = ("user_gender", "user_age", "user_level")


def sale_details(info: DataFrame, detail: DataFrame, users: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """All lines of a table with their order and its buyer: the rows of a join of both, then :func:`enrich_user`.

    Orders meet their buyers before their lines, so lines are not shuffled once more for the buyer.
    """
    bought = add_buyer(info, users, as_of)
    return join_orders_details(bought, detail, bound_s=None, of_order=BUYER).select(*schemas.SALE_DETAIL_COLUMNS)


def enrich_user(
    sale: DataFrame, users: DataFrame, as_of: Column | str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Sale details complete with their buyer; ``keep`` names columns of ``sale`` to carry along."""
    return add_buyer(sale, users, as_of).select(*schemas.SALE_DETAIL_COLUMNS, *keep)
