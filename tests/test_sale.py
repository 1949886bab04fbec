from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shoptide.operators import sale
from shoptide.operators.gmv import ingest_orders
from tests.conftest import rows


def orders(spark, *ids):
    values = [(i, "1", "2024-01-15 10:00:00", "u1", "13812345678", 5.0) for i in ids]
    df = spark.createDataFrame(
        values,
        "id string, order_status string, create_time string, user_id string, consignee_tel string, total_amount double",
    )
    return ingest_orders(df).withColumn("order_time", F.col("create_time").cast("timestamp"))


def lines(spark, *values):
    df = spark.createDataFrame(values, "id string, order_id string, delay int")
    return df.withColumns(
        {
            "sku_id": F.lit("s"),
            "sku_name": F.lit("red ring"),
            "order_price": F.when(F.col("id") == "bad", "x").otherwise("1.5"),
            "detail_time": F.lit("2024-01-15 10:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("delay")),
        }
    )


DELAYS = [("a", "1", -100), ("b", "1", -101), ("c", "1", 100), ("d", "1", 101), ("e", "2", 0), ("bad", "1", 0)]


@pytest.mark.parametrize("salts", [1, 4])
def test_partners_are_at_most_the_bound_apart(spark, salts):
    got = sale.join_orders_details(orders(spark, "1", "3"), lines(spark, *DELAYS), 100, salts=salts)
    assert rows(got, "order_detail_id", "order_id", "sku_price", "dt") == [
        ("a", "1", 1.5, "2024-01-15"), ("bad", "1", None, "2024-01-15"), ("c", "1", 1.5, "2024-01-15"),
    ]


def test_without_a_bound_all_lines_join(spark):
    got = sale.join_orders_details(orders(spark, "1"), lines(spark, *DELAYS), bound_s=None)
    assert got.count() == 5


def test_full_outer_equals_sparks(spark):
    info = orders(spark, "1", "3", None)
    detail = lines(spark, *DELAYS, ("n", None, 0))
    got = sale.full_outer(info, detail)
    o = info.select(F.col("id").alias("info_id"), "user_id")
    d = detail.select(F.col("id").alias("order_detail_id"), "order_id")
    want = d.join(o, F.col("order_id") == F.col("info_id"), "full_outer")
    assert rows(got, "info_id", "user_id", "order_detail_id") == rows(want, "info_id", "user_id", "order_detail_id")


def test_pending(spark):
    got = sale.pending(orders(spark, "1", "3"), lines(spark, *DELAYS))
    assert rows(got) == [("line", "e", "2"), ("order", "3", "3")]


def test_unknown_buyers_stay_without_data(spark):
    merged = sale.join_orders_details(orders(spark, "1"), lines(spark, ("a", "1", 0)), None)
    users = spark.createDataFrame(
        [("u1", "VIP", "2000-01-01", "F"), ("u2", "x", None, "M")],
        "id string, user_level string, birthday string, gender string",
    )
    known = sale.enrich_user(merged, users, "2024-01-31").first()
    assert (known.user_id, known.user_age, known.user_gender, known.user_level) == ("u1", 24, "F", "VIP")
    unknown = sale.enrich_user(merged, users.where("id = 'u2'"), "2024-01-31").first()
    assert (unknown.user_id, unknown.user_age, unknown.user_gender, unknown.user_level) == ("u1", None, None, None)


def hot_sides(spark):
    """3,000 lines, a third of them of one order; every order once."""
    order_id = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string"))
    at = F.lit("2024-01-15 10:00:00").cast("timestamp")
    detail = spark.range(3000).select(
        F.col("id").cast("string"), order_id.alias("order_id"), F.col("id").alias("offset"), F.lit("s").alias("sku_id"),
        F.lit("n").alias("sku_name"), F.lit("1").alias("order_price"), at.alias("detail_time"), F.lit(True).alias("new_line"),
    )
    return orders(spark, "hot", *map(str, range(50))).withColumn("new_order", F.lit(True)), detail


def test_hot_orders_have_a_share_of_all_lines(spark):
    _, detail = hot_sides(spark)
    assert rows(sale.hot_orders(detail, 300)) == [("hot", 4)]
    assert rows(sale.hot_orders(detail, 1001)) == []
    assert rows(sale.hot_orders(detail.where("false"), 1)) == []
    # 4,000 orders of one line: none has a share, though each has enough lines
    assert rows(sale.hot_orders(detail.unionByName(detail).withColumn("order_id", F.monotonically_increasing_id().cast("string")), 1)) == []
    nameless = detail.withColumn("order_id", F.lit(None).cast("string"))
    assert rows(sale.hot_orders(nameless, 1)) == []


def test_only_hot_orders_are_copied(spark):
    info, detail = hot_sides(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = sale.join_hot_orders(info, detail, sale.hot_orders(detail, 100), 100)
        tasks = joined.withColumn("task", F.spark_partition_id()).groupBy("order_id").agg(F.count_distinct("task").alias("tasks"), F.count("*").alias("n"))
        by_order = {r.order_id: (r.tasks, r.n) for r in tasks.collect()}
        assert by_order.pop("hot") == (4, 1000)  # all four tasks
        assert {t for t, _ in by_order.values()} == {1} and sum(n for _, n in by_order.values()) == 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    copies = {
        at_least: info.join(sale.hot_orders(detail, at_least), F.col("id") == F.col("hot_id"), "left")
        .agg(F.sum(F.coalesce("parts", F.lit(1)))).first()[0]
        for at_least in (100, 5000)
    }
    assert copies == {100: 50 + 10, 5000: 51}
    plain = sale.join_orders_details(info, detail, 100)
    assert rows(joined, "order_detail_id", "order_id", "dt") == rows(plain, "order_detail_id", "order_id", "dt")


def test_an_order_or_a_buyer_with_most_lines_is_split(spark):
    """With thresholds fit for small data, adaptive execution splits the hot key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5000",
    }
    many = spark.range(40_000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise((F.col("id") % 5000).cast("string")).alias("order_id"),
        F.lit("s").alias("sku_id"), F.lit("n").alias("sku_name"), F.lit("1").alias("order_price"),
    ).repartition(8)
    info = orders(spark, "hot", *[str(i) for i in range(5000)])
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        users = spark.range(5000).select(
            F.col("id").cast("string"), F.lit("2000-01-01").alias("birthday"), F.lit("M").alias("gender"),
            F.lit("x").alias("user_level"),
        ).unionByName(spark.sql("select 'hot' id, '2000-01-01' birthday, 'F' gender, 'y' user_level"))
        buyers = many.withColumnRenamed("order_id", "user_id")
        for joined in (
            sale.join_orders_details(info, many, None),
            sale.full_outer(info, many),
            sale.add_buyer(buyers, users, "2024-01-31"),
        ):
            joined.collect()
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in plan
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_buyers_before_lines_are_buyers_after_lines(spark):
    """Lines, orders and users that come twice, unknown users and lines without an order."""
    info = orders(spark, "1", "1", "2").withColumn("user_id", F.when(F.col("id") == "2", "nobody").otherwise(F.col("user_id")))
    detail = lines(spark, ("a", "1", 0), ("a", "1", 0), ("b", "2", 0), ("c", "9", 0), ("d", None, 0))
    users = spark.createDataFrame([("u1", "2000-01-01", "F", "VIP"), ("u1", "2001-01-01", "M", "NEW")], "id string, birthday string, gender string, user_level string")
    after = sale.enrich_user(sale.join_orders_details(info, detail, bound_s=None), users, "2024-01-31")
    got = sale.sale_details(info, detail, users, "2024-01-31")
    assert got.columns == after.columns and len(rows(got)) == 9
    assert rows(got) == rows(after)
