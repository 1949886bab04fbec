from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from shoptide.operators import dau, keyed, users
from tests.conftest import rows

START = "mid string, log_date string, ts bigint, uid string"


def starts(spark, *values):
    return spark.createDataFrame(list(values), START)


def test_first_start_wins_and_ties_are_settled(spark):
    df = starts(
        spark, ("a", "d1", 5, "x"), ("a", "d1", 3, "z"), ("a", "d1", 3, "y"), ("a", "d2", 9, "x"), ("b", "d1", None, "q")
    )
    want = [("a", "d1", 3, "y"), ("a", "d2", 9, "x"), ("b", "d1", None, "q")]
    assert rows(dau.first_per_device_day(df, ("ts", "uid"))) == want
    assert rows(dau.first_per_device_day(df.repartition(3), ("ts", "uid"))) == want


def test_seen_devices_count_per_day(spark):
    batch = starts(spark, ("a", "d1", 1, "x"), ("a", "d2", 2, "x"), ("b", "d1", 3, "x"), ("b", "d1", 4, "x"))
    seen = dau.mark_seen(starts(spark, ("a", "d1", 0, "x"), ("a", "d1", 0, "x")))
    assert rows(seen) == [("a", "d1")]
    fresh = dau.new_active_devices(batch, seen, ("ts", "uid"))
    assert rows(fresh) == [("a", "d2", 2, "x"), ("b", "d1", 3, "x")]
    filtered_first = dau.first_per_device_day(dau.drop_seen(batch, seen), ("ts", "uid"))
    assert rows(fresh) == rows(filtered_first)


def test_dedup_sends_one_row_per_key_and_does_not_shuffle_again_to_join(spark):
    batch = starts(spark, ("a", "d1", 1, "x"))
    seen = starts(spark, ("b", "d1", 1, "x"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = dau.new_active_devices(batch, seen, ("ts", "uid"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 2


def test_batch_count_is_observed_on_the_way(spark, root):
    seen = Observation("n")
    dau.counted(spark.range(7), seen).write.parquet(f"{root}/out")
    assert seen.get == {"rows": 7}


def test_latest_by_key(spark):
    feed = spark.createDataFrame(
        [("1", "a", 1), ("1", "b", 2), ("2", "c", 1), ("2", "d", None)], "id string, user_level string, seq int"
    )
    assert rows(users.latest_users(feed)) == [("1", "b", 2), ("2", "c", 1)]


def test_lookups(spark):
    people = spark.createDataFrame([("1",), ("2",), ("3",), (None,)], "id string")
    bought = spark.createDataFrame(
        [("1", 10.9, 1), ("1", 20.9, 2), ("1", 30.9, 0), ("2", None, 1)], "id string, amount double, at int"
    )
    assert rows(keyed.exists_in(people, bought, ["id"])) == [("1",), ("2",)]
    assert rows(keyed.missing_in(people, bought, ["id"])) == sorted([("3",), (None,)], key=repr)
    assert rows(keyed.exclude_listed(people, bought, "id")) == sorted([("3",), (None,)], key=repr)
    got = keyed.scalar_lookup(people, bought, "id", "amount", ["at"])
    assert rows(got) == sorted([("1", 20), ("2", 0), ("3", 0), (None, 0)], key=repr)


def user(spark, *values):
    return spark.createDataFrame(
        [(i, f"n{i}", level, "2000-01-01", "M") for i, level in values],
        "id string, login_name string, user_level string, birthday string, gender string",
    )


def test_cache_goes_before_the_table_and_is_filled_from_it(spark):
    cache, table = user(spark, ("1", "cached"), ("9", "only")), user(spark, ("1", "t"), ("2", "t"), ("3", "t"))
    assert rows(users.resolve_users(cache, table), "id", "user_level") == [
        ("1", "cached"), ("2", "t"), ("3", "t"), ("9", "only"),
    ]
    asked = spark.createDataFrame([("1",), ("2",), ("2",), ("7",)], "id string")
    assert rows(users.write_back(cache, table, asked), "id", "user_level") == [
        ("1", "cached"), ("2", "t"), ("9", "only"),
    ]


def test_user_json(spark):
    got = users.user_json(user(spark, ("1", "a"))).select("user_json").first()[0]
    assert got == '{"id":"1","gender":"M","user_level":"a","birthday":"2000-01-01"}'


def test_first_active_day(spark):
    df = spark.createDataFrame([("a", "2024-01-02"), ("a", "2024-01-01"), ("b", "2024-01-02")], "mid string, log_date string")
    assert rows(dau.first_active_day(df)) == [("a", "2024-01-01"), ("b", "2024-01-02")]
    assert df.where(F.col("mid") == "a").count() == 2
