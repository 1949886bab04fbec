from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.sinks.keyed_table import KeyedTable
from tests.conftest import rows

SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "day", "value")] + [T.StructField("seq", T.LongType())]
)


def table(spark, root, partition="day"):
    return KeyedTable(f"{root}/t", SCHEMA, key="id", partition=partition, order=("seq",)).create(spark)


def files(df):
    """Folders below the table whose files are read."""
    found = df.select(F.input_file_name().alias("f")).distinct().collect()
    return {"/".join(r.f.split("/")[-3:-1]) for r in found}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def batch(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def test_empty_table_and_empty_batch(spark, root):
    t = table(spark, root)
    assert rows(t.read(spark)) == []
    t.write(batch(spark), 0)
    assert rows(t.read(spark)) == []


def test_later_batches_win_and_days_are_apart(spark, root):
    t = table(spark, root)
    t.write(batch(spark, ("1", "d1", "a", 9), ("1", "d1", "b", 8), ("2", "d1", "c", 1)), 0)
    t.write(batch(spark, ("1", "d1", "d", 0), ("1", "d2", "e", 0)), 1)
    t.create(spark)
    assert rows(t.read(spark), "id", "day", "value") == [("1", "d1", "d"), ("1", "d2", "e"), ("2", "d1", "c")]
    assert rows(t.history(spark, before_batch=1), "value") == [("a",), ("b",), ("c",)]


def test_a_replayed_batch_changes_nothing(spark, root):
    t = table(spark, root)
    again = batch(spark, ("1", "d1", "a", 0), (None, "d1", "x", 0))
    for _ in range(3):
        t.write(again, 5)
    assert rows(t.read(spark), "id", "value") == sorted([("1", "a"), (None, "x")], key=repr)


def test_rows_without_a_key_all_stay(spark, root):
    t = table(spark, root)
    t.write(batch(spark, (None, "d1", "x", 0), (None, "d1", "x", 0), ("1", "d1", "a", 0)), 0)
    t.write(batch(spark, (None, "d1", "y", 0)), 1)
    assert rows(t.read(spark), "value") == [("a",), ("x",), ("x",), ("y",)]


def test_only_wanted_days_and_keys_are_read(spark, root):
    t = table(spark, root)
    t.write(batch(spark, ("1", "d1", "a", 0), ("2", "d1", "b", 0), ("1", "d2", "c", 0)), 0)
    assert files(t.history(spark, ["d1", "d9"])) == {"day=d1/batch_id=0"}
    assert rows(t.read(spark, ["d1"]), "id") == [("1",), ("2",)]
    assert rows(t.read(spark, ["d9"])) == []
    wanted = spark.createDataFrame([("1",), ("1",), ("7",)], "id string")
    assert rows(t.read(spark, only=wanted), "id", "day") == [("1", "d1"), ("1", "d2")]


def test_without_days(spark, root):
    t = table(spark, root, partition=None)
    t.write(batch(spark, ("1", "d1", "a", 0)), 0)
    t.write(batch(spark, ("1", "d2", "b", 0)), 1)
    assert rows(t.read(spark), "id", "value") == [("1", "b")]


def test_buckets_of_wanted_keys_alone_are_read(spark, root):
    t = KeyedTable(f"{root}/b", SCHEMA, key="id", order=("seq",), buckets=16).create(spark)
    t.write(batch(spark, *[(str(i), "d", f"v{i}", 0) for i in range(100)]), 0)
    t.write(batch(spark, ("7", "d", "new", 0)), 1)
    wanted = spark.createDataFrame([("7",), ("8",)], "id string")
    found = t.read(spark, only=wanted)
    assert rows(found, "id", "value") == [("7", "new"), ("8", "v8")]
    assert len({f.split("/")[0] for f in files(t.history(spark, [r[0] for r in wanted.select(t._bucket()).collect()]))}) <= 2
    assert "bucket" in plan_of(found).split("PartitionFilters: [")[1].split("]")[0]
    assert rows(t.read(spark), "id") == sorted((str(i),) for i in range(100))


def test_a_rewritten_table_holds_the_current_rows(spark, root):
    t = table(spark, root)
    for n, value in enumerate("abc"):
        t.write(batch(spark, ("1", "d1", value, 0), (None, "d1", value, 0), ("2", "d2", value, 0)), n)
    new = t.rewritten(spark, f"{root}/new")
    assert rows(new.read(spark)) == rows(t.read(spark))
    assert rows(new.history(spark), "id").count(("1",)) == 1
    new.write(batch(spark, ("1", "d1", "d", 0)), 0)
    assert ("1", "d") in rows(new.read(spark, ["d1"]), "id", "value")


def test_rows_without_a_day(spark, root):
    t = table(spark, root)
    t.write(batch(spark, ("1", None, "a", 0), ("2", "d1", "b", 0)), 0)
    t.write(batch(spark, ("1", None, "c", 0)), 1)
    assert rows(t.read(spark, [None]), "id", "value") == [("1", "c")]
    assert rows(t.read(spark, [None, "d1"]), "id") == [("1",), ("2",)]


def test_a_batch_of_one_day_is_written_where_it_is(spark, root):
    t = table(spark, root)
    t.write(batch(spark, *[(str(i), "d1", "v", i) for i in range(30)]).repartition(3), 0, spread=False)
    assert len(list(Path(f"{root}/t/day=d1/batch_id=0").glob("*.parquet"))) == 3
    assert t.read(spark).count() == 30
