from __future__ import annotations

import json

from pyspark.sql import functions as F

from shoptide import schemas
from shoptide.functions import records
from shoptide.operators import routing
from shoptide.sources.streams import parse_changes
from tests.conftest import rows


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_numbers_and_texts_are_taken_alike_and_broken_text_is_left_out(spark):
    raw = texts(spark, '{"mid":"a","ts":5,"other":1}', '{"mid":7,"ts":"6"}', '{"ts":"x"}', "{broken", None, "{}")
    got = rows(records.parse_startup(raw), "mid", "ts")
    assert got == sorted([("a", 5), ("7", 6), (None, None), (None, None)], key=repr)
    assert rows(records.rejected_records(raw, schemas.STARTUP_LOG)) == sorted([("{broken",), (None,)], key=repr)
    checked = records.checked_records(raw, schemas.STARTUP_LOG)
    assert rows(checked.where("reason is not null"), "value", "reason") == sorted([("{broken", "broken"), (None, "broken")], key=repr)
    good = checked.where("reason is null")
    assert rows(good, *schemas.STARTUP_LOG.names) == rows(records.parse_startup(raw), *schemas.STARTUP_LOG.names)


def test_order_amount_comes_as_text(spark):
    raw = texts(spark, '{"id":"1","total_amount":"12.50"}', '{"id":"2","total_amount":3}', '{"id":"3"}')
    assert rows(records.parse_order(raw), "id", "total_amount") == [("1", 12.5), ("2", 3.0), ("3", None)]


def test_text_is_parsed_once(spark):
    for df in (
        records.parse_order(texts(spark, "{}").repartition(2)),
        routing.stamp_logs(texts(spark, "{}").repartition(2), F.lit(1)),
    ):
        assert df._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_stamp_sets_the_time_and_keeps_the_rest(spark):
    raw = texts(spark, '{"a":1,"b":"1","c":{"d":[1,null]},"ts":3}', '{"a":1,"a":2}', "{}", "[1]", "nope", None)
    got = [json.loads(r.value) for r in routing.stamp_logs(raw, F.lit(9)).collect()]
    assert got == [{"a": 1, "b": "1", "c": {"d": [1, None]}, "ts": 9}, {"a": 2, "ts": 9}, {"ts": 9}]


def test_route_by_type(spark):
    raw = texts(spark, '{"type":"startup"}', '{"type":"event"}', "{}")
    assert rows(routing.route_logs(raw), "topic") == [("event",), ("event",), ("startup",)]


def test_changes_that_go_on(spark):
    def change(table, op, entry="ROWDATA", after='[{"name":"id","value":"1"}]'):
        return f'{{"entry_type":"{entry}","table":"{table}","op":"{op}","after":{after}}}'

    raw = texts(
        spark,
        *[
            change(table, op)
            for table in ("order_info", "order_detail", "user_info", "base_sku")
            for op in ("INSERT", "UPDATE", "DELETE")
        ],
        change("order_info", "INSERT", "TRANSACTIONBEGIN"),
        change("user_info", "INSERT", after='[{"name":"id","value":"2"},{"name":"id","value":"3"}]'),
        "junk",
    )
    got = rows(routing.after_image_json(routing.route_changes(parse_changes(raw)), keep=("topic", "op")))
    assert got == [
        ("order_detail", "INSERT", '{"id":"1"}'),
        ("order_info", "INSERT", '{"id":"1"}'),
        ("user_info", "INSERT", '{"id":"1"}'),
        ("user_info", "INSERT", '{"id":"3"}'),
        ("user_info", "UPDATE", '{"id":"1"}'),
    ]
