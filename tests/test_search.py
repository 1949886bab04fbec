from __future__ import annotations

import json

import pytest

from shoptide.operators import search
from tests.conftest import rows

COLUMNS = "order_detail_id string, sku_name string, user_gender string, user_age int, dt string"


def sales(spark, *people, name="red ring"):
    values = [(f"{n:03d}", name, gender, age, "d1") for n, (gender, age) in enumerate(people)]
    return spark.createDataFrame(values, COLUMNS)


def ratios(df):
    return [v for _, v in rows_in_order(search.gender_ratio(df))], [v for _, v in rows_in_order(search.age_ratio(df))]


def rows_in_order(df):
    return [tuple(r) for r in df.collect()]


def test_bands_have_their_edges(spark):
    df = sales(spark, ("M", 19), ("M", 20), ("F", 29), ("F", 30))
    assert ratios(df) == ([50.0, 50.0], [25.0, 50.0, 25.0])


def test_unknowns_go_to_women_and_the_middle(spark):
    df = sales(spark, ("M", 40), (None, None), ("X", None), (None, 10))
    assert ratios(df) == ([25.0, 75.0], [25.0, 50.0, 25.0])


def test_shares_count_every_gender(spark):
    df = sales(spark, *[("F", 20)] * 5, *[("X", 20)] * 4, *[("M", 20)] * 3)
    assert rows_in_order(search.top_terms(df, "user_gender", 2)) == [("F", 5), ("X", 4)]
    assert ratios(df)[0] == [25.0, 75.0]


def test_shares_count_every_age(spark):
    df = sales(spark, *[("M", age) for age in range(30, 150) for _ in range(2)], *[("M", age) for age in range(1, 20)])
    assert ratios(df)[1] == [7.3, 0.0, 92.7]


def test_no_hits(spark):
    df = sales(spark, ("M", 19))
    report = search.sale_report(df, "blue", 1, 10).first()
    assert report.total == 0 and report.detail == []
    assert [[o.value for o in s.options] for s in report.stat] == [[0.0, 100.0, 0.0], [0.0, 100.0]]
    assert search.sale_report(df, "", 1, 10).first().total == 0


def test_pages(spark):
    df = sales(spark, *[("M", 20)] * 7).repartition(3)
    assert [r.order_detail_id for r in search.page(df, 2, 3).collect()] == ["003", "004", "005"]
    assert [r.order_detail_id for r in search.page(df, 3, 3).collect()] == ["006"]
    assert search.page(df, 4, 3).count() == 0
    with pytest.raises(ValueError):
        search.page(df, 0, 3)


def test_report_text(spark):
    df = sales(spark, ("M", 19), ("F", 33)).union(sales(spark, ("F", 50), name="blue bolt"))
    text = search.sale_report_json(search.sale_report(df, "Ring", 1, 1, date="d1")).first().value
    assert json.loads(text) == {
        "total": 2,
        "stat": [
            {
                "title": "用户年龄占比",
                "options": [
                    {"name": "20岁以下", "value": 50.0},
                    {"name": "20岁到30岁", "value": 0.0},
                    {"name": "30岁及30岁以上", "value": 50.0},
                ],
            },
            {"title": "用户性别占比", "options": [{"name": "男", "value": 50.0}, {"name": "女", "value": 50.0}]},
        ],
        "detail": [
            {"order_detail_id": "000", "sku_name": "red ring", "user_gender": "M", "user_age": 19, "dt": "d1"}
        ],
    }
    assert search.sale_report(df, "ring", 1, 1, date="d2").first().total == 0
    assert rows(search.total_hits(search.search(df, "ring"))) == [(2,)]
