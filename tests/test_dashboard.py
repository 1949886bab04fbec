from __future__ import annotations

import json

import pytest

from shoptide.operators import dashboard
from shoptide.operators.dau import first_active_day
from tests.conftest import rows


def dau(spark):
    values = [
        ("a", "2024-01-14", "08"), ("a", "2024-01-15", "08"), ("b", "2024-01-15", "08"), ("c", "2024-01-15", "23"),
        ("b", "2024-01-16", "00"), ("d", "2024-01-16", "00"), ("e", "2024-01-14", "11"),
    ]
    return spark.createDataFrame(values, "mid string, log_date string, log_hour string")


def orders(spark):
    values = [("2024-01-15", "08", 1.1), ("2024-01-15", "08", 2.2), ("2024-01-14", "09", 5.0), ("2024-01-15", "10", None)]
    return spark.createDataFrame(values, "create_date string, create_hour string, total_amount double")


def test_totals(spark):
    assert rows(dashboard.dau_total(dau(spark), "2024-01-15")) == [(3,)]
    assert rows(dashboard.dau_total(dau(spark), "1999-01-01")) == [(0,)]
    assert rows(dashboard.gmv_total(orders(spark), "2024-01-15")) == [(3.3,)]
    assert rows(dashboard.gmv_total(orders(spark), "1999-01-01")) == [(None,)]


def test_hours(spark):
    assert rows(dashboard.dau_hours(dau(spark), "2024-01-15")) == [("08", 2), ("23", 1)]
    assert rows(dashboard.gmv_hours(orders(spark), "2024-01-15")) == [("08", 3.3), ("10", None)]
    maps = {r.log_date: r.hours for r in dashboard.hour_map(dau(spark), "dau").collect()}
    assert maps["2024-01-15"] == {"08": 2, "23": 1}


def test_today_against_yesterday(spark):
    hours = dashboard.today_vs_yesterday(dau(spark), "dau", "2024-01-15")
    assert rows(hours) == [("08", 2, 1), ("11", None, 1), ("23", 1, None)]
    text = dashboard.hours_json(hours).first().value
    assert json.loads(text) == {"yesterday": {"08": 1, "11": 1}, "today": {"08": 2, "23": 1}}
    dense = rows(dashboard.dense_hours(hours))
    assert len(dense) == 24 and dense[0] == ("00", 0, 0) and dense[8] == ("08", 2, 1)
    amounts = dashboard.today_vs_yesterday(orders(spark), "order_amount", "2024-01-15")
    assert rows(amounts) == [("08", 3.3, None), ("09", None, 5.0), ("10", None, None)]


def test_nothing_at_all(spark):
    hours = dashboard.today_vs_yesterday(dau(spark), "dau", "1999-01-01")
    assert json.loads(dashboard.hours_json(hours).first().value) == {"yesterday": {}, "today": {}}
    assert {r[1:] for r in rows(dashboard.dense_hours(hours))} == {(0, 0)}


def test_unknown_metric(spark):
    with pytest.raises(ValueError, match="order_amount"):
        dashboard.today_vs_yesterday(dau(spark), "clicks", "2024-01-15")


def test_cards(spark):
    cards = dashboard.realtime_total(dau(spark), orders(spark), first_active_day(dau(spark)), "2024-01-15")
    assert rows(cards) == [("dau", "新增日活", 3.0), ("new_mid", "新增设备", 2.0), ("order_amount", "新增交易额", 3.3)]
    assert json.loads(dashboard.cards_json(cards.orderBy("value")).first().value) == [
        {"id": "dau", "name": "新增日活", "value": 3.0},
        {"id": "new_mid", "name": "新增设备", "value": 2.0},
        {"id": "order_amount", "name": "新增交易额", "value": 3.3},
    ]
