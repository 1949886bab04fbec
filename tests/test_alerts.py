from __future__ import annotations

import random
from collections import defaultdict

import pytest

from shoptide.operators import alerts
from tests.conftest import rows

EVENT = "mid string, uid string, evid string, itemid string, ts bigint"
KINDS = ["coupon", "coupon", "coupon", "addCart", "addFavor", "clickItem"]


def events(spark, values):
    return spark.createDataFrame(values, EVENT)


def by_hand(values, length_s, slide_s, least):
    """Alerts by looking at every window of every event."""
    length, slide = length_s * 1000, slide_s * 1000
    windows = defaultdict(list)
    for value in values:
        start = value[4] // slide * slide
        while start > value[4] - length:
            windows[value[0], start].append(value)
            start -= slide
    found = []
    for (mid, start), inside in windows.items():
        accounts = {v[1] for v in inside if v[2] == "coupon" and v[1] is not None}
        if len(accounts) >= least and all(v[2] != "clickItem" for v in inside):
            items = {v[3] for v in inside if v[2] == "coupon" and v[3] is not None}
            found.append((mid, sorted(accounts), sorted(items), sorted(v[2] for v in inside), start, start + length))
    return sorted(found, key=repr)


@pytest.mark.parametrize("length_s, slide_s", [(300, 5), (300, 60), (60, 60), (90, 60), (300, 7)])
def test_alerts_match_a_look_at_every_window(spark, length_s, slide_s):
    draw = random.Random(length_s + slide_s)
    values = [
        (
            f"m{draw.randrange(4)}",
            draw.choice([None, *"abcdef"]),
            draw.choice(KINDS if draw.random() < 0.9 else ["clickItem"]),
            draw.choice([None, "i1", "i2", "i3"]),
            draw.randrange(0, length_s * 13_000),
        )
        for _ in range(250)
    ]
    want = by_hand(values, length_s, slide_s, 3)
    assert want
    got = alerts.list_events(alerts.coupon_alerts(events(spark, values), length_s, slide_s))
    assert rows(got) == want


MINUTE = 60_000


@pytest.mark.parametrize(
    "values, alerted",
    [
        ([("m", "a", "coupon", "i", 0), ("m", "b", "coupon", "i", 2 * MINUTE), ("m", "c", "coupon", "j", 4 * MINUTE)], True),
        (
            [("m", "a", "coupon", "i", 0), ("m", "b", "coupon", "i", MINUTE), ("m", "c", "coupon", "i", 2 * MINUTE),
             ("m", "a", "clickItem", "i", MINUTE)],
            False,
        ),
        ([("m", "a", "coupon", "i", 0), ("m", "b", "coupon", "i", 1), ("m", "a", "coupon", "j", 2)], False),
        ([("m", "a", "coupon", "i", 0), ("m", "b", "coupon", "i", 1), ("m", "c", "coupon", "j", 5 * MINUTE)], False),
        ([("m", "a", "coupon", "i", 0), ("m", "b", "coupon", "i", 1), ("n", "c", "coupon", "j", 2)], False),
    ],
)
def test_three_accounts_in_five_minutes_without_a_view(spark, values, alerted):
    assert bool(rows(alerts.coupon_alerts(events(spark, values)))) is alerted


def test_one_document_per_device_and_minute(spark):
    values = [("m", u, "coupon", "i", 1000 * n) for n, u in enumerate("abc")]
    found = alerts.coupon_alerts(events(spark, values))
    documents = rows(alerts.alert_documents(found, "alert"), "doc_id", "ts", "index_name")
    last = {}
    for row in found.collect():
        last[row.ts // MINUTE] = max(row.ts, last.get(row.ts // MINUTE, 0))
    assert documents == sorted((f"m-{m}", ts, "alert-1970-01-01") for m, ts in last.items())
    assert len(documents) == 6


def test_groups_count_every_behaviour(spark):
    values = [("m", "a", "addCart", None, 0), ("m", "a", "addCart", None, 1), ("m", "b", "coupon", "i", 61_000)]
    got = rows(alerts.alert_groups(events(spark, values), 120, 60), "window_start", "window_end", "evid", "n")
    assert got == [
        (-60_000, 60_000, "addCart", 2), (0, 120_000, "addCart", 2), (0, 120_000, "coupon", 1),
        (60_000, 180_000, "coupon", 1),
    ]


def test_no_group_of_events_is_collected(spark):
    plan = alerts.coupon_alerts(events(spark, []))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(ts" not in plan
