"""The gate for late records: exact over batches, restarts and replays, and in front of the stateful streams."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from shoptide.plans import streams as S
from shoptide.sources.streams import topic_files
from shoptide.streaming import jobs, lateness
from tests.conftest import rows

T0 = 1705276800000  # 2024-01-15 00:00 UTC


def start(mid, at_s):
    return {"mid": mid, "uid": "u", "type": "startup", "ts": T0 + at_s * 1000}


def gate(spark, topics, root, topic, late_s, event_ms=None):
    raw = topic_files(spark, topic, topics.folder, maxFilesPerTrigger="1")
    time = lateness.json_millis() if event_ms is None else event_ms
    S.finish(lateness.gate_job(raw, topic, time, f"{root}/gate", f"{root}/gate-{topic}", late_s))
    return lateness.gated(spark, topic, f"{root}/gate")


def starts_in_batches(topics):
    topics.send("startup", [start("a", 1000), start("b", 0), {"_raw": "{broken"}, {"mid": "c", "type": "startup"}])
    topics.send("startup", [start("d", 900), start("e", 899), start("f", 5000), {**start("g", 0), "ts": 1_900_000_000_000}])
    topics.send("startup", [start("h", 4900), start("i", 4899)])


ASIDE = [("ahead", 1), ("late", 1), ("late", 2), ("undated", 0), ("undated", 0)]


def test_a_record_is_late_by_the_batches_before_its_own(spark, topics, root):
    """Exactly on the bound is in time; a record of the same batch never makes another late."""
    starts_in_batches(topics)
    gate(spark, topics, root, "startup", 100)
    assert rows(lateness.set_aside(spark, "startup", f"{root}/gate"), "reason", "batch") == ASIDE
    kept = spark.read.schema(lateness.GATED).json(f"{root}/gate/topics/topic=startup")
    assert rows(kept.select(F.get_json_object("value", "$.mid"))) == [(m,) for m in "abdfh"]


def test_a_restart_and_a_replayed_batch_change_nothing(spark, topics, root):
    topics.send("startup", [start("z", 0)])
    gate(spark, topics, root, "startup", 100)
    starts_in_batches(topics)
    gate(spark, topics, root, "startup", 100)
    want = rows(lateness.set_aside(spark, "startup", f"{root}/gate"), "reason", "value")
    for name in ("3", ".3.crc"):
        shutil.move(f"{root}/gate-startup/commits/{name}", f"{root}/lost{name}")
    gate(spark, topics, root, "startup", 100)
    assert rows(lateness.set_aside(spark, "startup", f"{root}/gate"), "reason", "value") == want and len(want) == 5


@pytest.mark.parametrize("salts", [1, 4])
def test_devices_behind_the_gate(spark, topics, root, salts):
    """The state store drops nothing more, however many stateful operators there are."""
    day = 86_400
    for batch in ([("a", 0)], [("b", 10 * day)], [("c", 0), ("d", 9 * day), ("e", 9 * day - 1)], [("d", 9 * day + 5), ("f", 9 * day)]):
        topics.send("startup", [start(*s) for s in batch], at="2024-01-26T00:00:00.000Z")
    stream = jobs.first_starts_stream(gate(spark, topics, root, "startup", day), salts=salts)
    writer = stream.writeStream.format("parquet").option("path", f"{root}/out")
    S.finish(writer.option("checkpointLocation", f"{root}/checkpoint"))
    assert rows(spark.read.parquet(f"{root}/out"), "mid") == [("a",), ("b",), ("d",), ("f",)]


def test_alerts_behind_the_gate(spark, topics, root):
    """A view that comes too late no longer takes back what it would have blocked; it is listed."""

    def event(at_s, evid, uid):
        return {"mid": "m", "uid": uid, "evid": evid, "itemid": "i", "ts": T0 + at_s * 1000}

    topics.send("event", [event(n, "coupon", f"u{n}") for n in range(3)])
    topics.send("event", [event(2000, "addCart", "u")])
    topics.send("event", [event(1, "clickItem", "u9"), event(2100, "addCart", "u")])
    topics.send("event", [{"_raw": jobs.heartbeat(T0 + 9_000_000)}])
    found = jobs.alert_stream(gate(spark, topics, root, "event", 60), late="60 seconds")
    index = S.alert_index(root).create(spark)

    def put(batch, batch_id):
        jobs._put_counted(index, jobs.alerts.alert_documents(jobs.alerts.list_events(batch), "alert"), batch_id)

    S.finish(found.writeStream.foreachBatch(put).option("checkpointLocation", f"{root}/checkpoint"))
    got = rows(index.read(spark), "mid", "events")
    assert got and all(r[0] == "m" and "clickItem" not in r[1] for r in got)
    aside = lateness.set_aside(spark, "event", f"{root}/gate")
    assert rows(aside.select("reason", F.get_json_object("value", "$.evid"))) == [("late", "clickItem")]


def test_sales_behind_the_gate(spark, topics, root):
    """Orders and lines go by their arrival; a line delivered after the bound is listed, the others join."""

    def line(i, order, second):
        return {"id": i, "order_id": order, "sku_name": "x", "order_price": "1", "_at": f"2024-01-15T00:{second // 60:02}:{second % 60:02}.000Z"}

    def order(i, second):
        return {"id": i, "create_time": "2024-01-15 00:00:00", "total_amount": "1", "_at": f"2024-01-15T00:{second // 60:02}:{second % 60:02}.000Z"}

    topics.send("order_info", [order("1", 0), order("2", 900)])
    topics.send("order_detail", [line("a", "1", 5)])
    topics.send("order_detail", [line("b", "2", 905)])
    topics.send("order_detail", [line("c", "1", 6), line("d", "2", 895)])
    arrival = F.unix_millis("timestamp")
    orders, lines = (gate(spark, topics, root, t, 10, arrival) for t in ("order_info", "order_detail"))
    writer = jobs.sale_stream(orders, lines).writeStream.format("parquet").option("path", f"{root}/out")
    S.finish(writer.option("checkpointLocation", f"{root}/checkpoint"))
    assert rows(spark.read.parquet(f"{root}/out"), "order_detail_id", "order_id") == [("a", "1"), ("b", "2"), ("d", "2")]
    assert rows(lateness.set_aside(spark, "order_detail", f"{root}/gate"), "reason", "batch") == [("late", 2)]
