"""Streams in several batches equal the same operators on the whole table, also after restarts and replays."""

from __future__ import annotations

import shutil
import time
from pathlib import Path
from random import Random

import pytest
from pyspark.sql import functions as F

from shoptide import schemas
from shoptide.functions.records import checked_records, parse_event, parse_startup
from shoptide.functions.times import with_log_date_hour
from shoptide.operators import alerts, dau
from shoptide.plans import streams as S
from shoptide.session import removing_shuffles
from shoptide.sinks import outputs
from shoptide.sinks.keyed_table import KeyedTable
from shoptide.sources.streams import topic_files
from shoptide.streaming import jobs
from tests.conftest import SF_DIR, rows

T0 = 1705276800000  # 2024-01-15 00:00 UTC


def start(mid, at_s, uid="u"):
    return {"mid": mid, "uid": uid, "type": "startup", "ts": T0 + at_s * 1000}


BATCHES = [
    [start("a", 50, "late"), start("a", 10), start("b", 20), {"_raw": "{broken"}],
    [start("a", 5), start("c", 30), start("c", 25), start("a", 86_400)],
    [start("c", 1), start("d", 40), start("b", 86_401)],
]
FIRST = [
    ("a", "2024-01-15", T0 + 10_000), ("a", "2024-01-16", T0 + 86_400_000), ("b", "2024-01-15", T0 + 20_000),
    ("b", "2024-01-16", T0 + 86_401_000), ("c", "2024-01-15", T0 + 25_000), ("d", "2024-01-15", T0 + 40_000),
]


def dau_run(spark, topics, root, detail, seen):
    raw = topic_files(spark, "startup", topics.folder, maxFilesPerTrigger="1")
    S.finish(jobs.dau_job(raw, detail, seen, f"{root}/checkpoint"))


def test_dau_over_batches_and_a_restart(spark, topics, root):
    detail, seen = (t.create(spark) for t in S.dau_tables(root))
    topics.send("startup", BATCHES[0])
    topics.send("startup", BATCHES[1])
    dau_run(spark, topics, root, detail, seen)
    topics.send("startup", BATCHES[2])
    dau_run(spark, topics, root, detail, seen)
    dau_run(spark, topics, root, detail, seen)
    assert rows(detail.read(spark), "mid", "log_date", "ts") == FIRST
    assert rows(detail.history(spark), "mid", "log_date", "ts") == FIRST
    assert rows(seen.read(spark), "mid", "log_date") == [r[:2] for r in FIRST]


def test_dau_replay_after_a_lost_commit(spark, topics, root):
    """The last batch ran but its commit was lost, so it runs again, over what it has already written."""
    detail, seen = (t.create(spark) for t in S.dau_tables(root))
    topics.send("startup", BATCHES[0])
    topics.send("startup", BATCHES[1])
    topics.send("startup", BATCHES[2])
    dau_run(spark, topics, root, detail, seen)
    commits = f"{root}/checkpoint/commits"
    shutil.move(f"{commits}/2", f"{root}/lost")
    shutil.move(f"{commits}/.2.crc", f"{root}/lost.crc")
    dau_run(spark, topics, root, detail, seen)
    assert rows(detail.history(spark), "mid", "log_date", "ts") == FIRST
    assert rows(seen.history(spark), "mid", "log_date") == [r[:2] for r in FIRST]


@pytest.mark.parametrize("salts", [1, 3])
def test_dau_in_the_state_store(spark, topics, root, salts):
    for batch in BATCHES:
        topics.send("startup", batch)
    raw = topic_files(spark, "startup", topics.folder, maxFilesPerTrigger="1")
    writer = jobs.first_starts_stream(raw, salts=salts).writeStream.format("parquet").option("path", f"{root}/out")
    S.finish(writer.option("checkpointLocation", f"{root}/checkpoint"))
    assert rows(spark.read.parquet(f"{root}/out"), "mid", "log_date") == [r[:2] for r in FIRST]


def by_state(spark, topics, root, detail):
    raw = topic_files(spark, "startup", topics.folder, maxFilesPerTrigger="1")
    query = jobs.start(jobs.dau_state_job(raw, detail, f"{root}/checkpoint"), every_s=None)
    query.awaitTermination()
    return query


def test_dau_by_state_puts_what_the_table_of_seen_devices_puts(spark, topics, root):
    """The earliest of the first batch, over batches, a restart and a batch that is run again."""
    detail = S.dau_tables(root)[0].create(spark)
    topics.send("startup", [*BATCHES[0], {"mid": "x", "uid": "u", "type": "startup"}])
    topics.send("startup", BATCHES[1])
    by_state(spark, topics, root, detail)
    topics.send("startup", BATCHES[2])
    by_state(spark, topics, root, detail)
    assert rows(detail.history(spark), "mid", "log_date", "ts") == FIRST
    commits = f"{root}/checkpoint/commits"
    last = max(int(f.name) for f in Path(commits).iterdir() if f.name.isdigit())
    shutil.move(f"{commits}/{last}", f"{root}/lost")
    shutil.move(f"{commits}/.{last}.crc", f"{root}/lost.crc")
    by_state(spark, topics, root, detail)
    assert rows(detail.history(spark), "mid", "log_date", "ts") == FIRST
    keys = rows(detail.history(spark).where("mid = 'a'"), "uid", "log_hour", "offset")
    assert keys == [("u", "00", 1), ("u", "00", 1002 + 1)]


def test_a_batch_costs_the_same_however_full_the_day_is(spark, topics, root):
    """Batches of ten starts: ten rows read, ten of the state touched, no table of seen devices beside."""
    detail = S.dau_tables(root)[0].create(spark)
    for batch in range(5):
        topics.send("startup", [start(f"d{batch}-{i}", batch * 10 + i) for i in range(8)] + [start(f"d0-{i}", 3600 + batch) for i in range(2)])
    query = by_state(spark, topics, root, detail)
    done = [p for p in query.recentProgress if p.numInputRows]
    assert [p.numInputRows for p in done] == [10] * 5
    states = [p.stateOperators[0] for p in done]
    assert [s.numRowsUpdated for s in states] == [8, 10, 10, 10, 10]
    assert detail.history(spark).count() == 40


def test_starts_that_state_passes_over_are_kept(spark, topics, root):
    topics.send("startup", [start("a", 0), {"_raw": "{broken"}, {"mid": "m", "type": "startup"}, start("b", 10 * 86_400)])
    rejects = jobs.reject_table(f"{root}/rejects").create(spark)
    raw = topic_files(spark, "startup", topics.folder)
    S.finish(jobs.reject_job(raw, jobs.unusable_starts, rejects, f"{root}/checkpoint"))
    assert rows(rejects.read(spark), "reason") == [("ahead",), ("broken",), ("no time",)]


def test_dau_stream_equals_the_table(spark, topics, root):
    detail, seen = (t.create(spark) for t in S.dau_tables(root))
    for batch in BATCHES:
        topics.send("startup", batch)
    S.finish(jobs.dau_job(topic_files(spark, "startup", topics.folder), detail, seen, f"{root}/checkpoint"))
    whole = parse_startup(spark.read.json(f"{topics.folder}/topic=startup"))
    want = dau.first_per_device_day(with_log_date_hour(whole), ("ts", "uid"))
    assert rows(detail.read(spark), *want.columns) == rows(want)


def test_what_has_no_day_is_set_aside_however_batches_are_cut(spark, topics, root):
    """A batch of starts without a time only, and one of both kinds."""
    undated = {"mid": "x", "uid": "u", "type": "startup"}
    detail, seen = (t.create(spark) for t in S.dau_tables(root))
    rejects = jobs.reject_table(f"{root}/rejects").create(spark)
    topics.send("startup", [undated])
    topics.send("startup", [undated, start("a", 1), {"_raw": "{broken"}])
    raw = topic_files(spark, "startup", topics.folder, maxFilesPerTrigger="1")
    S.finish(jobs.dau_job(raw, detail, seen, f"{root}/checkpoint", rejects))
    assert rows(detail.history(spark), "mid", "log_date") == [("a", "2024-01-15")]
    assert rows(rejects.read(spark), "reason") == [("broken",), ("no time",), ("no time",)]


def test_a_clock_in_the_future_does_not_make_others_late(spark, topics, root):
    topics.send("startup", [{**start("z", 0), "ts": 1_900_000_000_000}, start("a", 1)])
    topics.send("startup", [start("b", 2)])
    raw = topic_files(spark, "startup", topics.folder, maxFilesPerTrigger="1")
    writer = jobs.first_starts_stream(raw).writeStream.format("parquet").option("path", f"{root}/out")
    S.finish(writer.option("checkpointLocation", f"{root}/checkpoint"))
    assert rows(spark.read.parquet(f"{root}/out"), "mid") == [("a",), ("b",)]


def test_orders_are_put_by_id(spark, topics, root):
    table = S.order_table(root).create(spark)

    def order(i, amount):
        return {"id": i, "total_amount": str(amount), "create_time": "2024-01-15 09:30:00", "consignee_tel": "13812345678"}

    topics.send("order_info", [order("1", 1), order("2", 2), order("1", 3)])
    topics.send("order_info", [order("2", 4)])
    raw = topic_files(spark, "order_info", topics.folder, maxFilesPerTrigger="1")
    S.finish(jobs.gmv_job(raw, table, f"{root}/checkpoint"))
    got = rows(table.read(spark), "id", "total_amount", "create_date", "create_hour", "consignee_tel")
    assert got == [("1", 3.0, "2024-01-15", "09", "1381*******"), ("2", 4.0, "2024-01-15", "09", "1381*******")]


def test_users_keep_their_latest_record(spark, topics, root):
    table = S.user_table(root).create(spark)
    topics.send("user_info", [{"id": "1", "user_level": "a"}, {"id": "2", "user_level": "b"}])
    topics.send("user_info", [{"id": "1", "user_level": "c"}, {"id": "1", "user_level": "d"}])
    raw = topic_files(spark, "user_info", topics.folder, maxFilesPerTrigger="1")
    S.finish(jobs.user_job(raw, table, f"{root}/checkpoint"))
    assert rows(table.read(spark), "id", "user_level") == [("1", "d"), ("2", "b")]


def event(mid, uid, evid, at_s, item="i"):
    return {"mid": mid, "uid": uid, "evid": evid, "itemid": item, "ts": T0 + at_s * 1000}


def test_alert_stream_equals_the_table(spark, topics, root):
    topics.send("event", [event("m", "a", "coupon", 0), event("n", "a", "coupon", 3), event("m", "b", "addCart", 30)])
    topics.send("event", [event("m", "b", "coupon", 60, "j"), event("n", "b", "coupon", 65), event("n", "b", "clickItem", 66)])
    topics.send("event", [event("m", "c", "coupon", 120), event("n", "c", "coupon", 121), event("m", "c", "coupon", 122)])
    topics.send("event", [event(None, u, "coupon", 130) for u in "abc"])  # no device, no alert
    topics.send("event", [{"_raw": jobs.heartbeat(T0 + 2_000_000)}])
    options = {"length_s": 300, "slide_s": 20}
    raw = topic_files(spark, "event", topics.folder, maxFilesPerTrigger="1")
    index = S.alert_index(root).create(spark)
    S.finish(jobs.alert_job(raw, index, f"{root}/checkpoint", **options))
    whole = parse_event(spark.read.json(f"{topics.folder}/topic=event"))
    want = alerts.alert_documents(alerts.list_events(alerts.coupon_alerts(whole, **options)))
    columns = ["doc_id", "mid", "uids", "item_ids", "events", "ts", "index_name"]
    assert rows(index.read(spark), *columns) == rows(want, *columns)
    assert want.count() == 4


def test_events_that_alerts_pass_over_are_kept(spark, topics, root):
    ahead = event("m", "a", "coupon", 10 * 86_400)
    topics.send("event", [event("m", "a", "coupon", 0), {"_raw": "{broken"}, {"mid": "m", "evid": "coupon"}, ahead])
    topics.send("event", [{"_raw": "also broken"}])
    rejects = jobs.reject_table(f"{root}/rejects").create(spark)
    raw = topic_files(spark, "event", topics.folder, maxFilesPerTrigger="1")
    for _ in range(2):  # the second time there is nothing new
        S.finish(jobs.reject_job(raw, jobs.unusable_events, rejects, f"{root}/checkpoint"))
    found = rows(rejects.read(spark), "reason", "value")
    assert [r[0] for r in found] == ["ahead", "broken", "broken", "no time"]
    assert ("broken", "{broken") in found and ("no time", '{"mid": "m", "evid": "coupon"}') in found


def test_changes_without_a_type_are_kept(spark, topics, root):
    topics.send("log", [{"entry_type": "ROWDATA", "table": "t"}, {"table": "t"}, {"_raw": "junk"}])
    rejects = jobs.reject_table(f"{root}/rejects").create(spark)
    S.finish(jobs.reject_job(topic_files(spark, "log", topics.folder), jobs.unusable_changes, rejects, f"{root}/checkpoint"))
    assert rows(rejects.read(spark), "value") == [("junk",), ('{"table": "t"}',)]


def test_a_batch_of_a_job_with_rejects_is_read_once(spark, topics, root):
    """Parsed once too: both outputs come from the kept batch."""
    plans = []
    topics.send("user_info", [{"id": "1", "user_level": "a"}, {"_raw": "{broken"}])
    table, rejects = S.user_table(root).create(spark), jobs.reject_table(f"{root}/rejects").create(spark)
    batch = spark.read.schema("value string, offset long").json(f"{topics.folder}/topic=user_info")
    checked = checked_records(batch, schemas.USER_INFO, keep=("offset",))
    with jobs._usable(checked, rejects, 0) as users:
        table.write(users, 0)
        plans.append(users._jdf.queryExecution().executedPlan().toString())
    assert "InMemoryTableScan" in plans[0]
    assert rows(table.read(spark), "id") == [("1",)] and rows(rejects.read(spark), "value", "reason") == [("{broken", "broken")]


def stamp(s):
    return f"2024-01-15T00:{s // 60:02d}:{s % 60:02d}.000Z"


@pytest.mark.parametrize("salts", [1, 3])
def test_either_side_of_a_sale_may_come_first(spark, topics, root, salts):
    def order(i, at):
        return {"id": i, "user_id": "u1", "order_status": "1", "create_time": "2024-01-15 00:00:00", "_at": stamp(at)}

    def line(i, order_id, at):
        return {"id": i, "order_id": order_id, "order_price": "1.5", "sku_name": "red", "_at": stamp(at)}

    users = S.user_table(root).create(spark)
    users.write(
        spark.createDataFrame([("u1", "n", "VIP", "2000-01-01", "F", 0)], S.USER_ROWS), 0
    )
    topics.send("order_detail", [line("a", "1", 0), line("b", "2", 0)])
    topics.send("order_info", [order("1", 100), order("3", 100)])
    topics.send("order_detail", [line("c", "3", 200), line("d", "3", 201), line("e", "3", 150)])
    topics.send("order_info", [order("2", 101)])
    index = S.sale_index(root).create(spark)
    job = jobs.sale_job(
        topic_files(spark, "order_info", topics.folder, maxFilesPerTrigger="1"),
        topic_files(spark, "order_detail", topics.folder, maxFilesPerTrigger="1"),
        lambda s, wanted: users.read(s, only=wanted), index, f"{root}/checkpoint",
        as_of="2024-01-31", late="5 minutes", salts=salts,
    )
    S.finish(job)
    got = rows(index.read(spark), "order_detail_id", "order_id", "user_level", "user_age", "index_name")
    name = "sale_detail-2024-01-15"
    assert got == [("a", "1", "VIP", 24, name), ("c", "3", "VIP", 24, name), ("e", "3", "VIP", 24, name)]


@pytest.mark.parametrize("hot_lines", [1, 100])
def test_sales_from_waiting_tables(spark, topics, root, hot_lines):
    """Either side first, an hour's edge between partners, lines far too late, and a batch that is run again."""
    edge = "2024-01-15T01:00:{:02d}.000Z"

    def order(i, at):
        return {"id": i, "user_id": "u1", "order_status": "1", "create_time": "2024-01-15 00:00:00", "consignee_tel": "13812345678", "_at": at}

    def line(i, order_id, at):
        return {"id": i, "order_id": order_id, "order_price": "1.5", "sku_name": "red", "_at": at}

    users = S.user_table(root).create(spark)
    users.write(spark.createDataFrame([("u1", "n", "VIP", "2000-01-01", "F", 0)], S.USER_ROWS), 0)
    topics.send("order_detail", [line("a", "1", stamp(0)), line("b", "2", stamp(0)), {"_raw": "{broken"}])
    topics.send("order_info", [order("1", stamp(100)), order("3", stamp(100)), order("4", edge.format(30))])
    topics.send("order_detail", [line("c", "3", stamp(200)), line("d", "3", stamp(201)), line("e", "3", stamp(150))])
    topics.send("order_detail", [line("f", "4", "2024-01-15T00:59:30.000Z"), line("g", "1", stamp(50)), line("h", None, stamp(50))])
    topics.send("order_info", [order("2", stamp(101))])
    index = S.sale_index(root).create(spark)
    waiting = [jobs.waiting_table(f"{root}/{n}", s).create(spark) for n, s in (("o", schemas.ORDER_INFO), ("l", schemas.ORDER_DETAIL))]

    def run():
        raws = [topic_files(spark, t, topics.folder, maxFilesPerTrigger="1") for t in ("order_info", "order_detail")]
        S.finish(
            jobs.sale_table_job(
                *raws, lambda s, wanted: users.read(s, only=wanted), index, *waiting, f"{root}/checkpoint",
                as_of="2024-01-31", hot_lines=hot_lines,
            )
        )
        return rows(index.history(spark), "order_detail_id", "order_id", "user_level", "user_age", "index_name")

    want = [(i, o, "VIP", 24, "sale_detail-2024-01-15") for i, o in (("a", "1"), ("c", "3"), ("e", "3"), ("f", "4"), ("g", "1"))]
    assert run() == want
    commits = Path(f"{root}/checkpoint/commits")
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    shutil.move(commits / f"{last}", f"{root}/lost")
    shutil.move(commits / f".{last}.crc", f"{root}/lost.crc")
    assert run() == want
    assert {r[0] for r in rows(waiting[0].history(spark), "consignee_tel")} == {"1381*******"}
    assert waiting[0].history(spark).count() == 4 and waiting[1].history(spark).count() == 8


def test_logs_are_stamped_once_routed_and_kept_by_day(spark, topics, root):
    topics.send("raw", [{"type": "startup", "mid": "a"}, {"mid": "b"}, {"_raw": "junk"}])
    rejects = jobs.reject_table(f"{root}/rejects").create(spark)
    ticks = iter(range(T0, T0 + 100))
    raw = topic_files(spark, "raw", topics.folder)
    S.finish(jobs.log_job(raw, f"{root}/out", f"{root}/logs", f"{root}/c", rejects, clock=lambda: next(ticks)))
    sent = topic_files(spark, "startup", f"{root}/out")
    S.finish(sent.select("value").writeStream.format("text").option("path", f"{root}/again").option("checkpointLocation", f"{root}/c3"))
    assert rows(spark.read.text(f"{root}/again")) == [(f'{{"type":"startup","mid":"a","ts":{T0}}}',)]
    both = rows(spark.read.schema("value string").json(f"{root}/out"), "value")
    assert both == rows(spark.read.text(f"{root}/logs/log_date=2024-01-15"), "value") and len(both) == 2
    assert rows(rejects.read(spark), "value") == [("junk",)]


def test_trigger_and_clock(spark, topics, root):
    topics.send("raw", [{"mid": "a"}])
    collected = jobs.collect_logs(topic_files(spark, "raw", topics.folder))
    running = jobs.start(outputs.to_topic_files(collected.select("topic", "value"), f"{root}/out", f"{root}/c"), every_s=1)
    running.processAllAvailable()
    running.stop()
    got = spark.read.json(f"{root}/out").select(F.get_json_object("value", "$.ts").cast("bigint").alias("ts")).first()
    assert got.ts > T0


def test_large_topics_have_more_files_in_each_batch(spark, root, monkeypatch):
    monkeypatch.setattr(S, "FILE_ROWS", 100)
    rows_ = spark.range(2000).select(F.col("id").alias("offset"), F.col("id").alias("n"), F.current_timestamp().alias("timestamp"))
    raw = S.topic(spark, root, "t", [rows_.where("n < 900"), rows_.where("n >= 900")], source=rows_)
    batches = []
    writer = raw.writeStream.foreachBatch(lambda df, i: batches.append(sorted(r.offset for r in df.select("offset").collect())))
    S.finish(writer.option("checkpointLocation", f"{root}/c"))
    assert len(list(Path(f"{root}/topics/topic=t").glob("*.json"))) == 20
    assert batches == [list(range(900)), list(range(900, 2000))]


def test_sides_of_a_sale_are_kept_as_parsed(spark, topics, root, monkeypatch):
    """What the waiting join looks at several times is the parsed records, not their text."""
    plans = []
    counted = jobs.sale.hot_orders
    monkeypatch.setattr(jobs.sale, "hot_orders", lambda lines, n: (plans.append(lines._jdf.queryExecution().optimizedPlan().toString()), counted(lines, n))[1])
    topics.send("order_detail", [{"id": "a", "order_id": "1", "_at": stamp(0)}])
    topics.send("order_info", [{"id": "1", "user_id": "u1", "create_time": "2024-01-15 00:00:00", "_at": stamp(1)}])
    index, users = S.sale_index(root).create(spark), S.user_table(root).create(spark)
    waiting = [jobs.waiting_table(f"{root}/{n}", s).create(spark) for n, s in (("o", schemas.ORDER_INFO), ("l", schemas.ORDER_DETAIL))]
    raws = [topic_files(spark, t, topics.folder) for t in ("order_info", "order_detail")]
    S.finish(jobs.sale_table_job(*raws, lambda s, wanted: users.read(s, only=wanted), index, *waiting, f"{root}/c"))
    assert rows(index.read(spark), "order_detail_id") == [("a",)]
    (plan,) = plans
    assert "InMemoryRelation" in plan and "from_json" not in plan.split("InMemoryRelation")[0]


def test_the_change_log_is_kept_packed(spark, root, monkeypatch):
    monkeypatch.setattr(S, "scratch_dir", lambda spark, prefix: f"{root}/{prefix}")
    found = S.stream_cdc_topics(spark, SF_DIR).count()
    kept = list(Path(f"{root}/cdc-/changes").glob("part-*"))
    assert found > 0 and kept and all(f.name.endswith(".gz") for f in kept)


def test_sales_wait_in_tables_and_equal_a_join_in_state(spark, topics, root):
    """Late records of either side or both, records without a key, and a batch that is run again: the rows of Spark's own join."""

    def at(second):
        return f"2024-01-15T{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}.000Z"

    draw, batches, hour = Random(4), 5, 3600
    for batch in range(batches):
        for topic in ("order_info", "order_detail"):
            records = []
            for n in range(120):
                second = batch * 3 * hour + draw.randrange(300) - draw.choice([0, 0, 0, 5, 20, 120, 3 * hour, 6 * hour])
                number = str(draw.randrange(40)) if draw.random() < 0.97 else None
                record = {"id": number, "user_id": "u1", "create_time": "2024-01-15 00:00:00"} if topic == "order_info" else {
                    "id": f"{batch}-{n}", "order_id": number, "order_price": "1.5", "sku_name": "red"}
                records.append({**record, "_at": at(max(second, 0))})
            topics.send(topic, records)
    raws = [topic_files(spark, t, topics.folder, maxFilesPerTrigger="1") for t in ("order_info", "order_detail")]
    writer = jobs.sale_stream(*raws, salts=1).writeStream.format("parquet").option("path", f"{root}/state")
    S.finish(writer.option("checkpointLocation", f"{root}/state-checkpoint"))
    want = rows(spark.read.parquet(f"{root}/state"), "order_detail_id", "order_id", "detail_time")

    # The join may give a line several times, for several orders of an id; the index's history has all of them.
    index, users = S.sale_index(root).create(spark), S.user_table(root).create(spark)

    def run():
        job = jobs.sale_job(*raws, lambda s, wanted: users.read(s, only=wanted), index, f"{root}/c")
        query = jobs.start(job, every_s=None)
        query.awaitTermination()
        put = index.history(spark).join(spark.read.parquet(f"{root}/state").selectExpr("order_detail_id", "offset", "detail_time").distinct(), ["order_detail_id", "offset"], "left")
        return query, rows(put, "order_detail_id", "order_id", "detail_time")

    query, got = run()
    assert got == want and len(got) > 100
    assert len(query.recentProgress) >= batches and not any(p.stateOperators for p in query.recentProgress)
    commits = Path(f"{root}/c/commits")
    for name in (f"{batches - 1}", f".{batches - 1}.crc"):
        shutil.move(commits / name, f"{root}/lost{name}")
    assert run()[1] == want
    # What the watermark has passed is not kept.
    for side in ("orders", "lines"):
        assert min(f.name for f in Path(f"{root}/c/waiting/{side}").glob("arrived=*")) >= f"arrived=2024-01-15-{3 * (batches - 3) - 2:02d}"


def shuffle_files(spark):
    return sum(b.toString().startswith("shuffle_") for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()))


def soon(condition):
    """Spark removes files beside its work."""
    for _ in range(100):
        if condition():
            return True
        time.sleep(0.1)
    return False


def test_a_packed_topic_is_compressed_and_goes_as_it_is_read(spark, root):
    rows_ = spark.range(900).select(F.col("id").alias("offset"), F.col("id").alias("n"), F.current_timestamp().alias("timestamp"))
    before = shuffle_files(spark)
    raw = S.topic(spark, root, "t", [rows_.where(f"n div 300 = {i}") for i in range(3)], packed=True)
    assert soon(lambda: shuffle_files(spark) <= before)
    files = lambda: list(Path(f"{root}/topics/topic=t").glob("part-*"))
    assert len(files()) == 3 * S.FILES and all(f.name.endswith(".json.gz") for f in files())
    batches = []
    writer = raw.writeStream.foreachBatch(lambda df, i: batches.append(sorted(r.offset for r in df.select("offset").collect())))
    S.finish(writer.option("checkpointLocation", f"{root}/c"))
    assert batches == [list(range(i, i + 300)) for i in (0, 300, 600)]
    assert soon(lambda: len(files()) == S.FILES)  # those of the last batch


def test_shuffle_files_go_when_their_query_ends(spark, root):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), removing_shuffles(spark):
        assert spark.conf.get(key) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(key) == kept


@pytest.mark.parametrize("large", [1, 1000])
def test_large_batches_of_sales_are_not_shuffled_to_be_written(spark, topics, root, monkeypatch, large):
    monkeypatch.setattr(jobs, "LARGE", large)
    found, write = {}, KeyedTable.write

    def noted(table, rows_, batch_id, spread=True):
        found[table.path.removeprefix(root)] = spread
        write(table, rows_, batch_id, spread)

    monkeypatch.setattr(KeyedTable, "write", noted)
    topics.send("order_info", [{"id": "1", "user_id": "u1", "create_time": "2024-01-15 00:00:00", "_at": stamp(1)}])
    topics.send("order_detail", [{"id": i, "order_id": "1", "_at": stamp(2)} for i in "ab"])
    index, users = S.sale_index(root).create(spark), S.user_table(root).create(spark)
    waiting = [jobs.waiting_table(f"{root}/{n}", s).create(spark) for n, s in (("o", schemas.ORDER_INFO), ("l", schemas.ORDER_DETAIL))]
    raws = [topic_files(spark, t, topics.folder) for t in ("order_info", "order_detail")]
    S.finish(jobs.sale_table_job(*raws, lambda s, wanted: users.read(s, only=wanted), index, *waiting, f"{root}/c"))
    assert rows(index.read(spark), "order_detail_id") == [("a",), ("b",)]
    assert waiting[0].history(spark).count() == 1 and waiting[1].history(spark).count() == 2
    assert found == {"/sales": large > 1, "/o": True, "/l": True}
