"""Cells kept by jobs equal counts over everything, also after late, repeated and replayed rows."""

from __future__ import annotations

import shutil
import time

from pyspark.sql import functions as F

from shoptide.operators import search
from shoptide.operators.cells import cell_changes, cell_counts
from shoptide.plans import streams as S
from shoptide.sinks.keyed_table import KeyedTable
from shoptide.sources.streams import topic_files
from shoptide.streaming import jobs, progress
from tests.conftest import rows

T0 = 1705276800000  # 2024-01-15 00:00 UTC
DAY_MS = 86_400_000


def start(mid, day, uid="u"):
    return {"mid": mid, "uid": uid, "type": "startup", "ts": T0 + day * DAY_MS}


def first_seen_run(spark, topics, root):
    first_seen = KeyedTable(f"{root}/first", jobs.FIRST_SEEN, key="mid", buckets=4).create(spark)
    cells = KeyedTable(f"{root}/cells", jobs.DAY_CELLS, key="first_date").create(spark)
    raw = topic_files(spark, "startup", topics.folder, maxFilesPerTrigger="1")
    S.finish(jobs.first_seen_job(raw, first_seen, cells, f"{root}/checkpoint"))
    return first_seen, cells


def test_new_devices_by_day(spark, topics, root):
    topics.send("startup", [start("a", 2), start("a", 3), start("b", 2), {"_raw": "{broken"}, {"mid": "x", "type": "startup"}])
    topics.send("startup", [start("a", 5), start("c", 3)])
    topics.send("startup", [start("a", 0), start("b", 2), start("c", 1)])
    first_seen, cells = first_seen_run(spark, topics, root)
    want = [("2024-01-15", 1), ("2024-01-16", 1), ("2024-01-17", 1)]
    assert rows(cell_counts(cells.history(spark), ["first_date"])) == want
    assert rows(first_seen.read(spark)) == [("a", "2024-01-15"), ("b", "2024-01-17"), ("c", "2024-01-16")]
    for name in ("2", ".2.crc"):
        shutil.move(f"{root}/checkpoint/commits/{name}", f"{root}/lost{name}")
    first_seen, cells = first_seen_run(spark, topics, root)
    assert rows(cell_counts(cells.history(spark), ["first_date"])) == want
    assert first_seen.history(spark).where("batch_id = 1").count() == 1  # a device that is known writes nothing


def test_sale_cells_follow_lines_that_are_put_again(spark, root):
    index = S.sale_index(root, "dt").create(spark)
    cells = KeyedTable(f"{root}/cells", S.SALE_CELLS, key="sku_name", partition="dt").create(spark)

    def put(batch_id, *lines):
        schema = S.SALE_DOCS
        full = [{"order_detail_id": i, "dt": d, "sku_name": "red ring", "user_gender": g, "user_age": a, "offset": n} for n, (i, d, g, a) in enumerate(lines)]
        table = spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in full], schema)
        jobs.put_with_cells(index, cells, table, batch_id)

    put(0, ("1", "d1", "M", 19), ("2", "d1", "F", 30), (None, "d1", "M", 20), ("3", "d2", None, None))
    put(1, ("1", "d1", "F", 19), ("1", "d1", "M", 40), ("4", "d1", "M", 25))
    put(1, ("1", "d1", "F", 19), ("1", "d1", "M", 40), ("4", "d1", "M", 25))  # run again
    for days in (["d1"], ["d1", "d2"]):
        got = rows(search.cell_figures(search.search(cells.history(spark, days), "ring")))
        assert got == rows(search.report_figures(search.search(index.read(spark, days), "ring")))
    assert rows(search.cell_figures(cells.history(spark, ["d9"])), "total", "female_ratio") == [(0, 100.0)]


def test_changes_of_nothing(spark):
    one = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "k string, v int")
    assert cell_changes(one, one, ["k", "v"]).count() == 0
    assert rows(cell_changes(one.limit(0), one, ["k", "v"])) == [("a", 1, 2), (None, 2, 1)]


def test_a_stream_joined_with_a_table(spark, topics, root):
    topics.send("startup", [start("a", 0, "1"), start("b", 0, "2"), start("c", 0, None)])
    topics.send("startup", [start("d", 1, "2"), start("e", 1, "3"), {"_raw": "["}])
    raw = topic_files(spark, "startup", topics.folder, maxFilesPerTrigger="1")
    listed = spark.createDataFrame([("2",), ("2",), (None,)], "id string")
    fresh = jobs.admitted_starts(raw, listed)
    log = progress.ProgressLog()
    spark.streams.addListener(log)
    try:
        writer = fresh.writeStream.queryName("admitted").format("parquet").option("path", f"{root}/out")
        S.finish(writer.option("checkpointLocation", f"{root}/c"))
        deadline = time.time() + 30
        while not log.ended and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    assert rows(spark.read.parquet(f"{root}/out"), "mid", "log_date") == [("a", "2024-01-15"), ("c", "2024-01-15"), ("e", "2024-01-16")]
    log.flush(spark, f"{root}/log")
    log.flush(spark, f"{root}/log")
    found = progress.batches(spark, f"{root}/log").where("query = 'admitted' and input_rows > 0")
    assert rows(found, "batch", "input_rows", "late_rows") == [(0, 3, 0), (1, 3, 0)]
    assert spark.read.parquet(f"{root}/log/ends").where("error is null").count() == 1


def test_dropped_rows_show_in_the_log(spark, topics, root):
    """Without a gate, what Spark drops as late is at least counted."""
    for batch in ([start("a", 0)], [start("b", 9)], [start("c", 9)], [start("d", 0)]):
        topics.send("startup", batch, at="2024-01-26T00:00:00.000Z")
    log = progress.ProgressLog()
    spark.streams.addListener(log)
    try:
        raw = topic_files(spark, "startup", topics.folder, maxFilesPerTrigger="1")
        writer = jobs.first_starts_stream(raw, salts=1).writeStream.queryName("starts").format("parquet").option("path", f"{root}/out")
        S.finish(writer.option("checkpointLocation", f"{root}/c"))
        deadline = time.time() + 30
        while not log.ended and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    log.flush(spark, f"{root}/log")
    assert progress.batches(spark, f"{root}/log").agg(F.sum("late_rows")).first()[0] == 1
    assert rows(spark.read.parquet(f"{root}/out"), "mid") == [("a",), ("b",), ("c",)]
