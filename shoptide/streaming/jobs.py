"""Streaming jobs. Each takes topic records (``value``, ``offset``, ``timestamp``) and returns a stream writer;
call :func:`start` on it, or set a trigger of your own.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from shoptide import constants as C
from shoptide import schemas
from shoptide.functions.fields import index_name, mask_phone
from shoptide.functions.records import broken_records, checked_records, parse_detail, parse_event, parse_order, parse_startup
from shoptide.functions.times import date_text, with_log_date_hour
from shoptide.operators import alerts, dau, routing, sale
from shoptide.operators.cells import cell_changes, earlier_firsts
from shoptide.operators.gmv import ingest_orders, with_month
from shoptide.operators.keyed import latest_by_key
from shoptide.session import removing_shuffles
from shoptide.sinks import outputs
from shoptide.sinks.keyed_table import BATCH, KeyedTable
from shoptide.sources.streams import rejected_changes
from shoptide.streaming import lateness

log = logging.getLogger(__name__)

ROWS = "rows"


def start(writer: DataStreamWriter, every_s: int | None = C.TRIGGER_S) -> StreamingQuery:
    """Start with a trigger of so many seconds, or with ``None`` work off what is there and stop."""
    if every_s is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{every_s} seconds").start()


def _each_batch(stream: DataFrame, checkpoint: str, put: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def _put_counted(table: KeyedTable, rows: DataFrame, batch_id: int, spread: bool = True) -> None:
    """Put a batch and log how many rows it had, without a second pass."""
    seen = Observation(f"{table.key}-{batch_id}")
    table.write(dau.counted(rows, seen, ROWS), batch_id, spread)
    log.info("%s: batch %d, %s rows", table.path, batch_id, _observed(seen, rows))


def _observed(seen: Observation, rows: DataFrame) -> int:
    """The count. Where Spark knows beforehand that there are no rows it leaves the counting out, and has no figure."""
    try:
        return seen.get[ROWS]
    except Py4JJavaError:
        if not rows.isEmpty():
            raise
        return 0


REJECTS = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "value", "reason")])


def reject_table(path: str) -> KeyedTable:
    """Records a job could not use, with the reason; none of them has a key, so all stay."""
    return KeyedTable(path, REJECTS, key="id")


def _put_rejects(table: KeyedTable | None, rows: DataFrame, batch_id: int) -> None:
    if table is not None:
        table.write(rows.select(F.lit(None).cast("string").alias("id"), "value", "reason"), batch_id)


@contextmanager
def _usable(checked: DataFrame, rejects: KeyedTable | None, batch_id: int) -> Iterator[DataFrame]:
    """Records without a ``reason``; all others are put to ``rejects``. For these two uses a batch is read and parsed once."""
    if rejects is not None:
        checked.persist()
    try:
        _put_rejects(rejects, checked.where("reason is not null"), batch_id)
        yield checked.where("reason is null").drop("value", "reason")
    finally:
        if rejects is not None:
            checked.unpersist()


def _because(checked: DataFrame, condition: Column, reason: str) -> DataFrame:
    """Another reason not to use a record, for records that have none yet."""
    return checked.withColumn("reason", F.coalesce("reason", F.when(condition, F.lit(reason))))


def _ahead(ms: str, arrival: str, ahead_s: int) -> Column:
    """Whether a device's clock is ahead of the record's arrival. Such a time would push the watermark on."""
    return F.coalesce(F.col(ms) > F.unix_millis(arrival) + ahead_s * 1000, F.lit(False))


def dau_job(
    raw: DataFrame, detail: KeyedTable, seen: KeyedTable, checkpoint: str, rejects: KeyedTable | None = None
) -> DataStreamWriter:
    """First starts per device and day, against a table of devices seen before.

    Of the seen table only the batch's days are read, and only the two key columns. Broken records and starts
    without a time have no day; they go to ``rejects``.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checked = with_log_date_hour(checked_records(batch, schemas.STARTUP_LOG, keep=("offset",)))
        with _usable(_because(checked, F.col("log_date").isNull(), "no time"), rejects, batch_id) as starts:
            first = dau.first_per_device_day(starts, ("ts", "offset")).persist()
            try:
                days = [r[0] for r in first.select("log_date").distinct().collect()]
                fresh = dau.drop_seen(first, seen.history(spark, days, before_batch=batch_id)).persist()
                try:
                    _put_counted(detail, fresh, batch_id)
                    seen.write(dau.mark_seen(fresh), batch_id)
                finally:
                    fresh.unpersist()
            finally:
                first.unpersist()

    return _each_batch(raw, checkpoint, put)


def first_starts_stream(
    raw: DataFrame, late: str = "24 hours", salts: int = C.STREAM_SALTS, ahead_s: int = C.CLOCK_AHEAD_S
) -> DataFrame:
    """First starts per device and day, with the seen devices in the state store.

    The cost of a batch does not grow with the devices already seen, and the state drops a day once the
    watermark has passed it, so ``late`` has to be a day or more. Which of several starts within one batch is kept is
    not defined. Starts more than ``ahead_s`` ahead of their arrival, which would make all others late, fall.

    Spark judges late starts by the watermark of the batch before. To have them fall exactly, and kept, put a gate
    of the same bound in front (:mod:`shoptide.streaming.lateness`) and read what it lets through.

    A streaming dedup sends every row to the task of its key. With ``salts`` above 1 the rows of a device and
    day are first reduced by that many tasks, so that a device with very many starts does not hold up one.
    """
    starts = with_log_date_hour(parse_startup(raw, keep=("offset", "timestamp")))
    starts = starts.where(~_ahead("ts", "timestamp", ahead_s)).drop("timestamp")
    timed = starts.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", late)
    if salts > 1:
        salted = timed.withColumn("salt", F.pmod(F.xxhash64("offset"), F.lit(salts)))
        timed = salted.dropDuplicatesWithinWatermark([*dau.DEVICE_DAY, "salt"]).drop("salt")
    return timed.dropDuplicatesWithinWatermark(dau.DEVICE_DAY).drop("event_time", "offset")


def first_starts_by_state(raw: DataFrame, late: str = "24 hours", ahead_s: int = C.CLOCK_AHEAD_S) -> DataFrame:
    """Devices and days as they are updated: ``first`` is the earliest start of the first batch that had one.

    ``batch_time`` is the time of the batch at hand, ``first.batch_time`` that of the one which came first; a pair is
    new where both are equal. Spark fixes the time of a batch before it runs, and uses it again when it repeats it, so a
    repeated batch finds the same pairs new. The clock of the driver must not be set back between two batches.

    This is an aggregate, so a device with very many starts sends one row per task. The state holds a row per device
    and day, and drops a day once the watermark has passed its end.
    """
    starts = with_log_date_hour(parse_startup(raw, keep=("offset", "timestamp")))
    starts = starts.where(~_ahead("ts", "timestamp", ahead_s)).drop("timestamp")
    timed = starts.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", late)
    timed = timed.withColumn("batch_time", F.current_timestamp())
    start_row = F.struct("batch_time", "ts", "offset", *[c for c in starts.columns if c not in ("ts", "offset", *dau.DEVICE_DAY)])
    day = F.window("event_time", "1 day").alias("day")
    updated = timed.groupBy(day, *dau.DEVICE_DAY).agg(F.min(start_row).alias("first"))
    return updated.select(*dau.DEVICE_DAY, "first", F.current_timestamp().alias("batch_time"))


def dau_state_job(raw: DataFrame, detail: KeyedTable, checkpoint: str, **options) -> DataStreamWriter:
    """First starts per device and day, the same as :func:`dau_job` puts, without a table of devices seen.

    What was seen lies in the state store beside the tasks, which look up the devices of their batch only, so a batch costs
    the same however many devices the day already has. Starts later than the watermark's bound fall (a gate in front
    keeps them aside), and :func:`reject_job` with :func:`unusable_starts` keeps what cannot be read.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        new = batch.where(F.col("first.batch_time") == F.col("batch_time"))
        _put_counted(detail, new.select(*dau.DEVICE_DAY, "first.*").drop("batch_time"), batch_id)

    return _each_batch(first_starts_by_state(raw, **options), checkpoint, put).outputMode("update")


def gmv_job(raw: DataFrame, orders: KeyedTable, checkpoint: str, rejects: KeyedTable | None = None) -> DataStreamWriter:
    """Orders with date, hour and masked phone, put by order id. Narrow up to the write."""

    def put(batch: DataFrame, batch_id: int) -> None:
        with _usable(checked_records(batch, schemas.ORDER_INFO, keep=("offset",)), rejects, batch_id) as rows:
            _put_counted(orders, with_month(ingest_orders(rows)), batch_id)

    return _each_batch(raw, checkpoint, put)


def user_job(raw: DataFrame, users: KeyedTable, checkpoint: str, rejects: KeyedTable | None = None) -> DataStreamWriter:
    """The latest record of every user."""

    def put(batch: DataFrame, batch_id: int) -> None:
        with _usable(checked_records(batch, schemas.USER_INFO, keep=("offset",)), rejects, batch_id) as rows:
            _put_counted(users, rows, batch_id)

    return _each_batch(raw, checkpoint, put)


def alert_stream(
    raw: DataFrame,
    length_s: int = C.ALERT_WINDOW_S,
    slide_s: int = C.ALERT_SLIDE_S,
    min_accounts: int = C.ALERT_MIN_ACCOUNTS,
    late: str = "10 seconds",
    ahead_s: int = C.CLOCK_AHEAD_S,
) -> DataFrame:
    """Coupon alerts of windows the watermark has closed, with counted behaviours.

    Events are summed up per device and pane first. Putting panes into every sliding window would copy them
    ``length / slide`` times into the state; so they go into stretches of a window and a quarter, one every quarter,
    five copies at most, and of a closed stretch with coupons of enough accounts the windows that alert are picked. An
    alert comes up to a quarter of a window after its own window has closed.

    Windows after the last event close once a later record arrives, whatever its device; a source that may fall
    silent sends one (:func:`heartbeat`). Late events fall, as in :func:`first_starts_stream`.
    """
    pane = f"{alerts.pane_seconds(length_s, slide_s)} seconds"
    step_s = slide_s * max(1, length_s // 4 // slide_s)
    is_coupon = F.col("evid") == C.EVENT_COUPON
    parsed = parse_event(raw, keep=("timestamp",)).where(~_ahead("ts", "timestamp", ahead_s)).drop("timestamp")
    events = parsed.withColumn("event_time", F.timestamp_millis("ts")).withWatermark("event_time", late)
    counts = events.where("mid is not null").groupBy(F.window("event_time", pane).alias("pane"), "mid", "evid").agg(
        F.collect_set(F.when(is_coupon, F.col("uid"))).alias("accounts"),
        F.collect_set(F.when(is_coupon, F.col("itemid"))).alias("items"),
        F.count(F.lit(1)).alias("n"),
    )
    part = F.struct(F.unix_millis("pane.start").alias("at"), "evid", "accounts", "items", "n")
    stretch = F.window("pane", f"{length_s + step_s} seconds", f"{step_s} seconds").alias("stretch")
    stretches = counts.groupBy(stretch, "mid").agg(F.collect_list(part).alias("parts"))
    near = stretches.where(F.size(alerts.all_of(F.col("parts"), "accounts")) >= min_accounts)
    first, slide, length = F.unix_millis("stretch.start"), F.lit(slide_s * 1000).cast("long"), F.lit(length_s * 1000).cast("long")
    starts = F.sequence(first, first + F.lit((step_s - slide_s) * 1000).cast("long"), slide)

    def of_kind(evid: str) -> Column:
        return F.filter("parts", lambda p: p.getField("evid").eqNullSafe(evid))

    def alerting(at: Column) -> Column:
        within = lambda p: (p.getField("at") >= at) & (p.getField("at") < at + length)
        enough = F.size(alerts.all_of(F.filter("coupons", within), "accounts")) >= min_accounts
        return enough & ~F.exists("views", within)

    # Windows are picked by the few coupons and views, before whole parts are copied for any of them.
    marked = near.select("mid", "parts", of_kind(C.EVENT_COUPON).alias("coupons"), of_kind(C.EVENT_ITEM_VIEW).alias("views"), starts.alias("starts"))
    windows = marked.select("mid", "parts", F.explode(F.filter("starts", alerting)).alias("window_start"))
    end = F.col("window_start") + length
    inside = F.filter("parts", lambda p: (p.getField("at") >= F.col("window_start")) & (p.getField("at") < end))
    return alerts.alerts_of_parts(windows.select("mid", "window_start", end.alias("ts"), inside.alias("parts")), min_accounts)


def heartbeat(ts_ms: int) -> str:
    """An event of no behaviour on a device without a name: it moves the watermark on and counts for nothing.

    (Records with a null device are filtered before Spark looks at their time.)
    """
    return f'{{"mid":"","ts":{ts_ms}}}'


def unusable_starts(raw: DataFrame, ahead_s: int = C.CLOCK_AHEAD_S) -> DataFrame:
    """``value`` and ``reason`` of the starts a stateful stream passes over."""
    checked = _because(checked_records(raw, schemas.STARTUP_LOG, keep=("timestamp",)), F.col("ts").isNull(), "no time")
    return _because(checked, _ahead("ts", "timestamp", ahead_s), "ahead").where("reason is not null").select("value", "reason")


def unusable_events(raw: DataFrame, ahead_s: int = C.CLOCK_AHEAD_S) -> DataFrame:
    """``value`` and ``reason`` of the events alerts pass over: broken, without a time, or ahead of their arrival."""
    checked = _because(checked_records(raw, schemas.EVENT_LOG, keep=("timestamp",)), F.col("ts").isNull(), "no time")
    return _because(checked, _ahead("ts", "timestamp", ahead_s), "ahead").where("reason is not null").select("value", "reason")


def unusable_orders(raw: DataFrame) -> DataFrame:
    return broken_records(raw, schemas.ORDER_INFO)


def unusable_details(raw: DataFrame) -> DataFrame:
    return broken_records(raw, schemas.ORDER_DETAIL)


def unusable_changes(raw: DataFrame) -> DataFrame:
    return rejected_changes(raw).select("value", F.lit("broken").alias("reason"))


def reject_job(
    raw: DataFrame, unusable: Callable[[DataFrame], DataFrame], rejects: KeyedTable, checkpoint: str
) -> DataStreamWriter:
    """What a stateful stream of the same topic passes over, kept with the reason.

    Alerts, the sale join and the change log keep no batch that could be split, so this is a query of its own beside them.
    """
    return _each_batch(unusable(raw), checkpoint, lambda batch, batch_id: _put_rejects(rejects, batch, batch_id))


def alert_job(
    raw: DataFrame, documents: KeyedTable, checkpoint: str, prefix: str = C.INDEX_ALERT, **options
) -> DataStreamWriter:
    """Alerts put under their document id into daily indices, events listed one by one."""

    def put(batch: DataFrame, batch_id: int) -> None:
        _put_counted(documents, alerts.alert_documents(alerts.list_events(batch), prefix), batch_id)

    return _each_batch(alert_stream(raw, **options), checkpoint, put)


def sale_stream(
    orders_raw: DataFrame,
    details_raw: DataFrame,
    bound_s: int = C.JOIN_BOUND_S,
    late: str = "10 seconds",
    salts: int = C.STREAM_SALTS,
) -> DataFrame:
    """Lines with their orders, by arrival time (``timestamp``), whichever comes first."""
    orders = ingest_orders(parse_order(orders_raw, keep=("timestamp",)))
    orders = orders.withColumnRenamed("timestamp", "order_time").withWatermark("order_time", late)
    details = parse_detail(details_raw, keep=("timestamp", "offset"))
    details = details.withColumnRenamed("timestamp", "detail_time").withWatermark("detail_time", late)
    return sale.join_orders_details(orders, details, bound_s, salts=salts)


# What a sale takes from its order and its line, in the order of the records.
_SALE_ORDER = T.StructType([f for f in schemas.ORDER_INFO.fields if f.name in ("id", "consignee_tel", "order_status", "user_id", "create_time")])
_SALE_LINE = T.StructType([f for f in schemas.ORDER_DETAIL.fields if f.name in ("id", "order_id", "sku_name", "sku_id", "order_price")])
_MARKS = "latest_order bigint, latest_line bigint, mark bigint"


def sale_job(
    orders_raw: DataFrame,
    details_raw: DataFrame,
    users: Callable[[SparkSession, DataFrame], DataFrame],
    index: KeyedTable,
    checkpoint: str,
    prefix: str = C.INDEX_SALE_DETAIL,
    as_of: Column | str | None = None,
    bound_s: int = C.JOIN_BOUND_S,
    late: str = "10 seconds",
    salts: int = C.STREAM_SALTS,
) -> DataStreamWriter:
    """Sale details with the buyer, put under the line's id into the index of the line's arrival day.

    The rows are those of :func:`sale_stream`, late ones judged as Spark judges them there: a record falls if it arrived no
    later than the watermark of the batch before, which lies ``late`` before the latest arrival of either topic. But what waits
    lies in tables below the checkpoint, by hour of arrival, and not in the memory of a stateful join, which keeps every record
    of a batch. A batch joins its own records, and reads the hours around them; hours the watermark has passed are deleted. With
    ``salts`` above 1 hot orders are copied to as many tasks as their lines need (:func:`sale.hot_orders`).

    The day comes with the record, so a batch that is replayed after midnight lands in the same index.
    ``users(spark, wanted)`` returns the records of the wanted ids, for example ``KeyedTable.read(only=wanted)``.
    """
    spark = orders_raw.sparkSession
    late_ms = spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"interval '{late}'"))).first()[0]
    orders, details = waiting_table(f"{checkpoint}/waiting/orders", _SALE_ORDER), waiting_table(f"{checkpoint}/waiting/lines", _SALE_LINE)
    clock = lateness.Clock(f"{checkpoint}/waiting/clock", _MARKS)
    gap = F.make_dt_interval(secs=F.lit(bound_s))

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = clock.row_before(spark, batch_id) or (None, None, 0)
        latest, passed = list(marks[:2]), marks[2]
        mark = passed if None in latest else max(passed, min(latest) - late_ms)
        before = F.timestamp_millis(F.lit(passed))
        with removing_shuffles(spark):
            sides = _kept_sides(batch, batch_id, orders, details, F.col("timestamp") > before)
            arrivals = [_arrivals(side, key, bound_s) for side, key in zip(sides, ("id", "order_id"))]
            hot_lines = sale.HOT_LINES if salts > 1 else None
            _put_sales(*sides, arrivals, users, index, orders, details, batch_id, prefix, as_of, bound_s, hot_lines)
        for n, side in enumerate(arrivals):
            latest[n] = max((x for x in (latest[n], *(r.latest for r in side)) if x is not None), default=None)
        clock.put_row(spark, batch_id, (*latest, mark))
        # This batch may run again, so what it may have read stays; so does an hour more, which clocks may be set back by.
        oldest = spark.range(1).select(F.date_format(before - gap - F.expr("interval 2 hours"), _HOUR)).first()[0]
        for table in (orders, details):
            table.forget(spark, oldest)

    for table in (orders, details):
        table.create(spark)
    return _each_batch(sale_sides(orders_raw, details_raw), checkpoint, put)


def waiting_table(path: str, schema: T.StructType) -> KeyedTable:
    """Orders or lines kept for later partners, by the hour they arrived in."""
    fields = [*schema.fields, *(T.StructField(n, t) for n, t in _WAITING)]
    return KeyedTable(path, T.StructType(fields), key="id", partition="arrived", order=("offset",))


_WAITING = (("timestamp", T.TimestampType()), ("offset", T.LongType()), ("arrived", T.StringType()))
_HOUR = "yyyy-MM-dd-HH"
SIDE_ORDER, SIDE_LINE = "order", "line"


def sale_sides(orders_raw: DataFrame, details_raw: DataFrame) -> DataFrame:
    """Records of both topics as one stream, told apart by ``side``."""
    columns = ("value", "offset", "timestamp")
    orders = orders_raw.select(F.lit(SIDE_ORDER).alias("side"), *columns)
    return orders.unionByName(details_raw.select(F.lit(SIDE_LINE).alias("side"), *columns))


def _kept_sides(batch: DataFrame, batch_id: int, orders: KeyedTable, details: KeyedTable, in_time: Column | None = None) -> list[DataFrame]:
    """A batch's orders and lines, put into their tables and read back: they are looked at several times, and parsed once."""
    kept = []
    for name, table in ((SIDE_ORDER, orders), (SIDE_LINE, details)):
        waiting = [n for n, _ in _WAITING]
        schema = T.StructType([f for f in table.schema.fields if f.name not in waiting])
        rows = checked_records(batch.where(F.col("side") == name), schema, keep=("timestamp", "offset"))
        rows = rows.where("reason is null").drop("value", "reason").withColumn("arrived", F.date_format("timestamp", _HOUR))
        rows = mask_phone(rows) if name == SIDE_ORDER else rows
        table.write(rows if in_time is None else rows.where(in_time), batch_id)
        kept.append(table.history(batch.sparkSession).where(F.col(BATCH) == batch_id).select(*table.schema.names))
    return kept


def _with_waiting(new: DataFrame, table: KeyedTable, hours: list[str], batch_id: int) -> DataFrame:
    """A batch's records and those of earlier batches that arrived in the given hours, with ``is_new``."""
    spark = new.sparkSession
    waiting = table.history(spark, hours, before_batch=batch_id).select(*new.columns)
    return new.withColumn("is_new", F.lit(True)).unionByName(waiting.withColumn("is_new", F.lit(False)))


def _arrivals(rows: DataFrame, key: str, bound_s: int) -> list[Row]:
    """The hours rows arrived in: their number, the ``latest`` with a key, and the hours ``around`` in which partners may have arrived."""
    gap, hour = F.make_dt_interval(secs=F.lit(bound_s)), F.expr("interval 1 hour")
    at = F.col("timestamp")
    latest = F.max(F.when(F.col(key).isNotNull(), F.unix_millis(at))).alias("latest")
    spans = rows.where(at.isNotNull()).groupBy("arrived").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count(F.lit(1)).alias("n"), latest)
    first, last = F.date_trunc("hour", F.col("first") - gap), F.date_trunc("hour", F.col("last") + gap)
    around = F.transform(F.sequence(first, last, hour), lambda h: F.date_format(h, _HOUR))
    return spans.select("arrived", "n", "latest", around.alias("around")).collect()


# Pairs for each day of a batch from which on its tasks write what they have, without a shuffle for fewer files.
LARGE = 250_000


def _put_sales(
    new_orders: DataFrame,
    new_details: DataFrame,
    arrivals: list[list[Row]],
    users: Callable[[SparkSession, DataFrame], DataFrame],
    index: KeyedTable,
    orders: KeyedTable,
    details: KeyedTable,
    batch_id: int,
    prefix: str,
    as_of: Column | str | None,
    bound_s: int,
    hot_lines: int | None,
) -> None:
    """Pairs of a batch's records, with each other and with waiting ones, put into the index with their buyers.

    Lines are joined last: orders, of which there are fewer, meet their buyers before, as in :func:`sale.sale_details`.
    """
    # Partners of lines are looked for among waiting orders, and the other way round.
    near_orders, near_lines = (sorted({h for r in side for h in r.around}) for side in arrivals)
    info = _with_waiting(new_orders, orders, near_lines, batch_id)
    info = ingest_orders(info).withColumnsRenamed({"timestamp": "order_time", "is_new": "new_order"})
    lines = _with_waiting(new_details, details, near_orders, batch_id)
    lines = lines.withColumnsRenamed({"timestamp": "detail_time", "is_new": "new_line"})
    counted = lines.select("order_id").persist()
    try:
        hot = None if hot_lines is None else sale.hot_orders(counted, hot_lines)
        bought = sale.add_buyer(info, users(info.sparkSession, info.select(F.col("user_id").alias("id")).distinct()), as_of)
        joined = sale.join_hot_orders(bought, lines, hot, bound_s, of_order=sale.BUYER).where("new_order or new_line")
        found = joined.select(*schemas.SALE_DETAIL_COLUMNS, "detail_time", "offset")
        found = found.withColumn("index_name", index_name(prefix, F.col("detail_time").cast("date")))
        days = {r.arrived[:10] for r in arrivals[1]}
        _put_counted(index, found, batch_id, spread=sum(r.n for r in arrivals[1]) < LARGE * max(len(days), 1))
    finally:
        counted.unpersist()


def sale_table_job(
    orders_raw: DataFrame,
    details_raw: DataFrame,
    users: Callable[[SparkSession, DataFrame], DataFrame],
    index: KeyedTable,
    orders: KeyedTable,
    details: KeyedTable,
    checkpoint: str,
    prefix: str = C.INDEX_SALE_DETAIL,
    as_of: Column | str | None = None,
    bound_s: int = C.JOIN_BOUND_S,
    hot_lines: int = sale.HOT_LINES,
) -> DataStreamWriter:
    """What :func:`sale_job` does, with no record too late: partners are those within the bound, whenever they are delivered.

    Each batch joins its own records with each other and with the waiting ones that arrived in the hours around them, a
    pair in the batch of the later one of the two. Here the lines of every order can be counted before they are
    joined, so only orders found hot (:func:`sale.hot_orders`) are copied, to as many tasks as their lines need, and a record
    is kept once.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        with removing_shuffles(batch.sparkSession):
            sides = _kept_sides(batch, batch_id, orders, details)
            arrivals = [_arrivals(side, key, bound_s) for side, key in zip(sides, ("id", "order_id"))]
            _put_sales(*sides, arrivals, users, index, orders, details, batch_id, prefix, as_of, bound_s, hot_lines)

    return _each_batch(sale_sides(orders_raw, details_raw), checkpoint, put)


FIRST_SEEN = T.StructType([T.StructField("mid", T.StringType()), T.StructField("first_date", T.StringType())])
DAY_CELLS = T.StructType([T.StructField("first_date", T.StringType()), T.StructField("n", T.LongType())])


def first_seen_job(raw: DataFrame, first_seen: KeyedTable, cells: KeyedTable, checkpoint: str) -> DataStreamWriter:
    """The first day every device was ever active, and new devices by day as cells.

    Only the buckets of the batch's devices are read. A start that comes late moves its device to the earlier day: that
    day's cell goes up, the other one down.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        starts = with_log_date_hour(parse_startup(batch)).select("mid", F.col("log_date").alias("first_date")).distinct().persist()
        try:
            # A batch that is run again must not see what it wrote itself.
            known = latest_by_key(first_seen.history(spark, before_batch=batch_id), ["mid"], ("batch_id",))
            known = known.join(starts.select("mid").distinct(), "mid", "left_semi")
            changed = earlier_firsts(starts, known, "mid", "first_date").persist()
            try:
                moved = changed.where("known_first is not null").select(F.col("known_first").alias("first_date"))
                cells.write(cell_changes(moved, changed, ["first_date"]), batch_id)
                _put_counted(first_seen, changed, batch_id)
            finally:
                changed.unpersist()
        finally:
            starts.unpersist()

    return _each_batch(raw, checkpoint, put)


SALE_CELL = ("dt", "sku_name", "user_gender", "user_age")


def put_with_cells(index: KeyedTable, cells: KeyedTable, rows: DataFrame, batch_id: int) -> None:
    """Put sales by line id into an index by day, and change the cells of day, product, gender and age.

    A line that is put again leaves the cell it was in. Of the index only the batch's days are read. A line stays on its day.
    """
    spark = rows.sparkSession
    rows = rows.persist()
    try:
        days = [r[0] for r in rows.select("dt").distinct().collect()]
        held = index.history(spark, days, before_batch=batch_id).where(F.col(index.key).isNotNull())
        ids = rows.select(index.key).distinct()
        before = latest_by_key(held.join(ids, index.key, "left_semi"), [index.key, "dt"], ("batch_id", *index.order))
        named = rows.where(F.col(index.key).isNotNull())
        after = latest_by_key(named, [index.key, "dt"], index.order).unionByName(rows.where(F.col(index.key).isNull()))
        cells.write(cell_changes(before, after, SALE_CELL), batch_id)
        _put_counted(index, rows, batch_id)
    finally:
        rows.unpersist()


def admitted_starts(raw: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Starts of accounts that are not on a list, as a stream joined with a table.

    The list is read again for every batch; it is broadcast while it is small, and nothing is kept between batches.
    """
    starts = with_log_date_hour(parse_startup(raw))
    listed = blacklist.select(F.col(blacklist.columns[0]).alias("listed")).distinct()
    return starts.join(listed, F.col("uid") == F.col("listed"), "left_anti")


def collect_logs(lines: DataFrame, now_ms: Column | None = None) -> DataFrame:
    """Stamped log lines with their topic and the day they belong to."""
    clock = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    routed = routing.route_logs(routing.stamp_logs(lines, clock))
    return routed.select("topic", "value", date_text(F.timestamp_millis(clock)).alias("log_date"))


def log_job(
    lines: DataFrame,
    topics: str,
    logs: str,
    checkpoint: str,
    rejects: KeyedTable | None = None,
    clock: Callable[[], int] = lambda: int(time.time() * 1000),
) -> DataStreamWriter:
    """Log lines stamped once, then sent to their topic and kept in the day's log file.

    Both outputs of a batch are folders of its own, so a batch that is run again replaces both.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        broken = batch.where(F.from_json("value", "map<string,variant>").isNull())
        _put_rejects(rejects, broken.select("value", F.lit("broken").alias("reason")), batch_id)
        collected = collect_logs(batch, F.lit(clock())).persist()
        try:
            outputs.put_topic_files(collected.select("topic", "value"), topics, batch_id)
            outputs.put_daily_logs(collected, logs, batch_id)
        finally:
            collected.unpersist()

    return _each_batch(lines, checkpoint, put)


def collect_changes(changes: DataFrame) -> DataFrame:
    """Records of new orders, lines and users out of a database log, with their topic."""
    return routing.after_image_json(routing.route_changes(changes))


__all__ = [
    "admitted_starts",
    "alert_job",
    "alert_stream",
    "collect_changes",
    "collect_logs",
    "dau_job",
    "dau_state_job",
    "first_seen_job",
    "first_starts_by_state",
    "first_starts_stream",
    "gmv_job",
    "heartbeat",
    "log_job",
    "put_with_cells",
    "reject_job",
    "reject_table",
    "sale_job",
    "sale_sides",
    "sale_stream",
    "sale_table_job",
    "start",
    "unusable_changes",
    "unusable_details",
    "unusable_events",
    "unusable_orders",
    "unusable_starts",
    "user_job",
    "waiting_table",
]
