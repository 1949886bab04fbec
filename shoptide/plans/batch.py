"""Queries over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide import constants as C
from shoptide.functions import fields, records, times
from shoptide.operators import alerts, dashboard, dau, gmv, keyed, routing, sale, search, users
from shoptide.plans import views as V
from shoptide.plans.registry import query
from shoptide.session import scratch_dir
from shoptide.sources.tables import read_table

# The given events are minutes apart over all users, so alerts are looked for in long windows.
ALERT_LENGTH_S = 6 * 3600
ALERT_SLIDE_S = 3600

PAGE, PAGE_SIZE = 2, 10


# ---------------------------------------------------------------- records


def _as_json(df: DataFrame, *names: str) -> DataFrame:
    return records.json_value(df, *(names or df.columns))


@query(
    "q_startup_parse",
    f"WITH {V.STARTUP_LOG} SELECT mid, uid, appid, area, os, ch, type, vs, ts FROM startup_log",
)
def startup_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_startup(_as_json(V.startup_log(spark, sf_dir)))


@query(
    "q_event_parse",
    f"WITH {V.EVENT_LOG} SELECT mid, uid, appid, area, os, type, evid, pgid, npgid, itemid, ts FROM event_log",
)
def event_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_event(_as_json(V.event_log(spark, sf_dir)))


@query(
    "q_order_parse",
    f"""WITH {V.ORDER_INFO}, {V.FURTHER_ORDER}
    SELECT id, province_id, consignee, order_comment, consignee_tel, order_status, payment_way, user_id, img_url,
      total_amount, expire_time, delivery_address, create_time, operate_time, tracking_no, parent_order_id,
      out_trade_no, trade_body
    FROM order_info JOIN further ON id = key""",
)
def order_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(*V.order_columns(), *V.further_order_columns())
    return records.parse_order(_as_json(orders.withColumn("total_amount", F.col("total_amount").cast("string"))))


@query(
    "q_order_detail_parse",
    f"WITH {V.ORDER_DETAIL} SELECT id, order_id, sku_name, sku_id, order_price, sku_num FROM order_detail",
)
def order_detail_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_detail(_as_json(V.order_detail(spark, sf_dir))).drop("img_url")


@query(
    "q_user_parse",
    f"WITH {V.USER_INFO} SELECT id, login_name, user_level, birthday, gender FROM user_info",
)
def user_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.parse_user(_as_json(V.user_info(spark, sf_dir)))


@query(
    "q_to_json",
    f"""WITH {V.STARTUP_LOG}
    SELECT event_id, '{{"mid":"' || mid || '","os":"' || os || '","ts":' || ts || '}}' AS value FROM startup_log""",
)
def to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.json_value(V.startup_log(spark, sf_dir), "mid", "os", "ts", keep=("event_id",))


@query(
    "q_log_stamp",
    f"""WITH {V.RAW_LOGS} SELECT opened || ',"ts":{V.NOW_MS}}}' AS value FROM raw_logs""",
)
def log_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.stamp_logs(V.raw_logs(spark, sf_dir), F.lit(V.NOW_MS))


@query(
    "q_log_route",
    f"""WITH {V.RAW_LOGS}
    SELECT opened || '}}' AS value, CASE WHEN event_type = 'view' THEN 'startup' ELSE 'event' END AS topic
    FROM raw_logs""",
)
def log_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route_logs(V.raw_logs(spark, sf_dir))


@query(
    "q_cdc_route",
    f"""WITH {V.ROUTED} SELECT "table", op, topic, count(*) AS n, count(DISTINCT image) AS images
    FROM routed GROUP BY ALL""",
)
def cdc_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.route_changes(V.cdc_change(spark, sf_dir))
    return routed.groupBy("table", "op", "topic").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("after").alias("images")
    )


@query("q_cdc_after_image", f"WITH {V.ROUTED} SELECT topic, image AS value FROM routed")
def cdc_after_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.after_image_json(routing.route_changes(V.cdc_change(spark, sf_dir)))


# ---------------------------------------------------------------- dates, masks, names


@query("q_log_date_hour", f"WITH {V.STARTUP_LOG} SELECT event_id, ts, log_date, log_hour FROM startup_log")
def log_date_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times.with_log_date_hour(V.startup_log(spark, sf_dir).select("event_id", "ts"))


@query("q_order_date_hour", f"WITH {V.ORDER_INFO} SELECT id, create_time, create_date, create_hour FROM order_info")
def order_date_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return times.with_order_date_hour(V.order_info(spark, sf_dir).select("id", "create_time"))


@query(
    "q_phone_mask",
    f"WITH {V.ORDER_INFO} SELECT id, substr(consignee_tel, 1, 4) || '*******' AS consignee_tel FROM order_info",
)
def phone_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.mask_phone(V.order_info(spark, sf_dir).select("id", "consignee_tel"))


@query(
    "q_user_age",
    f"""WITH {V.USER_INFO}
    SELECT id, birthday, CAST(date_diff('day', CAST(birthday AS DATE), DATE '{V.AS_OF}') // 365 AS INTEGER) AS user_age
    FROM user_info""",
)
def user_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields.with_age(V.user_info(spark, sf_dir).select("id", "birthday"), as_of=V.AS_OF)


@query(
    "q_previous_day",
    f"""WITH {V.ORDER_INFO}
    SELECT id, strftime(CAST(create_date AS DATE) - 1, '%Y-%m-%d') AS previous_date FROM order_info""",
)
def previous_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = times.with_order_date_hour(V.order_info(spark, sf_dir))
    return orders.select("id", times.previous_day(F.col("create_date")).alias("previous_date"))


@query(
    "q_index_name",
    f"WITH {V.ORDER_INFO} SELECT id, 'sale_detail-' || create_date AS index_name FROM order_info",
)
def index_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = V.order_info(spark, sf_dir)
    return orders.select("id", fields.index_name("sale_detail", F.col("create_time").cast("date")).alias("index_name"))


@query(
    "q_upper_columns",
    f"""WITH {V.ORDER_INFO} SELECT id AS "ID", substr(consignee_tel, 1, 4) || '*******' AS "CONSIGNEE_TEL",
    total_amount AS "TOTAL_AMOUNT", create_date AS "CREATE_DATE", create_hour AS "CREATE_HOUR" FROM order_info""",
)
def upper_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gmv.ingest_orders(V.order_info(spark, sf_dir))
    return fields.upper_columns(rows.select("id", "consignee_tel", "total_amount", "create_date", "create_hour"))


# ---------------------------------------------------------------- daily active devices


def _starts(spark: SparkSession, sf_dir: str, days: tuple[str | None, str] | None = None) -> DataFrame:
    return times.with_log_date_hour(V.startup_log(spark, sf_dir, days))


def _dau(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    return dau.first_per_device_day(_starts(spark, sf_dir, days), ("ts", "event_id"))


def _dau_times(spark: SparkSession, sf_dir: str, days: tuple[str | None, str] | None = None) -> DataFrame:
    return dau.first_start_times(_starts(spark, sf_dir, days))


def _halves(starts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two batches: what came before noon of each day, and the rest."""
    morning = F.col("log_hour").cast("int") < V.NOON
    return starts.where(morning), starts.where(~morning)


@query(
    "q_dau_within_batch_dedup",
    f"WITH {V.FIRST_STARTS} SELECT mid, log_date, uid, area, os, ch, vs, ts, event_id, log_hour FROM dau",
)
def dau_within_batch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dau(spark, sf_dir).drop("appid", "type")


@query(
    "q_dau_cross_batch_dedup",
    f"""WITH {V.STARTUP_LOG}
    SELECT mid, log_date, log_hour, ts, event_id FROM startup_log s
    WHERE log_hour >= '12' AND NOT EXISTS (SELECT 1 FROM startup_log e
      WHERE e.log_hour < '12' AND e.mid = s.mid AND e.log_date = s.log_date)""",
)
def dau_cross_batch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier, current = _halves(_starts(spark, sf_dir))
    fresh = dau.drop_seen(current, dau.mark_seen(earlier))
    return fresh.select("mid", "log_date", "log_hour", "ts", "event_id")


@query("q_dau_mark_seen", f"WITH {V.STARTUP_LOG} SELECT DISTINCT mid, log_date FROM startup_log")
def dau_mark_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dau.mark_seen(_starts(spark, sf_dir))


@query("q_dau_detail", f"WITH {V.FIRST_STARTS} SELECT mid, log_date, log_hour, uid, ts, event_id FROM dau")
def dau_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches one after the other: the second without what the first has seen."""
    earlier, current = _halves(_starts(spark, sf_dir))
    order = ("ts", "event_id")
    first = dau.first_per_device_day(earlier, order)
    fresh = dau.new_active_devices(current, dau.mark_seen(earlier), order)
    return first.unionByName(fresh).select("mid", "log_date", "log_hour", "uid", "ts", "event_id")


@query(
    "q_dau_batch_count",
    f"""WITH {V.FIRST_STARTS} SELECT CASE WHEN log_hour < '12' THEN 0 ELSE 1 END AS batch_id, count(*) AS n
    FROM dau GROUP BY ALL""",
)
def dau_batch_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier, current = _halves(_starts(spark, sf_dir))
    first = dau.first_start_times(earlier).withColumn("batch_id", F.lit(0))
    fresh = dau.drop_seen(dau.first_start_times(current), dau.mark_seen(earlier)).withColumn("batch_id", F.lit(1))
    return first.unionByName(fresh).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("q_dau_total", f"WITH {V.FIRST_STARTS} SELECT count(*) AS total FROM dau WHERE log_date = '{V.DAY}'")
def dau_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dau_total(_dau_times(spark, sf_dir, (V.DAY, V.DAY)), V.DAY)


@query(
    "q_dau_hours",
    f"WITH {V.FIRST_STARTS} SELECT log_hour, count(*) AS ct FROM dau WHERE log_date = '{V.DAY}' GROUP BY log_hour",
)
def dau_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dau_hours(_dau_times(spark, sf_dir, (V.DAY, V.DAY)), V.DAY)


@query("q_dau_daily", f"WITH {V.FIRST_STARTS} SELECT log_date, count(*) AS value FROM dau GROUP BY log_date")
def dau_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.by_day(_dau_times(spark, sf_dir), "dau")


@query(
    "q_dau_hours_daily",
    f"WITH {V.FIRST_STARTS} SELECT log_date, log_hour, count(*) AS value FROM dau GROUP BY log_date, log_hour",
)
def dau_hours_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.by_hour(_dau_times(spark, sf_dir), "dau")


# ---------------------------------------------------------------- order amounts and dashboard


def _orders(spark: SparkSession, sf_dir: str, raw_days: tuple[str, str] | None = None) -> DataFrame:
    return gmv.ingest_orders(V.order_info(spark, sf_dir, raw_days))


@query(
    "q_gmv_total",
    f"""WITH {V.ORDER_INFO} SELECT {V.EXACT_SUM} AS sum_amount FROM order_info
    WHERE create_date = '{V.DAY}'""",
)
def gmv_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.gmv_total(_orders(spark, sf_dir, (V.ORDER_RAW_DAY, V.ORDER_RAW_DAY)), V.DAY)


@query(
    "q_gmv_hours",
    f"""WITH {V.ORDER_INFO} SELECT create_hour, {V.EXACT_SUM} AS sum_amount FROM order_info
    WHERE create_date = '{V.DAY}' GROUP BY create_hour""",
)
def gmv_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.gmv_hours(_orders(spark, sf_dir, (V.ORDER_RAW_DAY, V.ORDER_RAW_DAY)), V.DAY)


@query(
    "q_gmv_daily",
    f"""WITH {V.ORDER_INFO} SELECT create_date, {V.EXACT_SUM} AS value FROM order_info
    GROUP BY create_date""",
)
def gmv_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.by_day(_orders(spark, sf_dir), "order_amount")


@query(
    "q_gmv_hours_daily",
    f"""WITH {V.ORDER_INFO} SELECT create_date, create_hour, {V.EXACT_SUM} AS value FROM order_info
    GROUP BY create_date, create_hour""",
)
def gmv_hours_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.by_hour(_orders(spark, sf_dir), "order_amount")


@query(
    "q_hour_map",
    f"""WITH {V.FIRST_STARTS} SELECT log_date, log_hour AS hour, count(*) AS value FROM dau
    GROUP BY log_date, log_hour""",
)
def hour_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = dashboard.hour_map(_dau_times(spark, sf_dir), "dau")
    return maps.select("log_date", F.explode("hours").alias("hour", "value"))


_DAU_BOTH_DAYS = f"""SELECT log_hour AS hour,
    nullif(count(*) FILTER (WHERE log_date = '{V.DAY}'), 0) AS today,
    nullif(count(*) FILTER (WHERE log_date = '{V.DAY_BEFORE}'), 0) AS yesterday
  FROM dau WHERE log_date IN ('{V.DAY_BEFORE}', '{V.DAY}') GROUP BY log_hour"""


@query("q_realtime_hours", f"WITH {V.FIRST_STARTS} {_DAU_BOTH_DAYS}")
def realtime_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.today_vs_yesterday(_dau_times(spark, sf_dir, (V.DAY_BEFORE, V.DAY)), "dau", V.DAY)


@query(
    "q_realtime_hours_dense",
    f"""WITH {V.FIRST_STARTS}, hours AS ({_DAU_BOTH_DAYS})
    SELECT lpad(CAST(i AS VARCHAR), 2, '0') AS hour, coalesce(today, 0) AS today, coalesce(yesterday, 0) AS yesterday
    FROM range(24) t(i) LEFT JOIN hours ON hours.hour = lpad(CAST(i AS VARCHAR), 2, '0')""",
)
def realtime_hours_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.dense_hours(realtime_hours(spark, sf_dir))


@query(
    "q_realtime_hours_gmv",
    f"""WITH {V.ORDER_INFO} SELECT create_hour AS hour,
    CAST(sum(CAST(total_amount AS DECIMAL(18,2))) FILTER (WHERE create_date = '{V.DAY}') AS DOUBLE) AS today,
    CAST(sum(CAST(total_amount AS DECIMAL(18,2))) FILTER (WHERE create_date = '{V.DAY_BEFORE}') AS DOUBLE) AS yesterday
    FROM order_info WHERE create_date IN ('{V.DAY_BEFORE}', '{V.DAY}') GROUP BY create_hour""",
)
def realtime_hours_gmv(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, (V.ORDER_RAW_DAY_BEFORE, V.ORDER_RAW_DAY))
    return dashboard.today_vs_yesterday(orders, "order_amount", V.DAY)


_CARDS = f"""{V.FIRST_STARTS}, {V.ORDER_INFO}, cards AS (
    SELECT '{C.CARD_DAU[0]}' AS id, '{C.CARD_DAU[1]}' AS name, CAST(count(*) AS DOUBLE) AS value, 1 AS place
    FROM dau WHERE log_date = '{V.DAY}'
    UNION ALL
    SELECT '{C.CARD_NEW_DEVICE[0]}', '{C.CARD_NEW_DEVICE[1]}', CAST(count(*) AS DOUBLE), 2 FROM
      (SELECT mid FROM dau GROUP BY mid HAVING min(log_date) = '{V.DAY}')
    UNION ALL
    SELECT '{C.CARD_ORDER_AMOUNT[0]}', '{C.CARD_ORDER_AMOUNT[1]}', {V.EXACT_SUM}, 3 FROM order_info
    WHERE create_date = '{V.DAY}')"""


def _first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of devices by first day, as a job keeps it; read back by its folders."""
    path = scratch_dir(spark, "first-seen-")
    first = dau.first_active_day(_starts(spark, sf_dir, (None, V.DAY)))
    first.hint("rebalance", "first_date").write.partitionBy("first_date").parquet(path)
    return spark.read.schema("mid string, first_date string").parquet(path)


@query("q_realtime_total", f"WITH {_CARDS} SELECT id, name, value FROM cards")
def realtime_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, (V.ORDER_RAW_DAY, V.ORDER_RAW_DAY))
    starts = _dau_times(spark, sf_dir, (V.DAY, V.DAY))
    return dashboard.realtime_total(starts, orders, _first_seen(spark, sf_dir), V.DAY)


@query(
    "q_realtime_total_json",
    f"""WITH {_CARDS} SELECT '[' || string_agg('{{"id":"' || id || '","name":"' || name || '","value":' || value || '}}',
    ',' ORDER BY place) || ']' AS value FROM cards""",
)
def realtime_total_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.cards_json(realtime_total(spark, sf_dir))


@query(
    "q_realtime_hours_json",
    f"""WITH {V.FIRST_STARTS}, hours AS ({_DAU_BOTH_DAYS}) SELECT
    '{{"yesterday":{{' || coalesce(string_agg('"' || hour || '":' || yesterday, ',' ORDER BY hour)
      FILTER (WHERE yesterday IS NOT NULL), '') || '}},"today":{{' ||
    coalesce(string_agg('"' || hour || '":' || today, ',' ORDER BY hour) FILTER (WHERE today IS NOT NULL), '')
    || '}}}}' AS value FROM hours""",
)
def realtime_hours_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.hours_json(realtime_hours(spark, sf_dir))


@query(
    "q_first_active_day",
    f"WITH {V.STARTUP_LOG} SELECT mid, min(log_date) AS first_date FROM startup_log GROUP BY mid",
)
def first_active_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dau.first_active_day(_starts(spark, sf_dir))


# ---------------------------------------------------------------- coupon alerts

_HOUR_MS = ALERT_SLIDE_S * 1000
_SPREAD = f"""{V.EVENT_LOG}, spread AS (
  SELECT *, (ts // {_HOUR_MS} - i) * {_HOUR_MS} AS window_start
  FROM event_log, range({ALERT_LENGTH_S // ALERT_SLIDE_S}) t(i))"""
_ALERTS = f"""{_SPREAD}, alerts AS (
  SELECT mid, window_start, window_start + {ALERT_LENGTH_S * 1000} AS ts,
    array_to_string(list_sort(list_distinct(list(uid) FILTER (WHERE evid = 'coupon'))), ',') AS uids,
    array_to_string(list_sort(list_distinct(list(itemid) FILTER (WHERE evid = 'coupon'))), ',') AS item_ids,
    string_agg(evid, ',' ORDER BY evid) AS events
  FROM spread WHERE mid IS NOT NULL GROUP BY mid, window_start
  HAVING count(DISTINCT uid) FILTER (WHERE evid = 'coupon') >= 3 AND NOT bool_or(evid = 'clickItem'))"""


def _joined(df: DataFrame, *arrays: str) -> DataFrame:
    return df.withColumns({name: F.array_join(name, ",") for name in arrays})


@query(
    "q_alert_groups",
    f"""WITH {_SPREAD} SELECT mid, window_start, window_start + {ALERT_LENGTH_S * 1000} AS window_end, evid,
    count(*) AS n FROM spread GROUP BY ALL""",
)
def alert_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_groups(V.event_log(spark, sf_dir), ALERT_LENGTH_S, ALERT_SLIDE_S)


@query("q_alert_coupon", f"WITH {_ALERTS} SELECT * FROM alerts")
def alert_coupon(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.coupon_alerts(V.event_log(spark, sf_dir), ALERT_LENGTH_S, ALERT_SLIDE_S)
    return _joined(alerts.list_events(found), "uids", "item_ids", "events")


# Event time runs FAST times as fast, so that six hours become five minutes and the default window finds alerts.
FAST = 72
_FAST = f"""{V.EVENT_LOG}, spread AS (
  SELECT * EXCLUDE (ts), ts // {FAST} AS ts,
    (ts // {FAST} // {C.ALERT_SLIDE_S * 1000} - i) * {C.ALERT_SLIDE_S * 1000} AS window_start
  FROM event_log, range({C.ALERT_WINDOW_S // C.ALERT_SLIDE_S}) t(i)), alerts AS (
  SELECT mid, window_start, window_start + {C.ALERT_WINDOW_S * 1000} AS ts,
    array_to_string(list_sort(list_distinct(list(uid) FILTER (WHERE evid = 'coupon'))), ',') AS uids,
    array_to_string(list_sort(list_distinct(list(itemid) FILTER (WHERE evid = 'coupon'))), ',') AS item_ids,
    string_agg(evid, ',' ORDER BY evid) AS events
  FROM spread WHERE mid IS NOT NULL GROUP BY mid, window_start
  HAVING count(DISTINCT uid) FILTER (WHERE evid = 'coupon') >= 3 AND NOT bool_or(evid = 'clickItem'))"""


def fast_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.event_log(spark, sf_dir).withColumn("ts", F.call_function("div", F.col("ts"), F.lit(FAST)))


@query("q_alert_default", f"WITH {_FAST} SELECT mid, window_start, ts, uids, item_ids, events FROM alerts")
def alert_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five minutes, sliding by five seconds: several windows a minute."""
    found = alerts.coupon_alerts(fast_events(spark, sf_dir))
    return _joined(alerts.list_events(found), "uids", "item_ids", "events")


@query(
    "q_alert_doc",
    f"""WITH {_FAST} SELECT mid || '-' || (ts // 60000) AS doc_id, mid, uids, events, ts,
    'coupon_alert-' || strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS index_name
    FROM alerts QUALIFY row_number() OVER (PARTITION BY mid, ts // 60000 ORDER BY ts DESC) = 1""",
)
def alert_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.list_events(alerts.coupon_alerts(fast_events(spark, sf_dir)))
    return _joined(alerts.alert_documents(found), "uids", "events").drop("item_ids", "window_start")


# ---------------------------------------------------------------- users and lookups


@query(
    "q_user_latest",
    f"""WITH {V.USER_INFO} SELECT id, CASE WHEN balance < 0 THEN 'SUSPENDED' ELSE user_level END AS user_level,
    birthday, 2 AS seq FROM user_info""",
)
def user_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user inserted and then updated; those in debt get another level."""
    inserted = V.user_info(spark, sf_dir).withColumn("seq", F.lit(1))
    in_debt = V.user_info(spark, sf_dir, F.expr(V.IN_DEBT)).withColumn("user_level", F.lit("SUSPENDED"))
    updated = in_debt.unionByName(V.user_info(spark, sf_dir, ~F.expr(V.IN_DEBT))).withColumn("seq", F.lit(2))
    return users.latest_users(inserted.unionByName(updated)).select("id", "user_level", "birthday", "seq")


@query(
    "q_user_json_lookup",
    f"""WITH {V.USER_INFO} SELECT id, '{{"id":"' || id || '","gender":"' || gender || '","user_level":"' || user_level
    || '","birthday":"' || birthday || '"}}' AS user_json FROM user_info""",
)
def user_json_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users.user_json(V.user_info(spark, sf_dir))


@query(
    "q_user_cache_aside",
    f"""WITH {V.USER_INFO}, {V.ORDER_INFO} SELECT id, user_level FROM user_info
    WHERE balance >= 5000 OR (balance >= 0 AND id IN (SELECT user_id FROM order_info))""",
)
def user_cache_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = V.user_info(spark, sf_dir, F.expr(V.CACHED))
    table = V.user_info(spark, sf_dir, ~F.expr(V.IN_DEBT))
    asked = V.order_info(spark, sf_dir).select(F.col("user_id").alias("id"))
    return users.write_back(cache, table, asked).select("id", "user_level")


@query(
    "q_exists_lookup",
    f"""WITH {V.USER_INFO}, {V.ORDER_INFO}
    SELECT id, login_name FROM user_info WHERE id IN (SELECT user_id FROM order_info)""",
)
def exists_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    buyers = V.order_info(spark, sf_dir).select(F.col("user_id").alias("id"))
    return keyed.exists_in(V.user_info(spark, sf_dir).select("id", "login_name"), buyers, ["id"])


@query(
    "q_blacklist_filter",
    f"""WITH {V.USER_INFO}, {V.ORDER_INFO} SELECT id, user_id FROM order_info
    WHERE user_id NOT IN (SELECT id FROM user_info WHERE balance < 0)""",
)
def blacklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = V.user_info(spark, sf_dir, F.expr(V.IN_DEBT)).select("id")
    return keyed.exclude_listed(V.order_info(spark, sf_dir).select("id", "user_id"), listed, "user_id")


@query(
    "q_scalar_lookup",
    f"""WITH {V.USER_INFO}, {V.ORDER_INFO}, last AS (
      SELECT user_id, CAST(trunc(total_amount) AS BIGINT) AS value FROM order_info
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY create_time DESC, id DESC) = 1)
    SELECT u.id, coalesce(value, 0) AS value FROM user_info u LEFT JOIN last ON u.id = last.user_id""",
)
def scalar_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = V.order_info(spark, sf_dir).select(
        F.col("user_id").alias("id"), F.col("id").alias("order_id"), "create_time", "total_amount"
    )
    return keyed.scalar_lookup(
        V.user_info(spark, sf_dir).select("id"), orders, "id", "total_amount", ("create_time", "order_id")
    )


# ---------------------------------------------------------------- sale details


@query(
    "q_sale_full_outer",
    f"""WITH {V.ORDER_INFO}, {V.ORDER_DETAIL}
    SELECT coalesce(d.order_id, o.id) AS order_id, o.id AS info_id, o.user_id, o.order_status,
      d.id AS order_detail_id, d.sku_id
    FROM (SELECT * FROM order_info WHERE order_status <> 'P') o FULL OUTER JOIN order_detail d ON o.id = d.order_id""",
)
def sale_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders still in status P have not arrived."""
    return sale.full_outer(_arrived(spark, sf_dir), V.line_keys(spark, sf_dir))


def _arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.order_info(spark, sf_dir).where(F.col("order_status") != "P")


@query(
    "q_sale_pending",
    f"""WITH {V.ORDER_INFO}, {V.ORDER_DETAIL}, arrived AS (SELECT * FROM order_info WHERE order_status <> 'P')
    SELECT 'line' AS side, id AS record_id, order_id FROM order_detail
    WHERE order_id NOT IN (SELECT id FROM arrived)
    UNION ALL SELECT 'order', id, id FROM arrived WHERE id NOT IN (SELECT order_id FROM order_detail)""",
)
def sale_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale.pending(_arrived(spark, sf_dir), V.line_keys(spark, sf_dir))


@query(
    "q_sale_interval_join",
    f"""WITH {V.SALE_DETAIL} SELECT order_detail_id, order_id, order_status, create_time, sku_id, sku_price, sku_name, dt
    FROM sale_detail WHERE delay_s BETWEEN -100 AND 100""",
)
def sale_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    details = V.timed_details(V.order_detail(spark, sf_dir), orders)
    return sale.join_orders_details(V.timed_orders(orders), details).drop("user_id", "detail_time")


def _sales(spark: SparkSession, sf_dir: str, raw_days: tuple[str, str] | None = None) -> DataFrame:
    """Every line with its order and its buyer."""
    known = V.user_info(spark, sf_dir, ~F.expr(V.IN_DEBT))
    return sale.sale_details(_orders(spark, sf_dir, raw_days), V.order_detail(spark, sf_dir), known, V.AS_OF)


@query("q_sale_detail", f"WITH {V.SALE_DETAIL} SELECT * EXCLUDE (delay_s) FROM sale_detail")
def sale_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales(spark, sf_dir)


@query(
    "q_sale_user_enrich",
    f"""WITH {V.ORDER_INFO}, {V.USER_INFO}
    SELECT o.id AS order_id, o.user_id, u.gender AS user_gender,
      CASE WHEN balance >= 5000 THEN 'VIP' ELSE user_level END AS user_level
    FROM order_info o LEFT JOIN (SELECT * FROM user_info WHERE balance >= 0) u ON o.user_id = u.id""",
)
def sale_user_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers from the cache, which calls its users VIP, else from the table."""
    cache = V.user_info(spark, sf_dir, F.expr(V.CACHED)).withColumn("user_level", F.lit("VIP"))
    known = users.resolve_users(cache, V.user_info(spark, sf_dir, ~F.expr(V.IN_DEBT)))
    orders = V.order_info(spark, sf_dir).select(F.col("id").alias("order_id"), "user_id")
    return sale.add_buyer(orders, known, V.AS_OF).select("order_id", "user_id", "user_gender", "user_level")


# ---------------------------------------------------------------- search

_HITS = f"""{V.SALE_DETAIL}, hits AS (
  SELECT * FROM sale_detail WHERE list_contains(regexp_extract_all(lower(sku_name), '[a-z0-9_]+'), '{V.KEYWORD}'))"""
_RATIOS = """, parts AS (SELECT count(*) AS total, count(*) FILTER (WHERE user_gender = 'M') AS male,
    count(*) FILTER (WHERE user_age < 20) AS young, count(*) FILTER (WHERE user_age >= 30) AS old FROM hits),
  shares AS (SELECT total,
    floor(male * CAST(1000 AS DOUBLE) / total + 0.5) / 10 AS male_ratio,
    floor(young * CAST(1000 AS DOUBLE) / total + 0.5) / 10 AS young_ratio,
    floor(old * CAST(1000 AS DOUBLE) / total + 0.5) / 10 AS old_ratio FROM parts),
  figures AS (SELECT *, floor((100 - male_ratio) * 10 + 0.5) / 10 AS female_ratio,
    floor((100 - young_ratio - old_ratio) * 10 + 0.5) / 10 AS middle_ratio FROM shares)"""


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_sales(spark, sf_dir), V.KEYWORD)


@query("q_search_match", f"WITH {_HITS} SELECT order_detail_id, sku_name, dt FROM hits")
def search_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir).select("order_detail_id", "sku_name", "dt")


@query(
    "q_search_day",
    f"WITH {_HITS} SELECT order_detail_id, sku_name, user_age FROM hits WHERE dt = '{V.DAY}'",
)
def search_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(_sales(spark, sf_dir, (V.ORDER_RAW_DAY, V.ORDER_RAW_DAY)), V.KEYWORD, V.DAY)
    return found.select("order_detail_id", "sku_name", "user_age")


@query(
    "q_search_page",
    f"""WITH {_HITS} SELECT order_detail_id, sku_name, user_age, sku_price FROM hits
    ORDER BY order_detail_id OFFSET {(PAGE - 1) * PAGE_SIZE} LIMIT {PAGE_SIZE}""",
)
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _hits(spark, sf_dir).select("order_detail_id", "sku_name", "user_age", "sku_price")
    return search.page(found, PAGE, PAGE_SIZE)


@query("q_search_total", f"WITH {_HITS} SELECT count(*) AS total FROM hits")
def search_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.total_hits(_hits(spark, sf_dir))


@query(
    "q_gender_terms",
    f"""WITH {_HITS} SELECT user_gender, count(*) AS n FROM hits WHERE user_gender IS NOT NULL
    GROUP BY 1 ORDER BY n DESC, 1 LIMIT 2""",
)
def gender_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_terms(_hits(spark, sf_dir), "user_gender", 2)


@query(
    "q_age_terms",
    f"""WITH {_HITS} SELECT user_age, count(*) AS n FROM hits WHERE user_age IS NOT NULL
    GROUP BY 1 ORDER BY n DESC, 1 LIMIT 100""",
)
def age_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_terms(_hits(spark, sf_dir), "user_age", 100)


@query(
    "q_gender_ratio",
    f"""WITH {_HITS}{_RATIOS} SELECT '{C.LABEL_MALE}' AS name, male_ratio AS value FROM figures
    UNION ALL SELECT '{C.LABEL_FEMALE}', female_ratio FROM figures""",
)
def gender_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.gender_ratio(_hits(spark, sf_dir))


@query(
    "q_age_ratio",
    f"""WITH {_HITS}{_RATIOS} SELECT '{C.LABEL_YOUNG}' AS name, young_ratio AS value FROM figures
    UNION ALL SELECT '{C.LABEL_MIDDLE}', middle_ratio FROM figures
    UNION ALL SELECT '{C.LABEL_OLD}', old_ratio FROM figures""",
)
def age_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.age_ratio(_hits(spark, sf_dir))


@query(
    "q_sale_report",
    f"""WITH {_HITS}{_RATIOS}, page AS (SELECT order_detail_id FROM hits
      ORDER BY order_detail_id OFFSET {(PAGE - 1) * PAGE_SIZE} LIMIT {PAGE_SIZE})
    SELECT total, '{C.LABEL_YOUNG}=' || young_ratio || ',{C.LABEL_MIDDLE}=' || middle_ratio
      || ',{C.LABEL_OLD}=' || old_ratio AS ages,
      '{C.LABEL_MALE}=' || male_ratio || ',{C.LABEL_FEMALE}=' || female_ratio AS genders,
      (SELECT string_agg(order_detail_id, ',' ORDER BY order_detail_id) FROM page) AS page_ids FROM figures""",
)
def sale_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = search.sale_report(_sales(spark, sf_dir), V.KEYWORD, PAGE, PAGE_SIZE)

    def flat(stat: int):
        options = F.get(F.col("stat"), F.lit(stat)).getField("options")
        return F.array_join(
            F.transform(options, lambda o: F.concat_ws("=", o.getField("name"), o.getField("value").cast("string"))),
            ",",
        )

    ids = F.array_join(F.transform("detail", lambda d: d.getField("order_detail_id")), ",")
    return report.select("total", flat(0).alias("ages"), flat(1).alias("genders"), ids.alias("page_ids"))


_ROW_JSON = """'{' || concat_ws(',', '"order_detail_id":"' || order_detail_id || '"', '"order_id":"' || order_id || '"',
    '"order_status":"' || order_status || '"', '"create_time":"' || create_time || '"', '"user_id":"' || user_id || '"',
    '"sku_id":"' || sku_id || '"', '"user_gender":"' || user_gender || '"', '"user_age":' || user_age,
    '"user_level":"' || user_level || '"', '"sku_price":' || sku_price, '"sku_name":"' || sku_name || '"',
    '"dt":"' || dt || '"') || '}'"""


def _stat_sql(title: str, options: list[tuple[str, str]]) -> str:
    listed = " || ',' || ".join(f"""'{{"name":"{label}","value":' || {value} || '}}'""" for label, value in options)
    return f"""'{{"title":"{title}","options":[' || {listed} || ']}}'"""


_AGES_JSON = _stat_sql(
    C.TITLE_AGE, [(C.LABEL_YOUNG, "young_ratio"), (C.LABEL_MIDDLE, "middle_ratio"), (C.LABEL_OLD, "old_ratio")]
)
_GENDERS_JSON = _stat_sql(C.TITLE_GENDER, [(C.LABEL_MALE, "male_ratio"), (C.LABEL_FEMALE, "female_ratio")])


@query(
    "q_sale_report_json",
    f"""WITH {_HITS}{_RATIOS}, page AS (SELECT * FROM hits
      ORDER BY order_detail_id OFFSET {(PAGE - 1) * PAGE_SIZE} LIMIT {PAGE_SIZE})
    SELECT '{{"total":' || total || ',"stat":[' || {_AGES_JSON} || ',' || {_GENDERS_JSON} || '],"detail":['
      || (SELECT coalesce(string_agg({_ROW_JSON}, ',' ORDER BY order_detail_id), '') FROM page) || ']}}' AS value
    FROM figures""",
)
def sale_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.sale_report_json(search.sale_report(_sales(spark, sf_dir), V.KEYWORD, PAGE, PAGE_SIZE))
