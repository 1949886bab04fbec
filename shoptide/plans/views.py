"""The shop's records as views over the given tables, in Spark and, for comparison, as SQL common table
expressions. ``days`` limits a view to a range of days on the raw column, so that it reaches the file scan.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.sources.tables import between_days, read_table

AS_OF = "2024-01-31"
DAY = "2024-01-15"
DAY_BEFORE = "2024-01-14"
KEYWORD = "red"
NOW_MS = 1706659200000
NOON = 12

# Orders are moved this many days ahead, into the time of the events.
ORDER_SHIFT = 10_000
ORDER_RAW_DAY = "1996-08-29"
ORDER_RAW_DAY_BEFORE = "1996-08-28"


def raw_day(day: str) -> str:
    """The day of the given orders that is this day of the shop."""
    return str(date.fromisoformat(day) - timedelta(days=ORDER_SHIFT))


def _text(column: Column) -> Column:
    return column.cast("string")


def _money(column: Column) -> Column:
    return _text(column.cast("decimal(18,2)"))


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _events(spark: SparkSession, sf_dir: str, days: tuple[str | None, str] | None) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    return events if days is None else between_days(events, "ts", *days)


def _client() -> list[Column]:
    digit = F.pmod(F.col("user_id"), F.lit(10))
    return [
        F.lit("shop").alias("appid"),
        F.concat(F.lit("area_"), _text(digit)).alias("area"),
        F.when(digit < 3, F.lit("ios")).otherwise(F.lit("android")).alias("os"),
    ]


def startup_columns() -> list[Column]:
    digit, week = F.pmod(F.col("user_id"), F.lit(10)), F.pmod(F.col("user_id"), F.lit(7))
    return [
        F.concat(F.lit("mid_"), _text(F.col("user_id"))).alias("mid"),
        _text(F.col("user_id")).alias("uid"),
        *_client(),
        F.when(digit < 3, F.lit("appstore")).otherwise(F.concat(F.lit("ch_"), _text(week))).alias("ch"),
        F.lit("startup").alias("type"),
        F.concat(F.lit("1."), _text(F.pmod(F.col("user_id"), F.lit(3))), F.lit(".0")).alias("vs"),
        _millis("ts").alias("ts"),
    ]


def startup_log(spark: SparkSession, sf_dir: str, days: tuple[str | None, str] | None = None) -> DataFrame:
    views = _events(spark, sf_dir, days).where(F.col("event_type") == "view")
    return views.select(*startup_columns(), "event_id")


STARTUP_LOG = """startup_log AS (
  SELECT 'mid_' || user_id AS mid, CAST(user_id AS VARCHAR) AS uid, 'shop' AS appid,
    'area_' || (user_id % 10) AS area,
    CASE WHEN user_id % 10 < 3 THEN 'ios' ELSE 'android' END AS os,
    CASE WHEN user_id % 10 < 3 THEN 'appstore' ELSE 'ch_' || (user_id % 7) END AS ch,
    'startup' AS type, '1.' || (user_id % 3) || '.0' AS vs,
    epoch_us(ts) // 1000 AS ts, event_id,
    strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events WHERE event_type = 'view')"""

FIRST_STARTS = (
    STARTUP_LOG
    + """, dau AS (
  SELECT * FROM startup_log
  QUALIFY row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, event_id) = 1)"""
)


def event_columns() -> list[Column]:
    kind = F.col("event_type")
    evid = (
        F.when(kind == "click", "clickItem")
        .when(kind == "purchase", "coupon")
        .when(kind == "view", "addCart")
        .when(kind == "signup", "addFavor")
        .otherwise("addComment")
    )
    device = F.call_function("div", F.col("user_id"), F.lit(10))
    return [
        F.concat(F.lit("mid_"), _text(device)).alias("mid"),
        _text(F.col("user_id")).alias("uid"),
        *_client(),
        F.lit("event").alias("type"),
        evid.alias("evid"),
        _text(F.pmod(F.col("event_id"), F.lit(50)) + 1).alias("pgid"),
        _text(F.pmod(F.col("event_id") * 7, F.lit(50)) + 1).alias("npgid"),
        F.get_json_object("props", "$.k").alias("itemid"),
        _millis("ts").alias("ts"),
    ]


def event_log(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    return _events(spark, sf_dir, days).select(*event_columns())


EVENT_LOG = """event_log AS (
  SELECT 'mid_' || (user_id // 10) AS mid, CAST(user_id AS VARCHAR) AS uid, 'shop' AS appid,
    'area_' || (user_id % 10) AS area,
    CASE WHEN user_id % 10 < 3 THEN 'ios' ELSE 'android' END AS os, 'event' AS type,
    CASE event_type WHEN 'click' THEN 'clickItem' WHEN 'purchase' THEN 'coupon' WHEN 'view' THEN 'addCart'
      WHEN 'signup' THEN 'addFavor' ELSE 'addComment' END AS evid,
    CAST(event_id % 50 + 1 AS VARCHAR) AS pgid, CAST((event_id * 7) % 50 + 1 AS VARCHAR) AS npgid,
    json_extract_string(props, '$.k') AS itemid, epoch_us(ts) // 1000 AS ts
  FROM events)"""


def order_columns() -> list[Column]:
    day = _text(F.date_add(F.col("o_orderdate").cast("date"), ORDER_SHIFT))
    hour = F.lpad(_text(F.pmod(F.col("o_orderkey"), F.lit(24))), 2, "0")
    return [
        _text(F.col("o_orderkey")).alias("id"),
        _text(F.pmod(F.col("o_custkey"), F.lit(25))).alias("province_id"),
        F.concat(F.lit("Customer#"), F.lpad(_text(F.col("o_custkey")), 9, "0")).alias("consignee"),
        F.concat(F.lit("138"), F.lpad(_text(F.col("o_custkey")), 8, "0")).alias("consignee_tel"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_way"),
        _text(F.col("o_custkey")).alias("user_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.concat(day, F.lit(" "), hour, F.lit(":30:00")).alias("create_time"),
    ]


def order_info(spark: SparkSession, sf_dir: str, raw_days: tuple[str, str] | None = None) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    if raw_days is not None:
        orders = between_days(orders, "o_orderdate", *raw_days)
    return orders.select(*order_columns())


def further_order_columns() -> list[Column]:
    """The fields of an order record that only parsing looks at."""
    key, user = _text(F.col("o_orderkey")), _text(F.col("o_custkey"))
    return [
        F.concat(F.lit("comment "), key).alias("order_comment"),
        F.concat(F.lit("/img/"), key, F.lit(".jpg")).alias("img_url"),
        _text(F.date_add(F.col("o_orderdate").cast("date"), ORDER_SHIFT + 1)).alias("expire_time"),
        F.concat(F.lit("street "), user).alias("delivery_address"),
        _text(F.date_add(F.col("o_orderdate").cast("date"), ORDER_SHIFT)).alias("operate_time"),
        F.concat(F.lit("track-"), key).alias("tracking_no"),
        _text(F.call_function("div", F.col("o_orderkey"), F.lit(10))).alias("parent_order_id"),
        F.concat(F.lit("out-"), key).alias("out_trade_no"),
        F.concat(F.lit("goods \"of\" "), user).alias("trade_body"),
    ]


FURTHER_ORDER = f"""further AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS key, 'comment ' || o_orderkey AS order_comment, '/img/' || o_orderkey || '.jpg' AS img_url,
    strftime(CAST(o_orderdate AS DATE) + {ORDER_SHIFT + 1}, '%Y-%m-%d') AS expire_time,
    'street ' || o_custkey AS delivery_address,
    strftime(CAST(o_orderdate AS DATE) + {ORDER_SHIFT}, '%Y-%m-%d') AS operate_time,
    'track-' || o_orderkey AS tracking_no, CAST(o_orderkey // 10 AS VARCHAR) AS parent_order_id,
    'out-' || o_orderkey AS out_trade_no, 'goods "of" ' || o_custkey AS trade_body
  FROM orders)"""

EXACT_SUM = "CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)"
ORDER_INFO = f"""order_info AS (
  SELECT *, create_day || ' ' || create_hour || ':30:00' AS create_time, create_day AS create_date FROM (
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
      'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS consignee,
      '138' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS consignee_tel,
      o_orderstatus AS order_status, o_orderpriority AS payment_way, CAST(o_custkey AS VARCHAR) AS user_id,
      o_totalprice AS total_amount,
      strftime(CAST(o_orderdate AS DATE) + {ORDER_SHIFT}, '%Y-%m-%d') AS create_day,
      lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') AS create_hour
    FROM orders))"""


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_columns(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"))


def line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines where the product's name does not matter."""
    return read_table(spark, sf_dir, "lineitem").select(
        _line_id(), _text(F.col("l_orderkey")).alias("order_id"), _text(F.col("l_partkey")).alias("sku_id")
    )


def _line_id() -> Column:
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int")
    ).alias("id")


def line_columns(lines: DataFrame, parts: DataFrame, extra: tuple[Column, ...] = ()) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        _line_id(),
        _text(F.col("l_orderkey")).alias("order_id"),
        F.col("p_name").alias("sku_name"),
        _text(F.col("l_partkey")).alias("sku_id"),
        _money(F.col("l_extendedprice")).alias("order_price"),
        _text(quantity).alias("sku_num"),
        ((F.col("l_linenumber") - 1) * 40 - 60).alias("delay_s"),
        *extra,
    )


ORDER_DETAIL = """order_detail AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS id,
    CAST(l_orderkey AS VARCHAR) AS order_id, p_name AS sku_name, CAST(l_partkey AS VARCHAR) AS sku_id,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS order_price,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS sku_num, (l_linenumber - 1) * 40 - 60 AS delay_s
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def timed_orders(orders: DataFrame) -> DataFrame:
    """Orders with their arrival, taken to be their creation."""
    return orders.withColumn("order_time", F.col("create_time").cast("timestamp"))


def timed_details(details: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with their arrival, up to a minute before and three minutes after their order."""
    created = orders.select(F.col("id").alias("order_id"), F.col("create_time").cast("timestamp").alias("at"))
    arrival = F.col("at") + F.make_dt_interval(secs=F.col("delay_s"))
    return details.join(created, "order_id").withColumn("detail_time", arrival).drop("at")


def customer_columns() -> list[Column]:
    day = F.date_add(F.lit("1960-01-01").cast("date"), F.pmod(F.col("c_custkey") * 131, F.lit(18000)).cast("int"))
    return [
        _text(F.col("c_custkey")).alias("id"),
        F.col("c_name").alias("login_name"),
        F.col("c_mktsegment").alias("user_level"),
        _text(day).alias("birthday"),
        F.when(F.pmod(F.col("c_custkey"), F.lit(3)) == 0, "F").otherwise("M").alias("gender"),
    ]


def user_info(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    customers = read_table(spark, sf_dir, "customer")
    if where is not None:
        customers = customers.where(where)
    return customers.select(*customer_columns())


USER_INFO = """user_info AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
    strftime(DATE '1960-01-01' + CAST((c_custkey * 131) % 18000 AS INTEGER), '%Y-%m-%d') AS birthday,
    CASE WHEN c_custkey % 3 = 0 THEN 'F' ELSE 'M' END AS gender, c_acctbal AS balance
  FROM customer)"""

# Users by balance: those in debt are unknown to the shop in some queries, well-off ones are cached.
IN_DEBT = "c_acctbal < 0"
CACHED = "c_acctbal >= 5000"


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as clients send them, starts and events mixed, without a time; comments lack a type."""
    return log_columns(read_table(spark, sf_dir, "events"))


def log_columns(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    log_type = F.when(kind == "view", "startup").when(kind != "error", "event")
    return events.select(
        F.to_json(
            F.struct(
                F.concat(F.lit("mid_"), _text(F.col("user_id"))).alias("mid"),
                log_type.alias("type"),
                F.col("event_id").alias("seq"),
            )
        ).alias("value")
    )


RAW_LOGS = """raw_logs AS (
  SELECT event_type, '{"mid":"mid_' || user_id || '"' || CASE event_type WHEN 'view' THEN ',"type":"startup"'
      WHEN 'error' THEN '' ELSE ',"type":"event"' END || ',"seq":' || event_id AS opened
  FROM events)"""


def _pairs(df: DataFrame, *names: str) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), _text(F.col(n)).alias("value")) for n in names])


def _operation(column: str, insert: str, update: str) -> Column:
    return F.when(F.col(column) == insert, "INSERT").when(F.col(column) == update, "UPDATE").otherwise("DELETE")


CDC_ORDER_FIELDS = ["id", "consignee_tel", "order_status", "user_id", "total_amount", "create_time"]
CDC_DETAIL_FIELDS = ["id", "order_id", "sku_id", "order_price", "sku_num"]


def cdc_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database log: every order begins a transaction; orders, lines, users and products change."""

    def change(df: DataFrame, table: str, op: Column, *names: str) -> DataFrame:
        return df.select(
            F.lit("ROWDATA").alias("entry_type"), F.lit(table).alias("table"), op.alias("op"),
            _pairs(df, *names).alias("after"),
        )

    orders = order_info(spark, sf_dir).withColumn("total_amount", _money(F.col("total_amount")))
    lines = read_table(spark, sf_dir, "lineitem").select(
        _line_id(),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        _money(F.col("l_extendedprice")).alias("order_price"),
        F.col("l_quantity").cast("int").alias("sku_num"),
        "l_returnflag",
    )
    parts = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"))
    begins = orders.select(F.lit("TRANSACTIONBEGIN").alias("entry_type"))
    return (
        change(orders, "order_info", _operation("order_status", "O", "F"), *CDC_ORDER_FIELDS)
        .unionByName(change(lines, "order_detail", _operation("l_returnflag", "N", "A"), *CDC_DETAIL_FIELDS))
        .unionByName(
            change(
                user_info(spark, sf_dir),
                "user_info",
                _operation("user_level", "BUILDING", "MACHINERY"),
                "id", "login_name", "user_level", "birthday", "gender",
            )
        )
        .unionByName(change(parts, "base_sku", F.lit("INSERT"), "id", "sku_name"))
        .unionByName(begins, allowMissingColumns=True)
    )


CDC_CHANGE = f"""{ORDER_INFO}, {ORDER_DETAIL}, {USER_INFO}, cdc_change AS (
  SELECT 'ROWDATA' AS entry_type, 'order_info' AS "table",
    CASE order_status WHEN 'O' THEN 'INSERT' WHEN 'F' THEN 'UPDATE' ELSE 'DELETE' END AS op,
    '{{"id":"' || id || '","consignee_tel":"' || consignee_tel || '","order_status":"' || order_status
      || '","user_id":"' || user_id || '","total_amount":"' || CAST(total_amount AS DECIMAL(18,2))
      || '","create_time":"' || create_time || '"}}' AS image
  FROM order_info
  UNION ALL
  SELECT 'ROWDATA', 'order_detail',
    CASE l_returnflag WHEN 'N' THEN 'INSERT' WHEN 'A' THEN 'UPDATE' ELSE 'DELETE' END,
    '{{"id":"' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER))
      || '","order_id":"' || l_orderkey || '","sku_id":"' || l_partkey || '","order_price":"'
      || CAST(l_extendedprice AS DECIMAL(18,2)) || '","sku_num":"' || CAST(l_quantity AS INTEGER) || '"}}'
  FROM lineitem
  UNION ALL
  SELECT 'ROWDATA', 'user_info',
    CASE user_level WHEN 'BUILDING' THEN 'INSERT' WHEN 'MACHINERY' THEN 'UPDATE' ELSE 'DELETE' END,
    '{{"id":"' || id || '","login_name":"' || login_name || '","user_level":"' || user_level
      || '","birthday":"' || birthday || '","gender":"' || gender || '"}}'
  FROM user_info
  UNION ALL
  SELECT 'ROWDATA', 'base_sku', 'INSERT', '{{"id":"' || p_partkey || '","sku_name":"' || p_name || '"}}' FROM part
  UNION ALL
  SELECT 'TRANSACTIONBEGIN', NULL, NULL, NULL FROM orders)"""

ROUTED = (
    CDC_CHANGE
    + """, routed AS (
  SELECT "table", op, image, "table" AS topic FROM cdc_change
  WHERE entry_type = 'ROWDATA' AND (("table" IN ('order_info', 'order_detail') AND op = 'INSERT')
    OR ("table" = 'user_info' AND op IN ('INSERT', 'UPDATE'))))"""
)

# Lines with their order and buyer, all of them; buyers in debt are unknown.
SALE_DETAIL = f"""{ORDER_INFO}, {ORDER_DETAIL}, {USER_INFO}, sale_detail AS (
  SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time,
    coalesce(u.id, o.user_id) AS user_id, d.sku_id, u.gender AS user_gender,
    CAST(date_diff('day', CAST(u.birthday AS DATE), DATE '{AS_OF}') // 365 AS INTEGER) AS user_age,
    u.user_level, CAST(d.order_price AS DOUBLE) AS sku_price, d.sku_name, o.create_date AS dt, d.delay_s
  FROM order_detail d JOIN order_info o ON d.order_id = o.id
  LEFT JOIN (SELECT * FROM user_info WHERE balance >= 0) u ON o.user_id = u.id)"""
