"""Queries that run streams over the given tables, or put batches into keyed tables, and read the result back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide import schemas
from shoptide.functions import fields, records
from shoptide.operators import dashboard, gmv, relevance, search
from shoptide.operators.cells import cell_counts
from shoptide.plans import batch as B
from shoptide.plans import views as V
from shoptide.plans.registry import query
from shoptide.session import removing_shuffles, scratch_dir
from shoptide.sinks import outputs
from shoptide.sinks.keyed_table import KeyedTable
from shoptide.sources.streams import parse_changes, table_stream, topic_files
from shoptide.sources.tables import read_table
from shoptide.streaming import jobs, lateness


def text_fields(*names: str, **typed: T.DataType) -> T.StructType:
    listed = [T.StructField(n, T.StringType()) for n in names]
    return T.StructType(listed + [T.StructField(n, t) for n, t in typed.items()])


_TYPED = {"user_age": T.IntegerType(), "sku_price": T.DoubleType()}
DAU_DETAIL = T.StructType([*schemas.STARTUP_LOG.fields, *text_fields("log_date", "log_hour", offset=T.LongType()).fields])
SEEN = text_fields("mid", "log_date")
ORDER_ROWS = T.StructType(
    [*schemas.ORDER_INFO.fields, *text_fields("create_date", "create_hour", "create_month", offset=T.LongType()).fields]
)
USER_ROWS = T.StructType([*schemas.USER_INFO.fields, T.StructField("offset", T.LongType())])
ALERT_DOCS = T.StructType(
    [
        *text_fields("doc_id", "mid").fields,
        *(T.StructField(n, T.ArrayType(T.StringType())) for n in ("uids", "item_ids", "events")),
        T.StructField("window_start", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("index_name", T.StringType()),
    ]
)
SALE_DOCS = T.StructType(
    [
        *(T.StructField(n, _TYPED.get(n, T.StringType())) for n in schemas.SALE_DETAIL_COLUMNS),
        *text_fields("index_name", offset=T.LongType()).fields,
    ]
)


def dau_tables(root: str) -> tuple[KeyedTable, KeyedTable]:
    """First starts, and the devices seen, by day."""
    detail = KeyedTable(f"{root}/dau", DAU_DETAIL, key="mid", partition="log_date", order=("ts", "offset"))
    return detail, KeyedTable(f"{root}/seen", SEEN, key="mid", partition="log_date")


def order_table(root: str) -> KeyedTable:
    """Orders by month. Within a month, rows of a day sit in few row groups, since they arrive together."""
    return KeyedTable(f"{root}/orders", ORDER_ROWS, key="id", partition="create_month", order=("offset",))


def user_table(root: str) -> KeyedTable:
    """Users in buckets, so that a batch of sales reads the buckets of its buyers."""
    return KeyedTable(f"{root}/users", USER_ROWS, key="id", order=("offset",), buckets=8)


def alert_index(root: str) -> KeyedTable:
    return KeyedTable(f"{root}/alerts", ALERT_DOCS, key="doc_id", partition="index_name", order=("ts",))


def sale_index(root: str, day: str = "index_name") -> KeyedTable:
    return KeyedTable(f"{root}/sales", SALE_DOCS, key="order_detail_id", partition=day, order=("offset",))


# Files of a topic that make up a batch, at least, and about so many rows a file where there are more.
FILES, FILE_ROWS = 4, 250_000


def topic(
    spark: SparkSession, root: str, name: str, batches: list[DataFrame], source: DataFrame | None = None, packed: bool = False
) -> DataFrame:
    """Keeps batches of (columns, offset, timestamp) as a topic's files of JSON text; a stream that takes one at a time.

    Every batch is as many files; of a large ``source``, the table all batches come from, they are more. A ``packed``
    topic is for one reader: its files are compressed, and go when the batch they make up has been worked off.
    """
    packing = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"} if packed else {}
    read_once = {"cleanSource": "delete"} if packed else {}
    files = FILES if source is None else max(FILES, source.count() // (len(batches) * FILE_ROWS))
    for rows in batches:
        text = F.to_json(F.struct(*[c for c in rows.columns if c not in ("offset", "timestamp")]))
        records = rows.select(text.alias("value"), F.col("offset").cast("bigint").alias("offset"), "timestamp")
        with removing_shuffles(spark):
            records.repartition(files).write.mode("append").options(**packing).json(f"{root}/topics/topic={name}")
    return topic_files(spark, name, f"{root}/topics", maxFilesPerTrigger=str(files), **read_once)


def _arrived(df: DataFrame, offset: str, arrival: Column | None = None) -> DataFrame:
    """A table's rows with their offset and arrival (``ts``, in milliseconds, unless given)."""
    at = F.timestamp_millis("ts") if arrival is None else arrival
    return df.withColumn("timestamp", at).withColumnRenamed(offset, "offset")


def _thirds(df: DataFrame, ts: str = "ts") -> list[DataFrame]:
    """Rows up to noon of the 10th, up to noon of the 20th, and after: a day goes on from one batch into the next."""
    at = F.timestamp_millis(ts)
    first, second = (F.lit(f"2024-01-{day} 12:00:00").cast("timestamp") for day in (10, 20))
    return [df.where(at < first), df.where((at >= first) & (at < second)), df.where(at >= second)]


# Of these starts, those of the first batch are delivered with the last, far later than the watermark's bound.
LATE_START = "event_id % 50 = 0"
_FIRST_BATCH = "ts < epoch_ms(TIMESTAMP '2024-01-10 12:00:00')"


def finish(writer) -> None:
    """Work off everything there is."""
    jobs.start(writer, every_s=None).awaitTermination()


# ---------------------------------------------------------------- keyed tables


@query(
    "q_gmv_upsert",
    f"""WITH {V.ORDER_INFO} SELECT id, substr(consignee_tel, 1, 4) || '*******' AS consignee_tel, create_date,
    CASE order_status WHEN 'F' THEN 'DONE' ELSE order_status END AS order_status, total_amount FROM order_info""",
)
def gmv_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders put once, then the finished ones again under another status."""
    table = order_table(scratch_dir(spark, "gmv-")).create(spark)
    rows = gmv.with_month(gmv.ingest_orders(V.order_info(spark, sf_dir))).withColumn("offset", F.lit(0).cast("bigint"))
    absent = [f for f in ORDER_ROWS.fields if f.name not in rows.columns]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})
    done = rows.where(F.col("order_status") == "F").withColumn("order_status", F.lit("DONE"))
    table.write(rows, 0)
    table.write(done, 1)
    return table.read(spark).select("id", "consignee_tel", "create_date", "order_status", "total_amount")


@query(
    "q_sale_index_upsert",
    f"""WITH {V.SALE_DETAIL} SELECT order_detail_id, user_id, dt, 'sale_detail-{V.AS_OF}' AS index_name,
    CASE order_status WHEN 'F' THEN 'DONE' ELSE order_status END AS order_status FROM sale_detail
    UNION ALL SELECT NULL, user_id, dt, 'sale_detail-{V.AS_OF}', order_status FROM sale_detail WHERE order_status = 'P'""",
)
def sale_index_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales put by line, some again; documents without an id are added, each on its own."""
    table = sale_index(scratch_dir(spark, "sale-")).create(spark)
    sales = B._sales(spark, sf_dir).withColumn("index_name", fields.index_name("sale_detail", V.AS_OF))
    sales = sales.withColumn("offset", F.lit(0).cast("bigint"))
    table.write(sales, 0, spread=False)  # all in one index
    # Read back, so that orders, lines and buyers are joined once.
    put, status = table.history(spark, before_batch=1), F.col("order_status")
    again = {"order_status": F.when(status == "F", "DONE").otherwise(status), "order_detail_id": F.when(status != "P", F.col("order_detail_id"))}
    table.write(put.where(status.isin("F", "P")).withColumns(again), 1, spread=False)
    return table.read(spark).select("order_detail_id", "user_id", "dt", "index_name", "order_status")


# ---------------------------------------------------------------- stored tables, read by the dashboard


@query(
    "q_sale_report_index",
    f"""WITH {B._HITS}, day AS (SELECT * FROM hits WHERE dt = '{V.DAY}'){B._RATIOS.replace("FROM hits", "FROM day")}
    SELECT total, male_ratio, female_ratio, young_ratio, middle_ratio, old_ratio,
      (SELECT string_agg(order_detail_id, ',' ORDER BY order_detail_id) FROM
        (SELECT order_detail_id FROM day ORDER BY order_detail_id LIMIT {B.PAGE_SIZE})) AS page_ids FROM figures""",
)
def sale_report_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales put into an index by month, then one day searched: of that month's folder the day's rows are read."""
    schema = T.StructType([*SALE_DOCS.fields, *text_fields("month").fields])
    table = KeyedTable(scratch_dir(spark, "report-"), schema, key="order_detail_id", partition="month", order=("offset",)).create(spark)
    sales = B._sales(spark, sf_dir).withColumn("index_name", fields.index_name("sale_detail", V.AS_OF))
    table.write(sales.withColumns({"offset": F.lit(0).cast("bigint"), "month": F.substring("dt", 1, 7)}), 0)
    day = table.read(spark, [V.DAY[:7]], fixed=F.col("dt") == V.DAY)
    return search.day_report(search.search(day, V.KEYWORD), B.PAGE_SIZE)


@query(
    "q_search_after",
    f"""WITH {B._HITS} SELECT order_detail_id, sku_name FROM hits
    WHERE order_detail_id > (SELECT order_detail_id FROM hits ORDER BY 1 OFFSET {B.PAGE_SIZE - 1} LIMIT 1)
    ORDER BY order_detail_id LIMIT {B.PAGE_SIZE}""",
)
def search_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page by the last id of the first: a page costs the same however deep it is."""
    hits = B._hits(spark, sf_dir).select("order_detail_id", "sku_name")
    last = [r[0] for r in search.page_after(hits, None, B.PAGE_SIZE).collect()][-1:]
    return search.page_after(hits, last[0] if last else None, B.PAGE_SIZE)


# A score in SQL, over rows (id, term, tf, length) of all words wanted and the figures of the whole collection.
_SCORE = f"""scored AS (
  SELECT id, floor(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * {relevance.K1 + 1}
    / (tf + {relevance.K1} * ({1 - relevance.B} + {relevance.B} * length / (total / docs)))) * 1e6 + 0.5) / 1e6 AS score, count(*) AS n
  FROM (SELECT *, count(*) OVER (PARTITION BY term) AS df FROM postings), figures GROUP BY id)"""


def _postings_sql(rows: str, wanted: tuple[str, ...]) -> str:
    return f"""worded AS (SELECT id, regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]+') AS w FROM ({rows})),
figures AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS DOUBLE) AS total FROM worded),
postings AS (SELECT id, term, count(*) AS tf, any_value(len(w)) AS length FROM (SELECT id, w, unnest(w) AS term FROM worded)
  WHERE term IN ({", ".join(f"'{w}'" for w in wanted)}) GROUP BY id, term), {_SCORE}"""


RANKED_YEARS = [str(y) for y in range(2021, 2024)]


@query(
    "q_search_ranked",
    f"""WITH {V.SALE_DETAIL}, {_postings_sql(f"SELECT order_detail_id AS id, sku_name AS body FROM sale_detail WHERE dt[1:4] IN ({', '.join(f"'{y}'" for y in RANKED_YEARS)})", ("red", "plate"))}
    SELECT id AS order_detail_id, score FROM scored ORDER BY score DESC, id LIMIT 500""",
)
def search_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best sales of some years for two words, either of which may be missing."""
    index = relevance.TextIndex(scratch_dir(spark, "ranked-"), "order_detail_id", T.StringType(), buckets=8)
    index.build(B._sales(spark, sf_dir).select("order_detail_id", "sku_name", "dt"), "sku_name", F.substring("dt", 1, 4))
    return relevance.ranked(index.search(spark, "Red plate", RANKED_YEARS, every=False), "order_detail_id", 500)


TEXT_WORDS = ("of", "that", "the")


@query(
    "q_search_texts",
    f"""WITH {_postings_sql("SELECT doc_id AS id, coalesce(text, '') AS body FROM documents", TEXT_WORDS)}
    SELECT id AS doc_id, score FROM scored WHERE n = {len(TEXT_WORDS)} ORDER BY score DESC, id LIMIT 100""",
)
def search_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of all lengths with each of three words, the most relevant first."""
    index = relevance.TextIndex(scratch_dir(spark, "texts-"), "doc_id", T.LongType())
    index.build(read_table(spark, sf_dir, "documents"), "text")
    return relevance.ranked(index.search(spark, " ".join(TEXT_WORDS)), "doc_id", 100)


@query(
    "q_rejected_records",
    f"""WITH {V.STARTUP_LOG} SELECT event_id, substr('{{"mid":"' || mid || '","ts":' || ts || '}}', 1, 12) AS value
    FROM startup_log WHERE event_id % 7 = 0""",
)
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that were cut off on the way, kept aside."""
    whole = records.json_value(V.startup_log(spark, sf_dir), "mid", "ts", keep=("event_id",))
    cut = F.when(F.col("event_id") % 7 == 0, F.substring("value", 1, 12)).otherwise(F.col("value"))
    return records.rejected_records(whole.withColumn("value", cut), schemas.STARTUP_LOG).select("event_id", "value")


# ---------------------------------------------------------------- streams


@query(
    "q_stream_rejects",
    """SELECT 'event' AS topic, CASE event_id % 7 WHEN 0 THEN 'broken' WHEN 1 THEN 'no time' ELSE 'ahead' END AS reason,
      CAST(event_id AS VARCHAR) AS id FROM events WHERE event_id % 7 < 3
    UNION ALL SELECT 'order_info', 'broken', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 7 = 0""",
)
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the alerts and the sale join pass over: records cut off, without a time, and a year ahead of their arrival."""
    root = scratch_dir(spark, "rejects-")
    n = F.col("event_id") % 7
    year = 366 * 86_400_000
    events = read_table(spark, sf_dir, "events").select(*V.event_columns(), "event_id")
    events = events.withColumn("timestamp", F.timestamp_millis("ts")).withColumn("pgid", F.col("event_id").cast("string"))
    events = events.withColumn("ts", F.when(n == 1, None).when(n == 2, F.col("ts") + year).otherwise(F.col("ts")))
    orders = V.order_info(spark, sf_dir).withColumn("timestamp", F.current_timestamp())

    def cut(df: DataFrame, name: str, number: str, first: list[str]) -> DataFrame:
        """Texts that begin with some fields; of every seventh record the closing brace is missing."""
        text = F.to_json(F.struct(*first, *[c for c in df.columns if c not in (*first, "timestamp", "event_id")]))
        short = F.when(F.col(number) % 7 == 0, F.left(text, F.length(text) - 1)).otherwise(text)
        records = df.select(short.alias("value"), F.col(number).cast("bigint").alias("offset"), "timestamp")
        records.repartition(FILES).write.json(f"{root}/topics/topic={name}")
        return topic_files(spark, name, f"{root}/topics")

    found = []
    for name, raw, unusable, field in (
        ("event", cut(events, "event", "event_id", ["pgid"]), jobs.unusable_events, "pgid"),
        ("order_info", cut(orders, "order_info", "id", ["id"]), jobs.unusable_orders, "id"),
    ):
        rejects = jobs.reject_table(f"{root}/rejects-{name}").create(spark)
        finish(jobs.reject_job(raw, unusable, rejects, f"{root}/checkpoint-{name}"))
        number = F.regexp_extract("value", f'"{field}":"([0-9]+)"', 1).alias("id")
        found.append(rejects.history(spark).select(F.lit(name).alias("topic"), "reason", number))
    return found[0].unionByName(found[1])


@query("q_stream_dau_detail", f"WITH {V.FIRST_STARTS} SELECT mid, log_date, log_hour, uid, ts FROM dau")
def stream_dau_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches; devices start again on a day that an earlier batch has begun."""
    root = scratch_dir(spark, "dau-")
    detail, seen = (t.create(spark) for t in dau_tables(root))
    starts = topic(spark, root, "startup", _thirds(_arrived(V.startup_log(spark, sf_dir), "event_id")))
    finish(jobs.dau_job(starts, detail, seen, f"{root}/checkpoint", jobs.reject_table(f"{root}/rejects")))
    return detail.history(spark).select("mid", "log_date", "log_hour", "uid", "ts")


@query("q_stream_dau_by_state", f"WITH {V.FIRST_STARTS} SELECT mid, log_date, log_hour, uid, ts FROM dau")
def stream_dau_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three batches; the devices seen lie in the state store."""
    root = scratch_dir(spark, "dau-by-state-")
    detail = dau_tables(root)[0].create(spark)
    starts = topic(spark, root, "startup", _thirds(_arrived(V.startup_log(spark, sf_dir), "event_id")))
    finish(jobs.dau_state_job(starts, detail, f"{root}/checkpoint"))
    return detail.history(spark).select("mid", "log_date", "log_hour", "uid", "ts")


def _gated_starts(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Three batches through a gate of a day; some starts of the first come with the last, too late."""
    first, second, third = _thirds(_arrived(V.startup_log(spark, sf_dir), "event_id"))
    late = F.expr(LATE_START.replace("event_id", "offset"))
    starts = topic(spark, root, "startup", [first.where(~late), second, third.unionByName(first.where(late))])
    finish(lateness.gate_job(starts, "startup", lateness.json_millis(), f"{root}/gate", f"{root}/gate-checkpoint", 86_400))
    return lateness.gated(spark, "startup", f"{root}/gate")


@query(
    "q_stream_dau_state",
    f"""WITH {V.STARTUP_LOG} SELECT DISTINCT mid, log_date FROM startup_log
    WHERE NOT ({LATE_START} AND {_FIRST_BATCH})""",
)
def stream_dau_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What passes the gate, each device and day once, by Spark's state store."""
    root = scratch_dir(spark, "dau-state-")
    fresh = jobs.first_starts_stream(_gated_starts(spark, sf_dir, root)).select("mid", "log_date")
    writer = fresh.writeStream.format("parquet").option("path", f"{root}/dau")
    finish(writer.option("checkpointLocation", f"{root}/checkpoint"))
    return spark.read.schema(fresh.schema).parquet(f"{root}/dau")


@query(
    "q_stream_late_rows",
    f"""WITH {V.STARTUP_LOG}, clock AS (
      SELECT max(ts) AS latest FROM startup_log WHERE ts < epoch_ms(TIMESTAMP '2024-01-20 12:00:00')
        AND NOT ({LATE_START} AND {_FIRST_BATCH}))
    SELECT 'late' AS reason, event_id AS "offset", ts AS event_ms FROM startup_log, clock
    WHERE {LATE_START} AND {_FIRST_BATCH} AND ts < latest - 86400000""",
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The starts that fell at the gate: more than a day before the latest one of all earlier batches."""
    root = scratch_dir(spark, "late-")
    _gated_starts(spark, sf_dir, root)
    return lateness.set_aside(spark, "startup", f"{root}/gate").select("reason", "offset", "event_ms")


@query(
    "q_stream_first_seen",
    f"""WITH {V.STARTUP_LOG} SELECT first_date, count(*) AS n FROM (
      SELECT mid, min(log_date) AS first_date FROM startup_log GROUP BY mid) GROUP BY first_date""",
)
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New devices by day out of cells; the last third of the starts comes first, so devices move to earlier days."""
    root = scratch_dir(spark, "first-")
    first_seen = KeyedTable(f"{root}/first", jobs.FIRST_SEEN, key="mid", buckets=8).create(spark)
    cells = KeyedTable(f"{root}/cells", jobs.DAY_CELLS, key="first_date").create(spark)
    first, second, third = _thirds(_arrived(V.startup_log(spark, sf_dir), "event_id"))
    starts = topic(spark, root, "startup", [third, first, second])
    finish(jobs.first_seen_job(starts, first_seen, cells, f"{root}/checkpoint"))
    return cell_counts(cells.history(spark), ["first_date"])


@query(
    "q_stream_blacklist",
    f"""WITH {V.STARTUP_LOG} SELECT mid, log_date, ts FROM startup_log
    WHERE uid NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)""",
)
def stream_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts of accounts that are not in debt: a stream joined with a table."""
    root = scratch_dir(spark, "admitted-")
    starts = topic(spark, root, "startup", _thirds(_arrived(V.startup_log(spark, sf_dir), "event_id")))
    listed = V.user_info(spark, sf_dir, F.expr(V.IN_DEBT)).select("id")
    fresh = jobs.admitted_starts(starts, listed).select("mid", "log_date", "ts")
    writer = fresh.writeStream.format("parquet").option("path", f"{root}/out")
    finish(writer.option("checkpointLocation", f"{root}/checkpoint"))
    return spark.read.schema(fresh.schema).parquet(f"{root}/out")


SALE_CELLS = T.StructType([*(T.StructField(n, _TYPED.get(n, T.StringType())) for n in jobs.SALE_CELL), T.StructField("n", T.LongType())])


@query(
    "q_sale_report_cells",
    f"""WITH {V.SALE_DETAIL}, hits AS (
      SELECT * REPLACE (CASE order_status WHEN 'F' THEN 'F' ELSE user_gender END AS user_gender) FROM sale_detail
      WHERE dt[1:7] = '{V.DAY[:7]}' AND list_contains(regexp_extract_all(lower(sku_name), '[a-z0-9_]+'), '{V.KEYWORD}')){B._RATIOS}
    SELECT * FROM figures""",
)
def sale_report_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month's sales put by line, the finished ones again under another gender; the report reads cells alone."""
    root = scratch_dir(spark, "cells-")
    index = sale_index(root, "dt").create(spark)
    cells = KeyedTable(f"{root}/cells", SALE_CELLS, key="sku_name", partition="dt").create(spark)
    raw_days = (V.raw_day(f"{V.DAY[:7]}-01"), V.raw_day(f"{V.DAY[:7]}-31"))
    sales = B._sales(spark, sf_dir, raw_days).withColumn("index_name", fields.index_name("sale_detail", V.AS_OF))
    sales = sales.withColumn("offset", F.lit(0).cast("bigint"))
    jobs.put_with_cells(index, cells, sales, 0)
    jobs.put_with_cells(index, cells, sales.where("order_status = 'F'").withColumn("user_gender", F.lit("F")), 1)
    return search.cell_figures(search.search(cells.history(spark), V.KEYWORD))


@query(
    "q_stream_gmv",
    f"""WITH {V.ORDER_INFO} SELECT create_date, create_hour, {V.EXACT_SUM} AS value FROM order_info
    GROUP BY ALL""",
)
def stream_gmv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order comes with another amount first, and changes in one of two later batches."""
    root = scratch_dir(spark, "gmv-stream-")
    table = order_table(root).create(spark)
    orders = V.order_info(spark, sf_dir).withColumn("offset", F.col("id").cast("bigint"))
    orders = orders.withColumn("timestamp", F.col("create_time").cast("timestamp"))
    draft = orders.withColumn("total_amount", F.col("total_amount") + 1)
    even = F.col("offset") % 2 == 0
    raw = topic(spark, root, "order_info", [draft, orders.where(even), orders.where(~even)])
    finish(jobs.gmv_job(raw, table, f"{root}/checkpoint", jobs.reject_table(f"{root}/rejects")))
    return dashboard.by_hour(table.read(spark), "order_amount")


@query(
    "q_stream_user_latest",
    f"WITH {V.USER_INFO} SELECT id, login_name, user_level, birthday, gender FROM user_info",
)
def stream_user_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user comes with another level first, and changes in one of two later batches."""
    root = scratch_dir(spark, "users-")
    table = user_table(root).create(spark)
    users = V.user_info(spark, sf_dir).withColumn("offset", F.col("id").cast("bigint"))
    users = users.withColumn("timestamp", F.lit(V.AS_OF).cast("timestamp"))
    even = F.col("offset") % 2 == 0
    batches = [users.withColumn("user_level", F.lit("NEW")), users.where(even), users.where(~even)]
    raw = topic(spark, root, "user_info", batches)
    finish(jobs.user_job(raw, table, f"{root}/checkpoint", jobs.reject_table(f"{root}/rejects")))
    return table.read(spark).drop("offset")


@query(
    "q_stream_alerts",
    f"""WITH {B._FAST} SELECT mid || '-' || (ts // 60000) AS doc_id, mid, uids, item_ids, events, ts FROM alerts
    QUALIFY row_number() OVER (PARTITION BY mid, ts // 60000 ORDER BY ts DESC) = 1""",
)
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of five minutes every five seconds, in three batches; a last record closes the windows at the end."""
    root = scratch_dir(spark, "alerts-")
    index = alert_index(root).create(spark)
    events = B.fast_events(spark, sf_dir).withColumn("offset", F.lit(0))
    last = events.agg(F.max("ts")).first()[0] or 0
    low = events.agg(F.min("ts")).first()[0] or 0
    times = [low + (last - low) * n // 3 for n in (1, 2)]
    at = F.col("ts")
    events = events.withColumn("timestamp", F.timestamp_millis("ts"))
    beat = spark.createDataFrame([("", last + 3_600_000)], "mid string, ts long").withColumn("offset", F.lit(1))
    beat = beat.withColumn("timestamp", F.timestamp_millis("ts"))
    batches = [events.where(at < times[0]), events.where((at >= times[0]) & (at < times[1])), events.where(at >= times[1]), beat]
    raw = topic(spark, root, "event", batches, source=read_table(spark, sf_dir, "events"))
    finish(jobs.alert_job(raw, index, f"{root}/checkpoint"))
    found = B._joined(index.read(spark), "uids", "item_ids", "events")
    return found.select("doc_id", "mid", "uids", "item_ids", "events", "ts")


# Orders arrive at a second of one day that their key decides, lines up to a minute before and three after them. Of
# these lines, those of the first batch are delivered with the last, later than any order waits.
LATE_LINE = "l_linenumber = 2 AND l_orderkey % 10 = 0 AND l_orderkey * 7919 % 86400 < 28800"


def _second_of_day(key: str, delay: Column | int = 0) -> Column:
    second = F.pmod(F.col(key) * 7919, F.lit(86_400)) + delay
    return F.lit(V.AS_OF).cast("timestamp") + F.make_dt_interval(secs=second)


@query(
    "q_stream_sale_detail",
    f"""WITH {V.SALE_DETAIL} SELECT order_detail_id, order_id, order_status, user_id, sku_id, user_gender, user_age,
    user_level, sku_price, sku_name, dt,
    'sale_detail-' || strftime(TIMESTAMP '{V.AS_OF}' + to_seconds(CAST(order_id AS BIGINT) * 7919 % 86400 + delay_s), '%Y-%m-%d')
      AS index_name
    FROM sale_detail WHERE delay_s BETWEEN -100 AND 100
      AND NOT (split_part(order_detail_id, '-', 2) = '2' AND CAST(order_id AS BIGINT) % 10 = 0
        AND CAST(order_id AS BIGINT) * 7919 % 86400 < 28800)""",
)
def stream_sale_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams of three batches joined within 100 seconds, then with a user table that another job has filled."""
    root = scratch_dir(spark, "sales-")
    index, users = sale_index(root).create(spark), user_table(root).create(spark)
    orders, lines = _sale_topics(spark, sf_dir, root, users)
    finish(jobs.sale_job(orders, lines, lambda s, wanted: users.read(s, only=wanted), index, f"{root}/checkpoint", as_of=V.AS_OF))
    return index.read(spark).drop("create_time", "offset")


def _sale_topics(spark: SparkSession, sf_dir: str, root: str, users: KeyedTable) -> tuple[DataFrame, DataFrame]:
    """Orders and lines in three batches each; the buyers are put into ``users``."""
    known = V.user_info(spark, sf_dir, ~F.expr(V.IN_DEBT)).withColumn("offset", F.lit(0).cast("bigint"))
    users.write(known, 0)
    orders = V.order_info(spark, sf_dir).withColumn("offset", F.col("id").cast("bigint"))
    orders = orders.withColumn("timestamp", _second_of_day("offset"))
    lines = table = read_table(spark, sf_dir, "lineitem")
    delay = (F.col("l_linenumber") - 1) * 40 - 60
    extra = (F.col("l_orderkey").alias("offset"), _second_of_day("l_orderkey", delay).alias("timestamp"), F.expr(LATE_LINE).alias("late"))
    lines = V.line_columns(lines, read_table(spark, sf_dir, "part"), extra).drop("delay_s")

    def by_time(df: DataFrame) -> list[DataFrame]:
        edges = [F.lit(f"{V.AS_OF} {hour}:00:00").cast("timestamp") for hour in ("08", "16")]
        at = F.col("timestamp")
        return [df.where(at < edges[0]), df.where((at >= edges[0]) & (at < edges[1])), df.where(at >= edges[1])]

    first, second, third = (b.drop("late") for b in by_time(lines.where("not late")))
    third = third.unionByName(lines.where("late").drop("late"))
    info = topic(spark, root, "order_info", by_time(orders), source=orders, packed=True)
    return info, topic(spark, root, "order_detail", [first, second, third], source=table, packed=True)


@query(
    "q_stream_sale_waiting",
    f"""WITH {V.SALE_DETAIL} SELECT order_detail_id, order_id, order_status, user_id, sku_id, user_gender, user_age,
    user_level, sku_price, sku_name, dt,
    'sale_detail-' || strftime(TIMESTAMP '{V.AS_OF}' + to_seconds(CAST(order_id AS BIGINT) * 7919 % 86400 + delay_s), '%Y-%m-%d')
      AS index_name
    FROM sale_detail WHERE delay_s BETWEEN -100 AND 100""",
)
def stream_sale_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same streams, what waits in tables: lines that come late find their orders, only hot orders are copied."""
    root = scratch_dir(spark, "sales-waiting-")
    index, users = sale_index(root).create(spark), user_table(root).create(spark)
    waiting_orders = jobs.waiting_table(f"{root}/orders", schemas.ORDER_INFO).create(spark)
    waiting_lines = jobs.waiting_table(f"{root}/lines", schemas.ORDER_DETAIL).create(spark)
    orders, lines = _sale_topics(spark, sf_dir, root, users)
    finish(
        jobs.sale_table_job(
            orders, lines, lambda s, wanted: users.read(s, only=wanted), index, waiting_orders, waiting_lines,
            f"{root}/checkpoint", as_of=V.AS_OF,
        )
    )
    return index.read(spark).drop("create_time", "offset")


@query(
    "q_stream_log_topics",
    f"""WITH {V.RAW_LOGS} SELECT CASE WHEN event_type = 'view' THEN 'startup' ELSE 'event' END AS topic,
    opened || ',"ts":{V.NOW_MS}}}' AS value, '{V.AS_OF}' AS log_date, 1 AS sent, 1 AS logged FROM raw_logs""",
)
def stream_log_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines stamped once, sent to their topic and kept in the day's log file; each exactly once in both."""
    root = scratch_dir(spark, "logs-")
    lines = V.log_columns(table_stream(spark, f"{sf_dir}/events.parquet"))
    rejects = jobs.reject_table(f"{root}/rejects")
    finish(jobs.log_job(lines, f"{root}/topics", f"{root}/logs", f"{root}/checkpoint", rejects, clock=lambda: V.NOW_MS))
    sent = spark.read.schema("value string, topic string").json(f"{root}/topics").withColumn("sent", F.lit(1))
    logged = spark.read.schema("value string, log_date string").text(f"{root}/logs").withColumn("logged", F.lit(1))
    both = sent.unionByName(logged, allowMissingColumns=True).groupBy("value")
    return both.agg(
        F.max("topic").alias("topic"), F.max("log_date").alias("log_date"),
        F.sum("sent").cast("int").alias("sent"), F.sum("logged").cast("int").alias("logged"),
    )


@query("q_stream_cdc_topics", f"WITH {V.ROUTED} SELECT topic, image AS value FROM routed")
def stream_cdc_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database log, kept as packed JSON files, as many as the tasks that write them, split into topics."""
    root = scratch_dir(spark, "cdc-")
    B._as_json(V.cdc_change(spark, sf_dir)).write.text(f"{root}/changes", compression="gzip")
    changes = parse_changes(spark.readStream.text(f"{root}/changes"))
    finish(outputs.to_topic_files(jobs.collect_changes(changes), f"{root}/topics", f"{root}/checkpoint"))
    return spark.read.schema("value string, topic string").json(f"{root}/topics")
