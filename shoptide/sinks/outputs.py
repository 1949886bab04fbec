"""Topics, relational tables and daily log files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def to_kafka(records: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """Send ``value`` (and ``key``, if there is one) to the topic each row names."""
    columns = [c for c in ("topic", "key", "value") if c in records.columns]
    writer = records.select(*columns).writeStream.format("kafka")
    return writer.option("kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)


def to_topic_files(records: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """The same as JSON files in one folder per topic."""
    writer = records.writeStream.format("json").partitionBy("topic").option("path", root)
    return writer.option("checkpointLocation", checkpoint)


def to_daily_logs(lines: DataFrame, root: str, checkpoint: str, day: str = "log_date") -> DataStreamWriter:
    """Log lines as text files in one folder per day."""
    writer = lines.select("value", day).writeStream.format("text").partitionBy(day).option("path", root)
    return writer.option("checkpointLocation", checkpoint)


def put_topic_files(records: DataFrame, root: str, batch_id: int) -> None:
    """A batch in one folder per topic and batch; run again, it replaces itself."""
    rows = records.withColumn("batch", F.lit(batch_id))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("topic", "batch").json(root)


def put_daily_logs(lines: DataFrame, root: str, batch_id: int, day: str = "log_date") -> None:
    """A batch of log lines as text in one folder per day and batch; run again, it replaces itself."""
    rows = lines.select("value", day).withColumn("batch", F.lit(batch_id))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day, "batch").text(root)


def jdbc_write_options(
    url: str, table: str, *, batch_size: int = 1000, connections: int = 8, **properties: str
) -> dict[str, str]:
    """Options of a relational write: rows per statement batch, and a bound on concurrent connections."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        **properties,
    }


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    """Insert rows in batches; every task writes in one transaction."""
    df.write.format("jdbc").mode(mode).options(**jdbc_write_options(url, table, **options)).save()


def to_jdbc(
    df: DataFrame, url: str, table: str, checkpoint: str, staging: str | None = None, **options
) -> DataStreamWriter:
    """Insert every micro-batch, with its batch id.

    A replayed batch inserts again; its id tells. With ``staging`` a batch fills a table of its own instead,
    ``<staging>_<batch id>``, which a replay fills anew: the database updates ``table`` from it by key, in one
    transaction with dropping it, whenever it comes to it.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if staging is None:
            write_jdbc(rows, url, table, **options)
        else:
            write_jdbc(rows, url, f"{staging}_{batch_id}", mode="overwrite", **options)

    return df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
