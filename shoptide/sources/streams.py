"""Topics as streams of records with their text in ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide import schemas

# What a topic record carries, in files as on the broker.
RECORD = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"


def topic_stream(
    spark: SparkSession, topic: str, servers: str, starting: str = "latest", **options: str
) -> DataFrame:
    """A topic on a Kafka cluster (needs the Kafka connector on the class path).

    Offsets are kept in the query's checkpoint, so a restart goes on where it stopped. Pass
    ``maxOffsetsPerTrigger`` to bound a batch, ``minPartitions`` to read a topic with more tasks than it has
    partitions.
    """
    reader = spark.readStream.format("kafka").options(**options)
    records = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
    return records.select(
        F.col("key").cast("string"), F.col("value").cast("string"), "topic", "partition", "offset", "timestamp"
    )


def topic_files(spark: SparkSession, topic: str, root: str, **options: str) -> DataFrame:
    """A topic kept as JSON files in ``<root>/topic=<name>``, the layout the file sink writes."""
    reader = spark.readStream.format("json").schema(RECORD).options(**options)
    return reader.load(f"{root}/topic={topic}").withColumn("topic", F.lit(topic))


def table_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A Parquet table as a stream of its files, be it a folder or a single file.

    A plain stream path must be a folder; a pattern, here one that matches just the path, may be either.
    """
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).options(**options).parquet(f"{path[:-1]}[{path[-1]}]")


def rejected_changes(raw: DataFrame, value: str = "value") -> DataFrame:
    """The records :func:`parse_changes` leaves out, to be kept aside."""
    change = F.from_json(F.col(value), schemas.CHANGE)
    return raw.where(change.getField("entry_type").isNull())


def parse_changes(raw: DataFrame, value: str = "value") -> DataFrame:
    """Row changes of a database log: entry type, table, operation and the row afterwards as name-value pairs."""
    change = F.from_json(F.col(value), schemas.CHANGE)
    return raw.select(change.alias("change")).select("change.*").where(F.col("entry_type").isNotNull())
