"""Late records, told by a clock of our own and kept aside.

Spark's stateful operators judge lateness, by default, by the watermark of the batch before, and drop late rows unseen. A
gate in front of a stream decides instead, by one exact law: a record is late if its time is more than ``late_s`` seconds
before the latest time of all earlier batches. What passes is written to a topic of its own, from which the stateful
stream reads; its own watermark of the same bound never runs ahead of the gate's clock, so nothing more falls there.

Records go through once: one parse, one write, which sorts them into the topics ``<topic>`` (in time), ``<topic>_late``,
``<topic>_ahead`` (a device's clock ahead of the record's arrival, which would make all others late) and
``<topic>_undated`` (no time, or broken text). A batch that is run again replaces what it wrote.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from shoptide import constants as C
from shoptide.sinks import outputs
from shoptide.sources.streams import RECORD

IN_TIME, LATE, AHEAD, UNDATED = "", "_late", "_ahead", "_undated"
GATED = RECORD + ", event_ms bigint, batch bigint"


@dataclass(frozen=True)
class Clock:
    """The latest time of all batches so far, or another row of figures, in a folder for each of the last two batches."""

    path: str
    schema: str = "latest bigint"

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def before(self, spark: SparkSession, batch_id: int) -> int | None:
        """The latest time of the batches before this one, None if there was none."""
        row = self.row_before(spark, batch_id)
        return None if row is None else row[0]

    def row_before(self, spark: SparkSession, batch_id: int) -> Row | None:
        """The row of the batch before this one, None before the first batch."""
        return None if batch_id == 0 else spark.read.schema(self.schema).parquet(self._folder(batch_id - 1)).first()

    def put(self, spark: SparkSession, batch_id: int, latest: int | None) -> None:
        self.put_row(spark, batch_id, (latest,))

    def put_row(self, spark: SparkSession, batch_id: int, row: tuple) -> None:
        one = spark.createDataFrame([row], self.schema).coalesce(1)
        one.write.mode("overwrite").parquet(self._folder(batch_id))
        old = spark._jvm.org.apache.hadoop.fs.Path(self._folder(batch_id - 2))
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def verdict(event_ms: str, arrival: str, latest: int | None, late_s: int, ahead_s: int) -> Column:
    """Which of the topics a record belongs to, as the ending of its name."""
    time = F.col(event_ms)
    found = F.when(time.isNull(), UNDATED).when(time > F.unix_millis(arrival) + ahead_s * 1000, AHEAD)
    if latest is not None:
        found = found.when(time < latest - late_s * 1000, LATE)
    return found.otherwise(IN_TIME)


def gate_job(
    raw: DataFrame,
    topic: str,
    event_ms: Column,
    root: str,
    checkpoint: str,
    late_s: int,
    ahead_s: int = C.CLOCK_AHEAD_S,
) -> DataStreamWriter:
    """Records of ``raw`` (value, offset, timestamp) sorted into topics below ``<root>/topics``.

    ``event_ms`` is the record's time in milliseconds, null where it has none. Read the records in time by
    :func:`gated`, all others, with the reason, by :func:`set_aside`.
    """
    clock = Clock(f"{root}/clock")

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = clock.before(spark, batch_id)
        rows = batch.withColumn("event_ms", event_ms)
        ending = verdict("event_ms", "timestamp", latest, late_s, ahead_s)
        rows = rows.withColumn("topic", F.concat(F.lit(topic), ending))
        seen = Observation(f"{topic}-{batch_id}")
        in_time = F.max(F.when(F.col("topic") == topic, F.col("event_ms"))).alias("latest")
        outputs.put_topic_files(rows.observe(seen, in_time, F.count(F.lit(1)).alias("rows")), f"{root}/topics", batch_id)
        now = None if batch.isEmpty() else seen.get["latest"]  # without rows Spark may leave the counting out
        clock.put(spark, batch_id, max([x for x in (latest, now) if x is not None], default=None))

    return raw.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def gated(spark: SparkSession, topic: str, root: str, **options: str) -> DataFrame:
    """The records in time, as a stream."""
    files = spark.readStream.format("json").schema(GATED).options(**options).load(f"{root}/topics/topic={topic}")
    return files.withColumn("topic", F.lit(topic))


def set_aside(spark: SparkSession, topic: str, root: str) -> DataFrame:
    """``reason`` (late, ahead, undated), value, offset, timestamp, event_ms and batch of the records that did not pass."""
    rows = spark.read.schema(GATED).json(f"{root}/topics").where(F.col("topic").isin([topic + e for e in (LATE, AHEAD, UNDATED)]))
    reason = F.substring("topic", len(topic) + 2, 100).alias("reason")
    return rows.select(reason, "value", "offset", "timestamp", "event_ms", "batch")


def json_millis(field: str = "ts") -> Column:
    """The time a JSON record carries, in milliseconds."""
    return F.get_json_object("value", f"$.{field}").try_cast("bigint")
