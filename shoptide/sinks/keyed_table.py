"""Put-by-key tables on plain Parquet: batches are appended, the current row of a key is picked on reading.

A batch is a partition of its own, ``batch_id=<n>``, below the day (or bucket) its rows belong to, and is written by
dynamic partition overwrite. So writing costs what the batch costs, and a batch that is run again replaces itself. Reads
name the partitions they want, which Spark prunes to. A table belongs to one query and its checkpoint, since batches are
told apart by the query's batch ids. :meth:`KeyedTable.rewritten` puts the current rows into a new table, for readers to
move to once there are many batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.operators.keyed import latest_by_key

BATCH, BUCKET = "batch_id", "bucket"
BEFORE_ALL = -1


@dataclass(frozen=True)
class KeyedTable:
    """``key`` identifies a row within its ``partition``; ``order`` ranks rows of a key within a batch.

    ``order`` has to be unique for a key (an offset). With ``buckets`` the table is partitioned by the hash of the key,
    so that looking up a few keys reads a few partitions.
    """

    path: str
    schema: T.StructType
    key: str
    partition: str | None = None
    order: tuple[str, ...] = ()
    buckets: int = 0

    @property
    def _parts(self) -> list[str]:
        return [BUCKET] if self.buckets else [self.partition] if self.partition else []

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def create(self, spark: SparkSession) -> KeyedTable:
        """Make the table's folder, so that it can be read before the first batch."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
        return self

    def write(self, batch: DataFrame, batch_id: int, spread: bool = True) -> None:
        """Put a batch. Rows are spread evenly over files of a sensible size, also when one day has most of them.

        A batch of one day needs no shuffle for that: without ``spread`` each task writes the rows it has.
        """
        rows = batch.select(*self.schema.names).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        rows = rows.withColumn(BUCKET, self._bucket()) if self.buckets else rows
        rows = rows.hint("rebalance", *self._parts) if self._parts and spread else rows
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        writer.partitionBy(*self._parts, BATCH).parquet(self.path)

    def forget(self, spark: SparkSession, below: str) -> None:
        """Delete the partitions with a value below the given one, such as hours nobody will ask for."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in files.listStatus(path):
            name, _, value = found.getPath().getName().partition("=")
            if name == self.partition and value < below:
                files.delete(found.getPath(), True)

    def rewritten(self, spark: SparkSession, path: str) -> KeyedTable:
        """A new table with the current rows, older than any batch to come."""
        new = replace(self, path=path).create(spark)
        new.write(self.read(spark), BEFORE_ALL)
        return new

    def history(self, spark: SparkSession, parts: Sequence | None = None, before_batch: int | None = None) -> DataFrame:
        """All rows put; ``parts`` are the values of the partition column to look into."""
        extra = [T.StructField(BATCH, T.LongType()), *[T.StructField(BUCKET, T.IntegerType())] * bool(self.buckets)]
        rows = spark.read.schema(T.StructType([*self.schema.fields, *extra])).parquet(self.path)
        if parts is not None and self._parts:
            part = F.col(self._parts[0])
            wanted = part.isin([p for p in parts if p is not None])
            rows = rows.where(wanted | part.isNull() if None in parts else wanted)
        return rows if before_batch is None else rows.where(F.col(BATCH) < before_batch)

    def read(
        self, spark: SparkSession, parts: Sequence | None = None, only: DataFrame | None = None, fixed: Column | None = None
    ) -> DataFrame:
        """The current row of every key; rows without a key all stay.

        ``fixed`` is a condition on columns that never change for a key (its day), which so can reach the scan.
        ``only`` is a table of wanted keys: of a table in buckets just theirs are read, and other keys are dropped
        before rows are compared, by a semi join that Spark broadcasts while the wanted keys are few.
        """
        wanted = None if only is None else only.select(self.key).distinct()
        if wanted is not None and self.buckets and parts is None:
            parts = [r[0] for r in wanted.select(self._bucket()).distinct().collect()]  # at most ``buckets``
        rows = self.history(spark, parts)
        rows = rows if fixed is None else rows.where(fixed)
        rows = rows if wanted is None else rows.join(wanted, self.key, "left_semi")
        alone = F.when(F.col(self.key).isNull(), F.monotonically_increasing_id())
        latest = latest_by_key(rows.withColumn("alone", alone), [self.key, "alone", *self._parts], (BATCH, *self.order))
        return latest.select(*self.schema.names)
