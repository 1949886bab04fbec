"""Session settings: what results depend on, and what large runs need."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Results depend on these, so they are set on any session the queries run in.
SEMANTIC_CONF = {"spark.sql.session.timeZone": "UTC"}

# For sessions built here. Shuffle partition counts stay with the cluster's own configuration; AQE merges
# small partitions and splits skewed ones, so the count only has to be high enough.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting state rows costs a read for every write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword arguments use ``__`` for the dots of a key."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SEMANTIC_CONF, **RUNTIME_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_semantics(spark: SparkSession) -> SparkSession:
    """Set what results depend on, leaving the rest of a foreign session alone."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder, or a local one in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/{prefix}{os.urandom(6).hex()}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix=prefix)


_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def removing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Files a query shuffles go when it ends. Otherwise they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_REMOVE_SHUFFLES)
        else:
            spark.conf.set(_REMOVE_SHUFFLES, before)
