"""Relational tables and brokers need a server, so their options are looked at, and nothing is connected to."""

from __future__ import annotations

import pytest

from shoptide.session import scratch_dir
from shoptide.sinks import outputs
from shoptide.sinks.outputs import jdbc_write_options
from shoptide.sources.streams import topic_files, topic_stream
from shoptide.sources.tables import jdbc_options


def test_relational_reads_can_be_split():
    plain = jdbc_options("jdbc:x", "user_info", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "user_info", "fetchsize": "10000", "user": "u"}
    split = jdbc_options("jdbc:x", "user_info", split_on="id", bounds=(0, 100), connections=4)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "4" and split["upperBound"] == "100"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "user_info", split_on="id")


def test_relational_writes_are_batched():
    options = jdbc_write_options("jdbc:x", "t", batch_size=50, connections=2)
    assert options == {"url": "jdbc:x", "dbtable": "t", "batchsize": "50", "numPartitions": "2"}


def test_broker_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        topic_stream(spark, "startup", "nowhere:9092")


class Cluster:
    """What a session on a cluster answers."""

    master = "yarn"

    def __init__(self, **conf):
        self.settings = conf
        self.conf = self.sparkContext = self

    def getConf(self):
        return self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_folder_is_the_clusters_shared_one():
    assert scratch_dir(Cluster(**{"spark.checkpoint.dir": "s3a://shared/cp/"}), "x-").startswith("s3a://shared/cp/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Cluster(), "x-")


def test_relational_batches_are_appended_or_staged(spark, topics, root, monkeypatch):
    """No database here: the write is replaced by a note of what it was asked for."""
    asked = []
    monkeypatch.setattr(outputs, "write_jdbc", lambda df, url, table, mode="append", **o: asked.append((table, mode, df.count(), o)))
    topics.send("t", [{"a": 1}])
    raw = topic_files(spark, "t", topics.folder)
    for n, options in enumerate(({}, {"staging": "t_new", "user": "u"})):
        outputs.to_jdbc(raw, "jdbc:x", "t", f"{root}/c{n}", **options).trigger(availableNow=True).start().awaitTermination()
    assert asked == [("t", "append", 1, {}), ("t_new_0", "overwrite", 1, {"user": "u"})]
