"""Documents put into a store that answers for each of them; here the store is a folder of notes."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shoptide.sinks import items
from shoptide.sources.streams import topic_files
from tests.conftest import rows


def store(folder: Path):
    """Refuses ids that end in 3 always, ids that end in 5 the first time; notes every call."""
    folder.mkdir()
    path = str(folder)

    def send(some):
        again = {i for note in Path(path).glob("*.json") for i, _ in json.loads(note.read_text())}
        (Path(path) / f"{uuid.uuid4()}.json").write_text(json.dumps(some))
        late = lambda i: "busy" if i.endswith("5") and i not in again else None
        return ["wrong" if i.endswith("3") else late(i) for i, _ in some]

    return send


def calls(folder: Path):
    return [json.loads(note.read_text()) for note in folder.glob("*.json")]


def test_every_item_has_a_result(spark, tmp_path):
    send = store(tmp_path / "store")
    df = spark.range(100).select(F.col("id").alias("doc"), F.lit("x").alias("id")).repartition(3)
    assert rows(items.put_items(df, "doc", send, at_a_time=7), "id", "reason") == sorted((str(i), "wrong") for i in range(3, 100, 10))
    sent = calls(tmp_path / "store")
    assert max(map(len, sent)) <= 7
    count = {}
    for i, value in [x for some in sent for x in some]:
        assert json.loads(value) == {"doc": int(i), "id": "x"}
        count[i] = count.get(i, 0) + 1
    assert all(n == (3 if i[-1] == "3" else 2 if i[-1] == "5" else 1) for i, n in count.items()) and len(count) == 100


def test_odd_items(spark, tmp_path):
    send = store(tmp_path / "store")
    none = spark.createDataFrame([(None, "a"), ("1", None), ("1", None)], "id string, v string")
    assert rows(items.put_items(none, "id", send)) == [(None, '{"v":"a"}', "no id")]
    assert sorted(x for some in calls(tmp_path / "store") for x in some) == [["1", '{"id":"1"}']] * 2
    assert items.put_items(none.limit(0), "id", send).count() == 0
    with pytest.raises(Exception, match="0 answers for"):
        items.put_items(none, "id", lambda some: []).collect()


def test_refused_items_do_not_hold_up_a_stream(spark, topics, tmp_path):
    send = store(tmp_path / "store")
    refused = items.refused_table(str(tmp_path / "refused")).create(spark)
    topics.send("t", [{"n": i} for i in range(6)])
    topics.send("t", [{"n": i} for i in range(6, 14)])
    raw = topic_files(spark, "t", topics.folder, maxFilesPerTrigger="1").select("offset", "value")
    writer = items.to_items(raw, "offset", send, refused, str(tmp_path / "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert rows(refused.read(spark), "id", "reason") == [("1003", "wrong"), ("3", "wrong")]
    assert len({i for some in calls(tmp_path / "store") for i, _ in some}) == 14
