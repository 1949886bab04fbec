"""Rows put as documents into a store that answers for each of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from shoptide.sinks.keyed_table import KeyedTable

Send = Callable[[list[tuple[str, str]]], list[str | None]]

REFUSED = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "value", "reason")])


def refused_table(path: str) -> KeyedTable:
    """What a store has refused, by document id."""
    return KeyedTable(path, REFUSED, key="id")


def put_items(rows: DataFrame, key: str, send: Send, at_a_time: int = 500, attempts: int = 3) -> DataFrame:
    """Sends every row as JSON under its key; returns ``id``, ``value`` and ``reason`` of the rows that are not in the store.

    ``send`` takes some (id, JSON text) and answers for each of them, in order: None, or why it was refused. What was
    refused is sent again, alone, up to ``attempts`` times in all; an error that ``send`` raises fails the task, which
    Spark runs again. An id put twice has to replace itself, therefore rows without an id are not sent but refused.

    Rows are sent when the result is read, and again whenever it is: write it once (:func:`to_items`).
    """
    items = rows.select(F.col(key).cast("string").alias("id"), F.to_json(F.struct(*[rows[c] for c in rows.columns])).alias("value"))

    def refused(some: list[tuple[str, str]]) -> list[tuple[str, str, str]]:
        out = [(None, value, "no id") for id_, value in some if id_ is None]
        waiting = [item for item in some if item[0] is not None]
        for left in reversed(range(attempts)):
            if not waiting:
                break
            answers = send(waiting)
            if len(answers) != len(waiting):
                raise ValueError(f"{len(answers)} answers for {len(waiting)} items")
            if not left:
                out += [(*item, reason) for item, reason in zip(waiting, answers) if reason is not None]
            waiting = [item for item, reason in zip(waiting, answers) if reason is not None]
        return out

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, at_a_time):
                part = batch.slice(at, at_a_time)
                out = refused(list(zip(part.column(0).to_pylist(), part.column(1).to_pylist())))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=REFUSED.names)

    return items.mapInArrow(put, REFUSED)


def to_items(stream: DataFrame, key: str, send: Send, refused: KeyedTable, checkpoint: str, **options: int) -> DataStreamWriter:
    """Every micro-batch put once; what the store refuses goes to a table, and does not hold up the rest."""

    def put(batch: DataFrame, batch_id: int) -> None:
        refused.write(put_items(batch, key, send, **options), batch_id)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
