"""Shards of near-equal bytes by best-fit-decreasing bin packing.

Groups of equal texts are indivisible. Groups enter the bin with the least remaining capacity that still holds them, the
largest first; bins are kept in a balanced search tree by what they have left. ``pack`` fills bins of a given capacity,
opening as few as it can; ``shards`` looks for the smallest capacity with which the groups go into the given number.

Packing all groups one after another would pass the whole corpus through one task. So only groups of at least
``1 / grain`` of all bytes, at most ``grain`` of them, are packed one by one; the others travel in ``grain`` bundles by the
hash of their text, all copies of a text in the same bundle. At most ``2 * grain + pieces`` items are packed, whatever the
input, and the table from items to shards is as bounded, so joining it needs no shuffle of the documents. A group
above half a shard cannot be placed whole if shards are to be near equal: it is cut into pieces by the hash of the id.

Slots number the rows of a shard without gaps: rows are counted in ``BUCKETS`` buckets of a shard by hash, buckets start
where the ones before end, and rows are numbered within their bucket.

Defined results. The size of a text is its UTF-8 bytes plus 1; a null text has size 1 and no checksum, and all null texts
are one group, empty texts another. Ties go by hash, then id, so the result is the same on every run; repeated
rows are rows of their own with slots of their own. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from random import Random

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide.llm.common import stored

BUCKETS = 64


class Tree:
    """A treap of (remaining capacity, bin): a binary search tree kept balanced by random priorities of a fixed seed."""

    def __init__(self):
        self.root = None
        self.random = Random(1)

    def _split(self, node, key):
        """Nodes below ``key``, and the others. A node is [key, priority, left, right]."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], rest = self._split(node[3], key)
            return node, rest
        rest, node[2] = self._split(node[2], key)
        return rest, node

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._join(a[3], b)
            return a
        b[2] = self._join(a, b[2])
        return b

    def add(self, key: tuple[int, int]) -> None:
        low, high = self._split(self.root, key)
        self.root = self._join(self._join(low, [key, self.random.random(), None, None]), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the smallest key with at least ``size`` left."""
        best, node = None, self.root
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            low, high = self._split(self.root, best)
            one, high = self._split(high, (best[0], best[1] + 1))
            self.root = self._join(low, high)
        return best


def pack(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """A bin for each size, sizes in descending order. None if more than ``most`` bins are needed.

    An item above the capacity gets a bin of its own.
    """
    tree, bins, out = Tree(), 0, []
    for size in sizes:
        found = tree.take_tightest(size)
        if found is None:
            if most is not None and bins == most:
                return None
            found = (max(capacity, size), bins)
            bins += 1
        left, which = found
        tree.add((left - size, which))
        out.append(which)
    return out


def fit(sizes: list[int], bins: int) -> list[int]:
    """A bin for each size, with a capacity as small as a search by halves finds to suffice."""
    low = max(-(-sum(sizes) // bins), max(sizes, default=1))
    found, high = pack(sizes, low, bins), low
    while found is None:  # twice the even share always suffices
        low, high = high + 1, high + max(1, (high - low + 1) * 2, high // 256)
        found = pack(sizes, high, bins)
    for _ in range(8):
        if low >= high:
            break
        middle = (low + high) // 2
        if (better := pack(sizes, middle, bins)) is not None:
            found, high = better, middle
        else:
            low = middle + 1
    return found


def placed(items: DataFrame, bins: int) -> DataFrame:
    """(unit, shard) of a bounded table (unit, bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(-b, u) for batch in batches for u, b in zip(batch.column("unit").to_pylist(), batch.column("bytes").to_pylist())]
        rows.sort()
        shards = fit([-b for b, _ in rows], bins)
        yield pa.RecordBatch.from_arrays([pa.array([u for _, u in rows], pa.string()), pa.array(shards, pa.int32())], names=["unit", "shard"])

    return items.repartition(1).mapInArrow(run, "unit string, shard int")


def shards(docs: DataFrame, count: int = 16, grain: int = 1 << 14) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs`` (doc_id, text)."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.col("text").cast("binary")).alias("text_crc32")
    # null and empty texts hash alike, so nulls are marked
    group = F.xxhash64("text", F.col("text").isNull())
    rows = stored(docs.select("doc_id", size.alias("size"), crc, group.alias("group")), "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    heavy = rows.groupBy("group").agg(F.sum("size").alias("whole")).where(F.col("whole") * grain >= total)
    # at most ``grain`` groups have that share of all bytes
    half = max(1, total // (2 * count))
    cuts = F.when(F.col("whole") > half, F.ceil(F.col("whole") / F.lit(max(1, total // (32 * count))))).otherwise(1)
    heavy = stored(heavy.select("group", cuts.cast("long").alias("cuts")), "heavy")
    piece = F.pmod(F.xxhash64("doc_id", "group"), F.col("cuts"))
    alone = F.concat_ws(":", F.lit("g"), F.col("group").cast("string"), piece.cast("string"))
    bundle = F.concat(F.lit("b"), F.pmod("group", F.lit(grain)).cast("string"))
    rows = rows.join(F.broadcast(heavy), "group", "left").withColumn("unit", F.when(F.col("cuts").isNull(), bundle).otherwise(alone))
    items = stored(rows.groupBy("unit").agg(F.sum("size").alias("bytes")), "items")
    where = stored(placed(items, count), "placed")
    rows = rows.join(F.broadcast(where), "unit").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "group"), F.lit(BUCKETS)))
    rows = stored(rows.select("doc_id", "size", "text_crc32", "group", "shard", "bucket"), "dealt")
    return numbered(rows)


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``slot``, gapless from 0 in each shard, and drops the helper columns. Buckets are at most shards x BUCKETS."""
    sizes = rows.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "group"))
    slots: Column = (F.col("start") + F.col("within") - 1).cast("long").alias("slot")
    placed_ = rows.withColumn("within", within).join(F.broadcast(starts), ["shard", "bucket"])
    return placed_.select("doc_id", "size", "text_crc32", "shard", slots)
