"""Exact top-k inner products over a bit-sliced index.

Index. Vectors are dealt into blocks of about ``block`` rows. Component d of a block is stored as bit slices: bitmap j
holds bit j of (value - the block's minimum), a bit per row. A component whose range needs more than ``bits`` bits keeps
its upper ``bits``. Blocks are files of the shared folder, with the exact values beside the slices, and are
memory-mapped; every vector is indexed.

Search. For a query the weighted components are added up by bitmap arithmetic, all rows of the block at once: for each bit
of a component's weight the component's slices are added, shifted, to the sum's slices (a ripple-carry adder on words of
64 rows). A component with a negative weight enters by its complement. The k-th largest sum is then found slice by slice
from the most significant one down. Rows whose sum is so close to it that dropped bits, or equal scores, could decide
are the boundary: they are resolved by the exact inner product, ties to the smaller id.

Spread. Queries are taken in chunks of ``chunk``; every pair of a block and a chunk is a row of its own, with the chunk's
vectors and the block's place. Work is queries times rows, as asked for; what is sent is the queries once for each block, and
k rows back for each query and block.

Defined results. A component is floor(scale * x), x as double, held within +-2^24. Null vectors, null or non-finite
components, vectors of another length than most (ties: the longer), and null ids take no part. Equal vectors are
all ranked, by id; a query is never its own answer, a repeated row with its id neither. Fewer than k others: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide.llm import arrays
from shoptide.llm.common import stored
from shoptide.session import scratch_dir

# Beyond this a score would not be a long any more, whatever the other vector.
LIMIT = 1 << 61
RESULT = "query_id long, vec_id long, score long"


def quantised(column: pa.Array, scale: float) -> np.ndarray:
    values = np.array(column.to_pylist(), np.float64)
    return np.clip(np.floor(scale * values), -LIMIT, LIMIT).astype(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vector"))
    usual = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (usual["n"] if usual else 0))


class Block:
    """Bit slices of a block of vectors."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, bits: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        self.low = self.values.min(axis=0)
        above = self.values - self.low
        width = np.array([int(x).bit_length() for x in above.max(axis=0)])
        self.shift = np.maximum(width - bits, 0)
        self.width = np.minimum(width, bits)
        upper = above >> self.shift
        words = ceil(len(ids) / 64)
        slices = []
        for d, w in enumerate(self.width):
            for j in range(w):
                packed = np.packbits((upper[:, d] >> j) & 1 == 1, bitorder="little")
                slices.append(np.pad(packed, (0, words * 8 - len(packed))).view(np.uint64))
        self.slices = np.array(slices, np.uint64).reshape(-1, words)
        self.first = np.cumsum(self.width) - self.width

    PARTS = ("ids", "values", "low", "shift", "width", "slices", "first")

    def save(self, name: str) -> None:
        for part in self.PARTS:
            value = getattr(self, part)
            narrow = part == "values" and np.abs(value).max(initial=0) < 1 << 31
            arrays.save(f"{name}-{part}.npy", value.astype(np.int32) if narrow else value)

    @classmethod
    def load(cls, name: str) -> Block:
        block = object.__new__(cls)
        for part in cls.PARTS:
            setattr(block, part, arrays.load(f"{name}-{part}.npy"))
        return block

    def sums(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of each row's sum of |weight| * upper bits (complemented for negative weights), and what it may lack."""
        total: list[np.ndarray] = []
        lacking = 0
        for d in np.flatnonzero(weights):
            weight, width, shift = int(abs(weights[d])), int(self.width[d]), int(self.shift[d])
            lacking += weight * ((1 << shift) - 1)
            if not width:  # one value in the whole block
                continue
            mine = [self.slices[self.first[d] + j] for j in range(width)]
            if weights[d] < 0:
                mine = [~s for s in mine]
            for bit in range(weight.bit_length()):
                if weight >> bit & 1:
                    add(total, mine, bit + shift)
        return total, lacking

    def top(self, query: int, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows; rows with the query's own id are not among them."""
        rows = len(self.ids)
        valid = np.full(self.slices.shape[1] if len(self.slices) else ceil(rows / 64), ~np.uint64(0))
        if rows % 64:
            valid[-1] = np.uint64((1 << rows % 64) - 1)
        for at in range(np.searchsorted(self.ids, query), np.searchsorted(self.ids, query, side="right")):
            valid[at // 64] &= ~np.uint64(1 << at % 64)
        total, lacking = self.sums(weights)
        chosen = at_least(total, valid, kth(total, valid, k) - lacking)
        at = np.flatnonzero(np.unpackbits(chosen.view(np.uint8), bitorder="little")[:rows])
        scores = self.values[at].astype(np.int64) @ weights
        best = np.lexsort((self.ids[at], -scores))[:k]
        return self.ids[at][best], scores[best]


def add(total: list[np.ndarray], slices: list[np.ndarray], shift: int) -> None:
    """total += slices << shift, in place; slices of 64 rows a word."""
    while len(total) < shift:
        total.append(np.zeros_like(slices[0]))
    carry = None
    j = shift
    for s in slices:
        if j == len(total):
            total.append(s.copy() if carry is None else s ^ carry)
            carry = None if carry is None else s & carry
        else:
            t = total[j]
            half = t ^ s
            if carry is None:
                total[j], carry = half, t & s
            else:
                total[j], carry = half ^ carry, (t & s) | (half & carry)
        j += 1
    while carry is not None and carry.any():
        if j == len(total):
            total.append(carry)
            return
        total[j], carry = total[j] ^ carry, total[j] & carry
        j += 1


def kth(total: list[np.ndarray], valid: np.ndarray, k: int) -> int:
    """The k-th largest sum of the valid rows, 0 if there are fewer: from the most significant slice down."""
    still, ahead, value = valid, 0, 0
    for j in range(len(total) - 1, -1, -1):
        ones = still & total[j]
        count = int(np.bitwise_count(ones).sum())
        if ahead + count >= k:
            still, value = ones, value | 1 << j
        else:
            ahead += count
            still = still & ~total[j]
    return value


def at_least(total: list[np.ndarray], valid: np.ndarray, least: int) -> np.ndarray:
    """The valid rows whose sum is ``least`` or more."""
    if least <= 0:
        return valid
    if least.bit_length() > len(total):
        return np.zeros_like(valid)
    more, same = np.zeros_like(valid), valid
    for j in range(len(total) - 1, -1, -1):
        if least >> j & 1:
            same = same & total[j]
        else:
            more |= same & total[j]
            same = same & ~total[j]
    return more | same


def index(rows: DataFrame, scale: float, block: int, bits: int) -> DataFrame:
    """Writes the blocks; a table of their names."""
    folder = scratch_dir(rows.sparkSession, "bits-")
    count = rows.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, values, part = [], [], 0

        def flush() -> pa.RecordBatch:
            every = np.concatenate(ids)
            name = f"{folder}/{int(every.min())}-{int(every.max())}-{len(every)}-{np.random.default_rng().integers(1 << 62)}"
            Block(every, np.concatenate(values), bits).save(name)
            return pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part_ = batch.slice(start, block)
                ids.append(part_.column("vec_id").to_numpy())
                values.append(quantised(part_.column("vector"), scale))
                part += part_.num_rows
                if part >= block:
                    yield flush()
                    ids, values, part = [], [], 0
        if ids:
            yield flush()

    # as many blocks as it takes, of equal size
    return stored(rows.repartition(max(1, ceil(count / block))).mapInArrow(run, "name string"), "blocks")


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, block: int = 1 << 16, chunk: int = 64, bits: int = 12) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row of ``vectors`` (vec_id, embedding) that is a query."""
    rows = usable(vectors)
    blocks = index(rows, scale, block, bits)
    asked = rows.where(is_query).distinct()
    chunks = max(1, ceil(asked.count() / chunk))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)))
    asked = asked.groupBy("chunk").agg(F.collect_list(F.struct("vec_id", "vector")).alias("queries"))
    pairs = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))).join(asked, "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                index_ = Block.load(batch.column("name")[row].as_py())
                queries = batch.column("queries")[row].values
                weights = quantised(queries.field("vector"), scale)
                for query, weight in zip(queries.field("vec_id").to_pylist(), weights):
                    found, scores = index_.top(query, weight, k)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), query)), pa.array(found), pa.array(scores)], names=["query_id", "vec_id", "score"])

    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = pairs.repartition(tasks, "name", "chunk").mapInArrow(run, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
