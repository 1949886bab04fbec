"""Near duplicates by SimHash: fingerprints, a self-join of binary tries, and connected components.

A document's fingerprint has a bit set where over half of its shingles' hashes (XXH64, seed 42, repeats included) have
it set. Two fingerprints link if they differ in at most ``max_bits`` bits; a class is what can be reached over links.

How it is spread out. Equal fingerprints are one node from the start, so copies cost nothing later. The 64 bits are cut
into ``m = max_bits + r`` blocks; fingerprints within the limit agree exactly on at least r of them, so every choice of r
blocks is a path down the trie without an error, and all fingerprints below the same path form one group. A group is
joined with itself by walking pairs of nodes of its trie downward, adding up the bits in which the paths differ and
dropping a pair once there are more than ``max_bits``. r grows with the number of fingerprints (by cost, the result is the
same). A group above ``2 * half`` is cut into chunks, and each pair of chunks is a task of its own, so a hot group is
spread out and no link is lost. Each task returns links that span what it joined, not all pairs.

``one_of_each`` keeps the row with the smallest id of each class.

Defined results. A null text counts as empty. A text without words has fingerprint 0; a text with fewer words than a
shingle has one shingle, all of it. A null doc_id is a document like any other, but never a class id; a class without any
id has a null id. Repeated rows are equal documents. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import ROW, annotate, stored, texts, words

SEED = 42
BITS = 64
HASHES_AT_A_TIME = 1 << 16
# Rows of groups that are joined at a time, and pairs of trie nodes held at a time.
ROWS_AT_A_TIME, PAIRS_AT_A_TIME = 50_000, 1 << 20
# Pairs of trie nodes with at most so many pairs of leaves are not split any further.
SMALL = 16


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    tokens = words(text)
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    first = ends - lengths
    if len(tokens) >= width:
        first, ends = first[: len(tokens) - width + 1], ends[width - 1 :]
    else:
        first, ends = first[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], SEED) for s, e in zip(first.tolist(), ends.tolist())), np.uint64, len(first))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), HASHES_AT_A_TIME):
        part = hashes[start : start + HASHES_AT_A_TIME]
        bits = np.zeros((ceil(len(part) / 255) * 255, BITS), np.uint8)  # 255 rows add up within a byte
        bits[: len(part)] = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits.reshape(-1, 255, BITS), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """``row`` and ``fp``."""

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([fingerprint(shingle_hashes(t, width)) for t in texts(batch.column("text"))], pa.int64())]

    return annotate(docs, values, "fp long")


def exact_blocks(fingerprints_: int, max_bits: int, row_bytes: int) -> int:
    """r: how many blocks a group shares. Weighs the rows that are sent against the pairs that are compared."""

    def cost(r: int) -> float:
        paths = len(list(combinations(range(max_bits + r), r)))
        return paths * fingerprints_ * (1 + row_bytes / 32 + fingerprints_ / 2 ** (BITS * r / (max_bits + r)) / 600)

    return min(range(1, 4), key=cost)


def block_masks(max_bits: int, r: int) -> list[int]:
    """A mask, as a signed long, for each choice of r of the blocks."""
    edges = [round(BITS * i / (max_bits + r)) for i in range(max_bits + r + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, r)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def leaf_pairs(l1, n1, l2, n2) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j), i < j, with i from l1 on and j from l2 on, for each pair of nodes."""
    size = n1 * n2
    node = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(node)) - np.repeat(np.cumsum(size) - size, size)
    i, j = l1[node] + at // n2[node], l2[node] + at % n2[node]
    return i[i < j], j[i < j]


def trie_pairs(fps: np.ndarray, low: np.ndarray, high: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of the same group that differ in at most max_bits bits.

    fps are sorted within the groups [low, high). A trie node is a range of rows that share their upper bits; its
    children at a bit are found by counting the ones before its ends.
    """
    ones: dict[int, np.ndarray] = {}

    def split(bit, lo, hi):
        if bit not in ones:
            ones[bit] = np.concatenate(([0], np.cumsum((fps >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)))
        return hi - (ones[bit][hi] - ones[bit][lo])

    stack = [(BITS - 1, low, high, low, high, np.zeros(len(low), np.int64))]
    while stack:
        bit, l1, h1, l2, h2, errors = stack.pop()
        small = (h1 - l1) * (h2 - l2) <= SMALL
        if bit < 0:
            small[:] = True
        if small.any():
            at = np.flatnonzero(small)
            for start in range(0, len(at), PAIRS_AT_A_TIME // SMALL):
                s = at[start : start + PAIRS_AT_A_TIME // SMALL]
                i, j = leaf_pairs(l1[s], h1[s] - l1[s], l2[s], h2[s] - l2[s])
                near = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
                yield i[near], j[near]
            l1, h1, l2, h2, errors = (x[~small] for x in (l1, h1, l2, h2, errors))
        if not len(l1):
            continue
        m1, m2 = split(bit, l1, h1), split(bit, l2, h2)
        same = l1 == l2
        zeros, both = (l1, m1, l2, m2, errors), (m1, h1, m2, h2, errors)
        cross, back = (l1, m1, m2, h2, errors + 1), tuple(x[~same] for x in (m1, h1, l2, m2, errors + 1))
        children = [np.concatenate(x) for x in zip(zeros, both, cross, back)]
        keep = (children[4] <= max_bits) & (children[1] > children[0]) & (children[3] > children[2])
        keep &= (children[0] != children[2]) | (children[1] - children[0] > 1)
        children = [x[keep] for x in children]
        for start in range(0, len(children[0]), PAIRS_AT_A_TIME):
            stack.append((bit - 1, *(x[start : start + PAIRS_AT_A_TIME] for x in children)))


def merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the classes of i and j; root holds each row's class, the smallest row of it."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, low = i[apart], j[apart], np.minimum(a, b)[apart]
        np.minimum.at(root, np.maximum(a, b)[apart], low)
        while (up := root[root]).tobytes() != root.tobytes():
            root[:] = up


def group_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links that span the classes of each group. Rows come sorted by group and fingerprint."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        keys = rows.column("part").to_numpy()
        fps = rows.column("fp").to_numpy().view(np.uint64)
        order = np.lexsort((fps, keys))
        keys, fps = keys[order], fps[order]
        edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
        low, high = edge[:-1], edge[1:]
        several = high - low > 1
        root = np.arange(len(fps))
        for i, j in trie_pairs(fps, low[several], high[several], max_bits):
            merge(root, i, j)
        moved = np.flatnonzero(root != np.arange(len(fps)))
        ends = fps[moved].view(np.int64), fps[root[moved]].view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(*ends)), pa.array(np.minimum(*ends))], names=["u", "v"])

    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < ROWS_AT_A_TIME:
            continue
        rows = pa.concat_tables(held)
        keys = rows.column("part").to_numpy()
        cut = int(np.flatnonzero(keys == keys[-1])[0])  # the last group may go on
        if cut:
            yield links(rows.slice(0, cut))
        held = [rows.slice(cut).combine_chunks()]
    if held:
        yield links(pa.concat_tables(held))


def linked(nodes: DataFrame, max_bits: int, half: int = 512) -> DataFrame:
    """Links (u, v), u > v, between the distinct fingerprints of ``nodes`` (fp)."""
    count = nodes.count()
    r = exact_blocks(count, max_bits, 16)
    half = max(half, ceil(2 * count / 2 ** (BITS * r // (max_bits + r))))
    paths = F.transform(F.array(*[F.lit(m) for m in block_masks(max_bits, r)]), lambda m: F.col("fp").bitwiseAND(m))
    rows = nodes.select("fp", F.posexplode(paths).alias("path", "value"))
    rows = rows.select("fp", F.xxhash64("path", "value").alias("key"))
    sizes = stored(rows.groupBy("key").count().where("count > 1"), "sizes")
    chunks = F.ceil(F.col("count") / half)
    mine = F.pmod(F.xxhash64("fp", "key"), chunks)
    split = rows.join(sizes, "key").withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    part = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("part")
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = split.select(part, "fp").repartition(tasks, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(lambda batches: group_links(batches, max_bits), "u long, v long").distinct()


def stars(links: DataFrame) -> DataFrame:
    """(u, v) for each node u of a link that isn't its class's smallest node v. Links have u > v.

    Large and small stars by turns: a node's neighbours are tied to the smallest of them, until nothing changes.
    """

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    def smallest(edges: DataFrame) -> DataFrame:
        return edges.join(edges.groupBy("u").agg(F.min("v").alias("low")), "u")

    edges = stored(links, "links")
    seen = mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = smallest(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "low").alias("v")).distinct()
        small = smallest(large).select(F.explode(F.array(F.col("u"), F.col("v"))).alias("u"), F.col("low").alias("v"))
        edges = stored(small.where("u <> v").distinct(), "links")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges


def first_row() -> Column:
    """The row with the smallest id, nulls last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")).alias("own")


def classes(nodes: DataFrame, links: DataFrame, node: str) -> DataFrame:
    """For each of ``nodes`` (node, own): its class's smallest node ``root`` and first row ``own``."""
    roots = stars(links).select(F.col("u").alias(node), F.col("v").alias("root"))
    rooted = nodes.join(roots, node, "left").select(node, "own", F.coalesce("root", node).alias("root"))
    rooted = stored(rooted, "rooted")
    return rooted.select(node, "root").join(rooted.groupBy("root").agg(F.min("own").alias("own")), "root")


def signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_hash and fp of every row, stored."""
    row = F.col(ROW)
    columns = [row["doc_id"].alias("doc_id"), F.xxhash64(row["text"]).alias("text_hash"), "fp"]
    return stored(fingerprints(docs, width).select(*columns), "fingerprints")


def with_classes(found: DataFrame, max_bits: int) -> DataFrame:
    """``found`` (doc_id, text_hash, fp) with the first row ``own`` of each row's class."""
    nodes = stored(found.groupBy("fp").agg(first_row()), "nodes")
    return found.join(classes(nodes, linked(nodes, max_bits), "fp").select("fp", "own"), "fp")


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    found = with_classes(signed(docs.select("doc_id", "text"), width), max_bits)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, F.col("own.doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 3, max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class the one with the smallest id, once.

    What goes is told by id and text and is far less than what stays, so it is what texts are joined with.
    """
    found = with_classes(signed(docs.select("doc_id", "text"), width), max_bits)
    chosen = F.col("doc_id").eqNullSafe(F.col("own.doc_id")) & (F.col("text_hash") == F.col("own.text_hash"))
    rows = found.groupBy("doc_id", "text_hash").agg(F.bool_or(chosen).alias("chosen"), F.count("*").alias("n"))
    marked = stored(rows.where("not chosen or n > 1"), "marked")

    def among(rows: DataFrame, marked: DataFrame, how: str) -> DataFrame:
        same = (rows["text_hash"] == marked["text_hash"]) & rows["id"].eqNullSafe(marked["doc_id"])
        return rows.join(marked, same, how)

    packed = F.struct(*[docs[c] for c in docs.columns]).alias(ROW)
    whole = docs.select(packed, F.xxhash64("text").alias("text_hash"), F.col("doc_id").alias("id"))
    once = among(whole, marked, "left_anti").select(ROW)
    repeated = among(whole, marked.where("chosen"), "left_semi").dropDuplicates(["text_hash", "id"]).select(ROW)
    return once.unionByName(repeated).select(*[F.col(ROW)[c].alias(c) for c in docs.columns])
