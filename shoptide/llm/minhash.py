"""Near duplicates by the similarity of shingle sets: a forest of sorted MinHash signatures, then exact comparison.

A document's set is that of its distinct shingles; documents link if 100 * |common| >= ``percent`` * |all|, and a class is
what can be reached over links. How it is spread out:

- Equal sets are one node from the start, so copies cost nothing later. Sets are told apart by 128 bits of all hashes.
- ``TREES`` orders sort the nodes, each by ``DEEP`` minima of its own (16 bits kept of each). Nodes whose longest common
  prefix in some order has a depth's length lie in one region. A region starts ``SHALLOW`` minima deep; one of more than
  ``CROWD`` nodes is cut a minimum deeper, and again, to ``DEEP`` at most. Sets of a similarity J share no region of depth d
  with a chance of (1 - J^d)^TREES: at 0.85 that is 3 in ten million for 6, and 4 in a hundred thousand for 8.
- In a region neighbours in the sorted order are compared first, then what they have not joined yet, by the share of equal
  minima over all orders. From ``share`` on (7 standard deviations below the limit) they are candidates. Large regions are
  cut into chunks, each pair of chunks a task of its own. Candidates that span what a region joins are kept, not all pairs.
- Classes of candidates get the full hashes of their sets, once, in chunks and pairs of chunks where they are many, and
  there all pairs that are not joined yet are compared exactly. Only those exact links make the result.

Defined results. A null text or one without words has the empty set, links with nothing, and is a class of its own; with
fewer words than a shingle the whole text is the one shingle. ``component_id`` is the smallest id of the class; a null id is
never one, and a class without any id has null. ``kept`` is whether the id is the class's, so repeated rows are kept or
dropped together. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import ROW, annotate, stored, texts
from shoptide.llm.simhash import SEED, classes, first_row, merge, shingle_hashes, stars

TREES, SHALLOW, DEEP, CROWD = 32, 6, 8, 64
MINIMA = TREES * DEEP
MINIMA_AT_A_TIME = 1 << 13
# Nodes of a chunk of a region, and rows of regions held at a time.
CHUNK_NODES, ROWS_AT_A_TIME = 2048, 1 << 14
# Sets and hashes of a chunk of a class of candidates.
CHUNK_SETS, CHUNK_HASHES = 512, 1 << 21
# Bits of the filter of rows whose sets are sent; what it lets through wrongly is dropped by a join.
FILTER_BITS = 1 << 26


def signature(shingles: np.ndarray) -> bytes:
    """The low 16 bits of the minima of a set of hashes under MINIMA linear orders; nothing for the empty set."""
    if not len(shingles):
        return b""
    draw = np.random.default_rng(SEED)
    factor, shift = draw.integers(0, 1 << 32, (2, MINIMA, 1), dtype=np.uint32)
    short, factor = (shingles >> np.uint64(32)).astype(np.uint32), factor | np.uint32(1)
    minima = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(short), MINIMA_AT_A_TIME):
        np.minimum(minima, (short[start : start + MINIMA_AT_A_TIME] * factor + shift).min(axis=1), out=minima)
    return (minima & np.uint32(0xFFFF)).astype(">u2").tobytes()


def set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_hash, ``set_key``, ``n_shingles`` and ``signature`` of every row, stored."""

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        sets = [np.unique(shingle_hashes(t, width)) for t in texts(batch.column("text"))]
        return [
            pa.array(map(set_key, sets), pa.binary()),
            pa.array(map(len, sets), pa.int64()),
            pa.array(map(signature, sets), pa.binary()),
        ]

    found = annotate(docs, values, "set_key binary, n_shingles long, signature binary")
    row = F.col(ROW)
    columns = [row["doc_id"].alias("doc_id"), F.xxhash64(row["text"]).alias("text_hash")]
    return stored(found.select(*columns, "set_key", "n_shingles", "signature"), "signatures")


def regions(nodes: DataFrame) -> DataFrame:
    """``key``, ``tree``, ``node`` and the size ``n`` of every region of two nodes or more, stored."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    rows, found = nodes.select("node", "signature", tree), None
    for depth in range(SHALLOW, DEEP + 1):
        prefix = F.substring("signature", 2 * DEEP * F.col("tree") + 1, F.lit(2 * depth))
        keyed = rows.select("node", "tree", F.xxhash64("tree", prefix).alias("key"))
        sizes = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        crowded = F.lit(False) if depth == DEEP else F.col("n") > CROWD
        here = keyed.join(sizes.where(~crowded), "key").select("key", "tree", "node", "n")
        found = here if found is None else found.unionByName(here)
        if depth < DEEP:
            left = keyed.join(sizes.where(crowded), "key").select("node", "tree")
            rows = stored(left, "crowded").join(nodes.select("node", "signature"), "node")
    return stored(found, "regions")


def region_links(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Candidates that span what each part joins. Rows (part, tree, node, signature) come sorted by part."""

    def links(rows: pa.Table) -> pa.RecordBatch:
        part, tree, node = (rows.column(c).to_numpy() for c in ("part", "tree", "node"))
        minima = np.frombuffer(b"".join(rows.column("signature").to_pylist()), ">u2").astype(np.uint16).reshape(-1, MINIMA)
        path = minima.reshape(-1, TREES, DEEP)[np.arange(len(node)), tree]
        order = np.lexsort([*path.T[::-1], part])
        part, node, minima = part[order], node[order], minima[order]
        root = np.arange(len(node))
        beside = np.flatnonzero(part[1:] == part[:-1])
        for start in range(0, len(beside), 4096):
            at = beside[start : start + 4096]
            near = at[(minima[at] == minima[at + 1]).sum(axis=1) >= least]
            merge(root, near, near + 1)
        edge = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        for low, high in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if high - low < 3 or (root[low:high] == root[low]).all():
                continue
            for i in range(low, high - 1):
                others = i + 1 + np.flatnonzero(root[i + 1 : high] != root[i])
                near = others[(minima[others] == minima[i]).sum(axis=1) >= least]
                merge(root, np.full(len(near), i), near)
        moved = np.flatnonzero(root != np.arange(len(node)))
        ends = node[moved], node[root[moved]]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(*ends)), pa.array(np.minimum(*ends))], names=["u", "v"])

    held: list[pa.Table] = []
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
            held.append(pa.Table.from_batches([batch.slice(start, ROWS_AT_A_TIME)]))
            if sum(t.num_rows for t in held) < ROWS_AT_A_TIME:
                continue
            rows = pa.concat_tables(held).combine_chunks()
            parts = rows.column("part").to_numpy()
            cut = int(np.flatnonzero(parts == parts[-1])[0])  # the last part may go on
            if cut:
                yield links(rows.slice(0, cut))
            held = [rows.slice(cut)]
    if held:
        yield links(pa.concat_tables(held).combine_chunks())


def in_parts(rows: DataFrame, key: str, chunks: str) -> DataFrame:
    """Rows of every group cut into ``chunks``, once for each pair of chunks they belong to, named ``part``."""
    split = rows.withColumn("mine", F.pmod(F.xxhash64("node", key), F.col(chunks)))
    split = split.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(chunks) - 1)))
    return split.withColumn("part", F.xxhash64(key, F.least("mine", "other"), F.greatest("mine", "other")))


def dealt(rows: DataFrame) -> DataFrame:
    """Each part in one task, sorted."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "part").sortWithinPartitions("part")


def candidates(nodes: DataFrame, share: float) -> DataFrame:
    """Links (u, v), u > v, that span what may be similar."""
    rows = regions(nodes).withColumn("chunks", F.ceil(F.col("n") / CHUNK_NODES))
    parts = in_parts(rows, "key", "chunks").select("part", "tree", "node")
    signed_parts = parts.join(nodes.select("node", "signature"), "node").select("part", "tree", "node", "signature")
    least = int(np.ceil(share * MINIMA))
    return dealt(signed_parts).mapInArrow(lambda batches: region_links(batches, least), "u long, v long").distinct()


def hashes_of(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """``node``, ``root`` and ``hashes`` (8 bytes each, sorted) of ``members`` (node, root, set_key, own), stored.

    Rows are told by a filter of bits, of a bounded size; the texts of the others are not hashed again.
    """

    def place(doc_id: str, text_hash: str):
        return F.pmod(F.xxhash64(text_hash, doc_id), F.lit(FILTER_BITS)) + 1

    at = place("own.doc_id", "own.text_hash")
    bits = members.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    wanted = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in bits.collect():  # FILTER_BITS at most
        part = np.frombuffer(row["bits"], np.uint8)
        wanted[(row["bucket"] - 1) * len(part) : row["bucket"] * len(part)] = part
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy() - 1
            hit = np.flatnonzero(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            for start in range(0, len(hit), 256):
                some = batch.column("text").take(pa.array(hit[start : start + 256]))
                sets = [np.unique(shingle_hashes(t, width)) for t in texts(some)]
                columns = [pa.array(map(set_key, sets), pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["set_key", "hashes"])

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).select(place("doc_id", "text_hash").alias("place"), "text")
    found = rows.mapInArrow(run, "set_key binary, hashes binary").join(members.select("node", "root", "set_key"), "set_key")
    return stored(found.dropDuplicates(["node"]).select("node", "root", "hashes"), "hashes")


def set_links(nodes: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v), u > v, that span the classes of sets of which at least ``percent`` of a hundred are common."""
    order = np.lexsort((nodes, np.fromiter(map(len, sets), np.int64, len(sets))))
    nodes, sets = nodes[order], [sets[i] for i in order.tolist()]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    distinct, flat = np.unique(np.concatenate(sets), return_inverse=True)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    root, inside = np.arange(len(nodes)), np.zeros(len(distinct), bool)
    highs = np.searchsorted(percent * sizes, 100 * sizes, "right")  # larger sets are too large
    for i, high in enumerate(highs.tolist()):
        others = i + 1 + np.flatnonzero(root[i + 1 : high] != root[i])
        if not len(others):
            continue
        mine = flat[edges[i] : edges[i + 1]]
        inside[mine] = True
        whole = len(others) == high - i - 1
        rest = flat[edges[i + 1] : edges[high]] if whole else np.concatenate([flat[edges[j] : edges[j + 1]] for j in others.tolist()])
        common = np.add.reduceat(inside[rest], np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
        inside[mine] = False
        near = others[100 * common >= percent * (sizes[i] + sizes[others] - common)]
        merge(root, np.full(len(near), i), near)
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    ends = nodes[moved], nodes[root[moved]]
    return np.maximum(*ends), np.minimum(*ends)


def exact_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links (u, v), u > v, between ``rows`` (node, root, hashes) of the same root."""
    totals = rows.groupBy("root").agg(F.count("*").alias("n"), F.sum(F.octet_length("hashes") / 8).alias("size"))
    chunks = F.ceil(F.greatest(F.col("n") / CHUNK_SETS, F.col("size") / CHUNK_HASHES)).alias("chunks")
    parts = in_parts(rows.join(totals.select("root", chunks), "root"), "root", "chunks").select("part", "node", "hashes")

    def links(held: list[tuple[int, bytes]]) -> pa.RecordBatch:
        nodes = np.array([n for n, _ in held], np.int64)
        ends = set_links(nodes, [np.frombuffer(h, np.uint64) for _, h in held], percent)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in ends], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for key, node, hashes in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now and held:
                    yield links(held)
                    held = []
                now = key
                held.append((node, hashes))
        if held:
            yield links(held)

    return dealt(parts).mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85, share: float | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    share = percent / 100 - 0.15 if share is None else share
    docs = docs.select("doc_id", "text")
    found = signed(docs, width)
    sets = found.where("n_shingles > 0").groupBy("set_key").agg(first_row(), F.first("signature").alias("signature"))
    nodes = stored(sets.withColumn("node", F.monotonically_increasing_id()), "nodes")
    near = stars(candidates(nodes, share))
    roots = near.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = roots.unionByName(near.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
    members = stored(nodes.select("node", "set_key", "own").join(roots, "node"), "members")
    links = exact_links(hashes_of(docs, members, width), percent)
    of = classes(nodes.select("node", "own"), links, "node").select("node", F.col("own.doc_id").alias("low"))
    of = nodes.select("node", "set_key").join(of, "node").select("set_key", "low")
    rows = found.select("doc_id", "n_shingles", "set_key").join(of, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("low")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
