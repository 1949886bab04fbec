"""An interpolated modified Kneser-Ney n-gram model, counted in Spark and looked up in sorted hash arrays.

Counting. Words are 64-bit hashes. Tasks count the n-grams of their texts and send them, packed as arrays, to buckets; a
bucket sorts and merges what it gets, writes its n-grams and their contexts as sorted arrays to the shared folder, and
passes each distinct n-gram's last n - 1 words on as a continuation count of the next lower order, down to single words.
A bucket is chosen by the hash of an n-gram's context, so that a context's totals are complete there; n-grams after
frequent words only (at least ``1 / HOT`` of all tokens, so at most HOT words) are dealt by their own hash instead, and
their contexts' totals are added up from all buckets. Nothing but these few totals and the counts of counts, from which
the discounts are computed, reaches the driver; no task holds more than a bucket.

Scoring. Workers memory-map the arrays and look up a slice of texts at once, each distinct n-gram once and in sorted order.
P(w | context) = max(c - D(c), 0) / total + (D1 n1 + D2 n2 + D3 n3) / total * P(w | shorter context), with raw counts for
the highest order and continuation counts below, down to 1 / (V + 1). Unseen contexts fall through to shorter ones.

Defined results. A null or empty text has one token, its end. Texts are preceded by order - 1 start marks, which are
contexts but no tokens. Without training rows every probability is 1 (V = N = 0). Discounts that the counts of counts
do not determine are 0.5, 1 and 1.5. Repeated rows count, and are scored, as often as they stand there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.llm import arrays
from shoptide.llm.common import ROW, annotate, stored, texts, words
from shoptide.session import scratch_dir

START, END = np.uint64(1), np.uint64(2)
HOT = 1024
# Tokens a task counts before it sends them on, and those for which there is a bucket.
AT_A_TIME, PER_BUCKET = 1 << 20, 1 << 20
# Files a task keeps mapped.
MAPPED = 4096
PACKETS = "target int, grams binary, counts binary"
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def keys_of(grams: np.ndarray) -> np.ndarray:
    """A hash of each row of words; no words hash to 0."""
    key = np.zeros(len(grams), np.uint64)
    for column in grams.T:
        key = spread(key * MULTIPLIER + column)
    return key


def token_hashes(text: bytes) -> np.ndarray:
    found = words(text)
    digest = xxhash.xxh64_intdigest
    out = np.fromiter(map(digest, found), np.uint64, len(found))
    out[out < 3] += np.uint64(3)
    return np.append(out, END)


def windows(tokens: list[np.ndarray], order: int) -> np.ndarray:
    """The n-gram that ends at each token, starts of texts padded."""
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    pad = order - 1
    flat = np.full(int(sizes.sum()) + pad * len(tokens), START, np.uint64)
    ends = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(tokens)) + 1, sizes) * pad
    flat[ends] = np.concatenate(tokens)
    return np.stack([flat[ends - pad + i] for i in range(order)], axis=1)


def buckets_of(grams: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    context = grams[:, :-1]
    common = np.isin(context, hot).all(axis=1) if context.shape[1] else np.ones(len(grams), bool)
    key = np.where(common, keys_of(grams), keys_of(context))
    return (spread(key + np.uint64(7)) % np.uint64(buckets)).astype(np.int64)


def merged(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, sorted by words, with their counts added up."""
    if not len(grams):
        return grams, counts
    order = np.lexsort(grams.T[::-1])
    grams, counts = grams[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (grams[1:] != grams[:-1]).any(axis=1))))
    return grams[first], np.add.reduceat(counts, first)


def packets(grams: np.ndarray, counts: np.ndarray, hot: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Merged n-grams by bucket; columns of words stand one after another, which compresses well."""
    grams, counts = merged(grams, counts)
    target = buckets_of(grams, hot, buckets)
    order = np.argsort(target, kind="stable")
    grams, counts, target = grams[order], counts[order], target[order]
    edges = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1], [True]))) if len(target) else np.zeros(1, np.int64)
    parts = list(zip(edges, edges[1:]))
    small = np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(target[a]) for a, _ in parts], pa.int32()),
            pa.array([grams[a:b].tobytes("F") for a, b in parts], pa.binary()),
            pa.array([bytes([np.dtype(small).itemsize]) + counts[a:b].astype(small).tobytes() for a, b in parts], pa.binary()),
        ],
        names=["target", "grams", "counts"],
    )


def unpacked(grams: bytes, counts: bytes, order: int) -> tuple[np.ndarray, np.ndarray]:
    c = np.frombuffer(counts, {4: np.uint32, 8: np.uint64}[counts[0]], offset=1).astype(np.int64)
    return np.frombuffer(grams, np.uint64).reshape(order, len(c)).T, c


def counted(docs: DataFrame, order: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """Packets of the n-grams of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            grams = windows(held, order)
            return packets(grams, np.ones(len(grams), np.int64), hot, buckets)

        for batch in batches:
            for text in texts(batch.column("text")):
                held.append(token_hashes(text))
                size += len(held[-1])
                if size >= AT_A_TIME:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return docs.select("text").mapInArrow(run, PACKETS)


def by_bucket(packed: DataFrame, order: int, work, schema: str) -> DataFrame:
    """``work(bucket, grams, counts)`` yields rows for each bucket."""

    def run(table: pa.Table) -> pa.Table:
        parts = [unpacked(g, c, order) for g, c in zip(table.column("grams").to_pylist(), table.column("counts").to_pylist())]
        grams, counts = merged(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        return pa.Table.from_batches(list(work(table.column("target")[0].as_py(), grams, counts)))

    return packed.groupBy("target").applyInArrow(run, schema)


@dataclass
class Level:
    """Discounts, and contexts whose totals came from several buckets: key, total, n1, n2, n3."""

    discounts: list[float]
    hot_keys: np.ndarray
    hot_totals: np.ndarray


@dataclass
class Model:
    folder: str
    order: int
    buckets: int
    hot: np.ndarray
    levels: dict[int, Level]
    tokens: int
    vocabulary: int


CONTEXTS = "array<struct<key: bigint, total: bigint, n1: bigint, n2: bigint, n3: bigint>>"
WRITTEN = f"target int, grams binary, counts binary, contexts {CONTEXTS}, repeats array<bigint>"
CONTEXT = pa.struct([(name, pa.int64()) for name in ("key", "total", "n1", "n2", "n3")])


def written_rows(lower: pa.RecordBatch, contexts: list[dict] | None = None, repeats: list[int] | None = None) -> pa.RecordBatch:
    """Packets of the next lower order; or, without packets, a bucket's statistics."""
    if repeats is None:
        nothing = [pa.nulls(lower.num_rows, pa.list_(CONTEXT)), pa.nulls(lower.num_rows, pa.list_(pa.int64()))]
        columns = [*lower.columns, *nothing]
    else:
        types = [pa.int32(), pa.binary(), pa.binary(), pa.list_(CONTEXT), pa.list_(pa.int64())]
        columns = [pa.array([x], t) for x, t in zip((None, None, None, contexts, repeats), types)]
    return pa.RecordBatch.from_arrays(columns, names=["target", "grams", "counts", "contexts", "repeats"])


def write_level(folder: str, order: int, hot: np.ndarray, buckets: int):
    """Work on a bucket of n-grams: writes its arrays, returns statistics and the packets of the next lower order."""

    def work(bucket: int, grams: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/{order}/{bucket:06d}"
        key = keys_of(grams)
        by_key = np.argsort(key)
        key, count = key[by_key], counts[by_key]
        arrays.save(f"{name}-once.npy", key[count == 1])
        arrays.save(f"{name}-more.npy", key[count > 1])
        more = count[count > 1]
        arrays.save(f"{name}-counts.npy", more.astype(np.uint32 if not len(more) or more.max() < 1 << 32 else np.uint64))
        context = keys_of(grams[:, :-1])
        by_context = np.argsort(context, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(context[by_context]) != 0)))
        c = counts[by_context]
        totals = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (c, c == 1, c == 2, c >= 3)], axis=1)
        contexts = context[by_context][first]
        common = np.isin(grams[by_context][first][:, :-1], hot).all(axis=1)
        arrays.save(f"{name}-contexts.npy", contexts[~common])
        arrays.save(f"{name}-totals.npy", totals[~common])
        shared = np.column_stack([contexts[common].view(np.int64), totals[common]])
        repeats = np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()
        yield written_rows(None, [dict(zip(CONTEXT.names, row)) for row in shared.tolist()], repeats)
        if order > 1:
            yield written_rows(packets(grams[:, 1:], np.ones(len(grams), np.int64), hot, buckets))

    return work


WORDS = "words long, tokens long, top array<struct<word: bigint, n: bigint>>"


def write_words(folder: str):
    """Work on a bucket of words: writes their raw counts, returns how many, of how many tokens, and the most frequent."""

    def work(bucket: int, grams: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        key = keys_of(grams)
        order = np.argsort(key)
        arrays.save(f"{folder}/words/{bucket:06d}-keys.npy", key[order])
        arrays.save(f"{folder}/words/{bucket:06d}-counts.npy", counts[order].astype(np.uint64))
        top = np.argsort(-counts, kind="stable")[:HOT]  # more cannot have 1 / HOT of all tokens
        often = [{"word": w, "n": n} for w, n in zip(grams[top, 0].astype(np.int64).tolist(), counts[top].tolist())]
        kind = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))
        yield pa.RecordBatch.from_arrays([pa.array([len(key)]), pa.array([int(counts.sum())]), pa.array([often], kind)], names=["words", "tokens", "top"])

    return work


def discounts(n: np.ndarray) -> list[float]:
    """Of counts 1, 2, and 3 or more, from the numbers of n-grams counted once to four times."""
    if not (n > 0).all():
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [float(min(max(j - (j + 1) * y * n[j] / n[j - 1], 0.0), j)) for j in (1, 2, 3)]


def train(docs: DataFrame, order: int = 2) -> Model:
    """Counts all texts of ``docs``."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "lm-")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, ceil(size / 6 / PER_BUCKET))
    none = np.empty(0, np.uint64)
    found = stored(by_bucket(counted(docs, 1, none, buckets), 1, write_words(folder), WORDS), "words")
    vocabulary, tokens = (int(x or 0) for x in found.agg(F.sum("words"), F.sum("tokens")).first())
    often = found.select(F.explode("top").alias("x")).where(F.col("x.n") * HOT >= tokens).select("x.word").collect()
    hot = np.sort(np.array([START, *[np.uint64(r[0] % (1 << 64)) for r in often]], np.uint64))
    packed, levels = counted(docs, order, hot, buckets), {}
    for n in range(order, 0, -1):
        written = stored(by_bucket(packed, n, write_level(folder, n, hot, buckets), WRITTEN), f"grams{n}")
        levels[n] = level(written)
        packed = written.where("repeats is null").select("target", "grams", "counts")
    return Model(folder, order, buckets, hot, levels, tokens, vocabulary)


def level(written: DataFrame) -> Level:
    """At most HOT^(n - 1) contexts stand in more than one bucket; they are added up before they are collected."""
    stats = written.where("repeats is not null")
    once = stats.agg(*[F.sum(F.get("repeats", F.lit(j))) for j in range(4)]).first()
    totals = [F.sum(f"x.{name}").alias(name) for name in CONTEXT.names[1:]]
    rows = stats.select(F.explode("contexts").alias("x")).groupBy("x.key").agg(*totals).collect()
    keys = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(keys)
    sums = np.array([tuple(r)[1:] for r in rows], np.int64).reshape(-1, 4)
    return Level(discounts(np.array([n or 0 for n in once], np.int64)), keys[order], sums[order])


class Reader:
    """Looks n-grams up in a model's arrays, of which MAPPED files at most are mapped at a time."""

    def __init__(self, model: Model):
        self.model, self.files = model, {}

    def file(self, name: str) -> np.ndarray:
        if name not in self.files:
            if len(self.files) >= MAPPED:
                self.files.clear()
            try:
                self.files[name] = arrays.load(f"{self.model.folder}/{name}.npy")
            except FileNotFoundError:  # a bucket without n-grams
                self.files[name] = None
        return self.files[name]

    def word_counts(self, tokens: np.ndarray) -> np.ndarray:
        grams = tokens[:, None]
        key, bucket = keys_of(grams), buckets_of(grams, np.empty(0, np.uint64), self.model.buckets)
        out = np.zeros(len(tokens), np.int64)
        for b, at in by_value(bucket):
            table = self.file(f"words/{b:06d}-keys")
            if table is not None:
                place, hit = arrays.find(table, key[at])
                out[at[hit]] = self.file(f"words/{b:06d}-counts")[place[hit]]
        return out

    def grams(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of the n-grams, and (total, n1, n2, n3) of their contexts."""
        n, model = grams.shape[1], self.model
        known = model.levels[n]
        key, context = keys_of(grams), keys_of(grams[:, :-1])
        counts, totals = np.zeros(len(grams), np.int64), np.zeros((len(grams), 4), np.int64)
        for b, at in by_value(buckets_of(grams, model.hot, model.buckets)):
            name = f"{n}/{b:06d}"
            once = self.file(f"{name}-once")
            if once is None:
                continue
            counts[at[arrays.find(once, key[at])[1]]] = 1
            place, hit = arrays.find(self.file(f"{name}-more"), key[at])
            counts[at[hit]] = self.file(f"{name}-counts")[place[hit]]
            place, hit = arrays.find(self.file(f"{name}-contexts"), context[at])
            totals[at[hit]] = self.file(f"{name}-totals")[place[hit]]
        place, hit = arrays.find(known.hot_keys, context)
        totals[hit] = known.hot_totals[place[hit]]
        return counts, totals

    def probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Of the last word of each n-gram after the others."""
        distinct, back = distinct_rows(grams)
        n, model = grams.shape[1], self.model
        lower = self.probabilities(distinct[:, 1:]) if n > 1 else np.full(len(distinct), 1 / (model.vocabulary + 1))
        counts, totals = self.grams(distinct)
        d = np.array([0.0, *model.levels[n].discounts])
        total = np.maximum(totals[:, 0], 1)
        found = np.maximum(counts - d[np.minimum(counts, 3)], 0) / total + totals[:, 1:] @ d[1:] / total * lower
        return np.where(totals[:, 0] > 0, found, lower)[back]


def by_value(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(values, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], np.diff(values[order]) != 0, [True]))) if len(values) else []
    for a, b in zip(edges, edges[1:]):
        yield int(values[order[a]]), order[a:b]


def distinct_rows(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first, back = np.unique(keys_of(grams), return_index=True, return_inverse=True)
    return grams[first], back


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (all columns of docs), n_tokens, n_known, base_score and score, the log10 probabilities of the text."""

    shared = docs.sparkSession.sparkContext.broadcast((model.__dict__, {n: v.__dict__ for n, v in model.levels.items()}))
    held: list[Reader] = []

    def reader() -> Reader:
        if not held:
            parts, levels = shared.value
            held.append(Reader(Model(**{**parts, "levels": {n: Level(**v) for n, v in levels.items()}})))
        return held[0]

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        look, tokens = reader(), [token_hashes(t) for t in texts(batch.column("text"))]
        m = look.model
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        starts = np.cumsum(sizes) - sizes
        distinct, back = np.unique(np.concatenate(tokens), return_inverse=True)
        c = look.word_counts(distinct)
        base = np.log10((c + 0.5) / (m.tokens + 0.5 * (m.vocabulary + 1)))[back]
        full = np.log10(look.probabilities(windows(tokens, m.order)))
        known = (c > 0)[back].astype(np.int64)
        return [pa.array(x) for x in (sizes, np.add.reduceat(known, starts), np.add.reduceat(base, starts), np.add.reduceat(full, starts))]

    return annotate(docs, values, "n_tokens long, n_known long, base_score double, score double")
