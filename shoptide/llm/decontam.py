"""Benchmark decontamination: rare word n-grams of the test items as seeds, Smith-Waterman alignment as the judge.

Documents meet items through shared n-grams of ``width`` words. An item's seeds are its n-grams whose document frequency,
counted over all documents, is at most the median of the item's own n-grams or ``common`` of the documents, whichever is
more: every item keeps at least half of its n-grams, however often it was copied. A window around each seed, as long as
the item and a quarter more on either side, is aligned with the whole item: a match counts 2, a mismatch or a gap -1, and
the score is divided by that of a whole copy. From ``threshold`` on the document is contaminated.

The items are taken in blocks of about ``block_bytes`` of text, each small enough to be broadcast; documents are not
shuffled at all, so no passage is hot.

Defined results. A null or empty text has no items and score 0. Items that are null, or shorter than ``width`` words, are
seeded by all their words as one n-gram of that length if they have any, else they match nothing. Equal scores: the
smaller item. Words are runs of letters and digits, A-Z in lower case. Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm.common import ROW, annotate, bare_words, texts

MATCH, MISMATCH, GAP = 2, 1, 1
HITS = "array<struct<item_id: bigint, score: double>>"


class Items:
    """A block of items: words as numbers from 1, n-grams as sorted codes, and where they stand in which item."""

    def __init__(self, rows: list[tuple[int, bytes]], width: int):
        self.ids = [r[0] for r in rows]
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        self.words = [np.array([number.setdefault(w, len(number) + 1) for w in bare_words(t)], np.int64) for _, t in rows]
        self.base = len(number) + 1
        self.widths = sorted({min(width, len(w)) for w in self.words if len(w)})
        self.places: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for item, found in enumerate(self.words):
            if len(found):
                n = min(width, len(found))
                for at, code in enumerate(codes(found, n, self.base).tolist()):
                    self.places[n, code].append((item, at))
        self.grams = {n: np.array(sorted(c for m, c in self.places if m == n), np.int64) for n in self.widths}

    def numbers(self, text: bytes) -> np.ndarray:
        found = bare_words(text)
        return np.fromiter(map(self.vocabulary.get, found, repeat(0)), np.int64, len(found))

    def hits(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(n, code, place) of each n-gram of the text that is a seed."""
        for n, seeds in self.grams.items():
            if len(numbers) >= n and len(seeds):
                known = numbers > 0
                at = np.flatnonzero(np.logical_and.reduce([known[i : len(known) - n + 1 + i] for i in range(n)]))
                if len(at):
                    code = sum(numbers[at + i] * self.base ** (n - 1 - i) for i in range(n))
                    found = seeds[np.minimum(np.searchsorted(seeds, code), len(seeds) - 1)] == code
                    yield from zip(repeat(n), code[found].tolist(), at[found].tolist())

    def keep(self, frequency: dict[tuple[int, int], int], common: float) -> None:
        """Leaves each item's rarer half of n-grams, and those rarer than ``common``."""
        of = defaultdict(list)
        for gram, places in self.places.items():
            for item, at in places:
                of[item].append((frequency.get(gram, 0), gram, at))
        self.places = defaultdict(list)
        for item, found in of.items():
            limit = max(common, sorted(f for f, _, _ in found)[(len(found) - 1) // 2])
            for f, gram, at in found:
                if f <= limit:
                    self.places[gram].append((item, at))
        self.grams = {n: np.array(sorted(c for m, c in self.places if m == n), np.int64) for n in self.widths}

    def windows(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first word, last word) around seeds; windows of one item that overlap by half are one."""
        starts = defaultdict(set)
        for n, code, place in self.hits(numbers):
            for item, at in self.places[n, code]:
                starts[item].add(place - at)
        for item, found in starts.items():
            size = len(self.words[item])
            slack = max(4, size // 4)
            ordered = sorted(found)
            low = high = ordered[0]
            for start in [*ordered[1:], None]:
                if start is not None and start - low <= slack:
                    high = start
                    continue
                yield item, max(0, low - slack), high + size + slack
                low = high = start


def codes(numbers: np.ndarray, n: int, base: int) -> np.ndarray:
    return sum(numbers[i : len(numbers) - n + 1 + i] * base ** (n - 1 - i) for i in range(n))


def smith_waterman(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each pair, all pairs at once, a row of the item at a time."""
    count, width, height = len(items), max(map(len, passages)), max(map(len, items))
    a, b = np.full((count, height), -1, np.int64), np.full((count, width), -2, np.int64)
    for i in range(count):
        a[i, : len(items[i])], b[i, : len(passages[i])] = items[i], passages[i]
    steps = GAP * np.arange(width)
    row, best = np.zeros((count, width), np.int64), np.zeros(count, np.int64)
    for j in range(height):
        diagonal = np.concatenate([np.zeros((count, 1), np.int64), row[:, :-1]], axis=1)
        now = np.maximum(diagonal + np.where(a[:, j : j + 1] == b, MATCH, -MISMATCH), row - GAP)
        np.maximum(now, 0, out=now)
        row = np.maximum.accumulate(now + steps, axis=1) - steps  # gaps along the passage
        np.maximum(best, row.max(axis=1), out=best)
    return best


def blocks(spark: SparkSession, items: DataFrame, width: int, block_bytes: int) -> Iterator[Items]:
    texts_ = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = texts_.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, ceil(total / block_bytes))
    for block in range(count):
        rows = texts_.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block).distinct().collect()
        if rows:
            yield Items(sorted((-1 if r[0] is None else r[0], r[1].encode()) for r in rows), width)


def frequencies(docs: DataFrame, items: Shared) -> dict[tuple[int, int], int]:
    """In how many documents each n-gram of the block stands: no more rows than the block has n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts = items.value, Counter()
        for batch in batches:
            for text in texts(batch.column("text")):
                counts.update({(n, code) for n, code, _ in block.hits(block.numbers(text))})
        if counts:
            columns = zip(*[(n, code, c) for (n, code), c in counts.items()])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n", "code", "docs"])

    found = docs.select("text").mapInArrow(run, "n long, code long, docs long")
    return {(r[0], r[1]): r[2] for r in found.groupBy("n", "code").agg(F.sum("docs")).collect()}


def align(
    docs: DataFrame, items: DataFrame, width: int = 3, threshold: float = 0.5, common: float = 0.001, block_bytes: int = 4 << 20
) -> DataFrame:
    """``row`` (all columns of docs) and ``hits``, the items found with their scores from ``threshold`` on, best first."""
    spark = docs.sparkSession
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias(ROW), "text", F.array().cast(HITS).alias("hits"))
    total = docs.count()
    for block in blocks(spark, items, width, block_bytes):
        counted = frequencies(docs, Shared(spark, block))
        block.keep(counted, common * total)
        found = annotate(rows, finder(Shared(spark, block), threshold), f"found {HITS}")
        rows = found.select(f"{ROW}.{ROW}", f"{ROW}.text", F.concat(f"{ROW}.hits", "found").alias("hits"))
    by_score = F.array_sort(F.transform("hits", lambda h: F.struct((-h["score"]).alias("lost"), h["item_id"].alias("item_id"))))
    order = F.transform(by_score, lambda h: F.struct(h["item_id"].alias("item_id"), (-h["lost"]).alias("score")))
    return rows.select(ROW, order.alias("hits"))


class Shared:
    """A block, broadcast as plain values."""

    def __init__(self, spark: SparkSession, block: Items):
        self.parts = spark.sparkContext.broadcast(block.__dict__)

    @property
    def value(self) -> Items:
        block = object.__new__(Items)
        block.__dict__.update(self.parts.value)
        return block


def finder(items: Shared, threshold: float):
    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        block = items.value
        pairs = []
        for at, text in enumerate(texts(batch.column("text"))):
            numbers = block.numbers(text)
            pairs += [(at, item, numbers[low:high]) for item, low, high in block.windows(numbers)]
        pairs.sort(key=lambda p: len(p[2]))
        best: dict[tuple[int, int], float] = {}
        for start in range(0, len(pairs), 256):
            part = pairs[start : start + 256]
            scores = smith_waterman([block.words[i] for _, i, _ in part], [p for _, _, p in part])
            for (at, item, _), score in zip(part, scores.tolist()):
                share = score / (MATCH * len(block.words[item]))
                if share >= threshold:
                    best[at, item] = max(share, best.get((at, item), 0.0))
        out: list[list] = [[] for _ in range(batch.num_rows)]
        for (at, item), share in best.items():
            out[at].append({"item_id": block.ids[item], "score": share})
        return [pa.array(out, pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64())])))]

    return values
