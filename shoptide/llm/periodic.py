"""Runs of repeated words: maximal stretches that repeat with a period, at least four times over.

A run is a stretch of consecutive words with smallest period q, of ``least`` words and ``turns * q`` words or more, that no
neighbouring word extends with the same period. ``find`` lists all runs of a text and what is left of the text if every
run is cut to its first q words.

The work is done by longest common extensions: ``lce(i, j)`` is how many words from i on equal those from j on. Only the
suffixes at the places of a difference cover are sorted (6 of every 31; any two places meet sampled ones after the same
few steps): by their first 31 words, then by doubling over ranks of sampled places alone. Ranks passed on the way give
the common lengths of neighbours, and a sparse table answers for the smallest between two ranks. So an extension compares
at most 30 words and looks up two cells. Periods p = 1, 2, ... then ask at a harmonic grid, every 2p words: a run covers 4p
words, so one of its places on the grid is followed by more than p equal words, and the run is extended to the left from
the first of them by bisection. All asking together is n log n; texts of a slice are done at once, array-wise.

Where a stretch has several periods of a quarter of it or less, they are multiples of the smallest one (Fine and Wilf),
whose run is the same stretch; so of equal stretches the smallest period stays.

Defined results. A null text has no runs and a null ``collapsed``; a text without words has none, and ``collapsed`` is
empty. Words are what stands between ASCII white space; ``collapsed`` has one blank between them. Repeated rows are done
one by one; an empty table gives an empty table. Memory is bounded by the slice and its longest text (about 200 bytes a
word).
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shoptide.llm.common import annotate, texts

# Of any two places less than a multiple of 31 apart, some shift by the same amount puts both on a mark.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
LEAST, TURNS = 6, 4
QUERIES_AT_A_TIME = 1 << 20
RUNS = "runs array<struct<start: long, length: long, period: long>>, collapsed string"

MARKED = np.full(MODULUS, -1, np.int64)
MARKED[list(COVER)] = np.arange(len(COVER))


def shifts() -> np.ndarray:
    """The smallest shift that puts places of residues (a, b) on marks."""
    ahead = (np.arange(MODULUS)[:, None] + np.arange(MODULUS)) % MODULUS  # residue, shift
    on = MARKED[ahead] >= 0
    return np.argmax(on[:, None, :] & on[None, :, :], axis=2)


SHIFT = shifts()


class Extensions:
    """Longest common extensions of places of one array of words (numbers from 0 on)."""

    def __init__(self, words: np.ndarray):
        blocks = -(-len(words) // MODULUS) + 1
        top = int(words.max(initial=0)) + 1
        pad = top + np.arange((blocks + 1) * MODULUS - len(words))  # all different: nothing goes on past the end
        self.words = np.concatenate([words, pad]).astype(np.int64)
        self.marks = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        order, levels = self._sorted_marks()
        self.rank = levels[-1]
        self.table = [self._common(order[:-1], order[1:], levels).astype(np.int32)]
        while 2 << (len(self.table) - 1) <= len(self.table[0]):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def _sorted_marks(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Marks in the order of their suffixes, and their ranks by the first 31, 62, 124, ... words."""
        bits = int(self.words[-1]).bit_length()
        each = max(1, 63 // bits)
        columns = []
        for first in range(0, MODULUS, each):
            column = np.zeros(len(self.marks), np.int64)
            for k in range(first, min(first + each, MODULUS)):
                column = (column << bits) | self.words[self.marks + k]
            columns.append(column)
        order = np.lexsort(columns[::-1])
        levels = [self._ranked(order, columns)]
        step = len(COVER)
        while levels[-1].max(initial=0) < len(order) - 1:
            after = np.full(len(order), -1, np.int64)
            after[:-step] = levels[-1][step:]
            key = levels[-1] * (len(order) + 1) + after + 1
            order = np.argsort(key, kind="stable")
            levels.append(self._ranked(order, [key]))
            step *= 2
        return order, levels

    @staticmethod
    def _ranked(order: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        other = np.zeros(len(order), bool)
        for column in columns:
            in_order = column[order]
            other[1:] |= in_order[1:] != in_order[:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(other)
        return rank

    def _common(self, a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of the suffixes at marks a and b: by doubled ranks, the rest word by word."""
        a, b, common = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for level in range(len(levels) - 2, -1, -1):
            same = levels[level][a] == levels[level][b]
            a[same] += len(COVER) << level
            b[same] += len(COVER) << level
            common[same] += MODULUS << level
        live = np.arange(len(a))
        for k in range(MODULUS):
            live = live[self.words[self.marks[a[live]] + k] == self.words[self.marks[b[live]] + k]]
            common[live] += 1
        return common

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on; i and j differ."""
        found = np.zeros(len(i), np.int64)
        shift = SHIFT[i % MODULUS, j % MODULUS]
        live, ready = np.arange(len(i)), []
        for k in range(MODULUS):
            there = shift[live] == k
            ready.append(live[there])
            live = live[~there]
            same = self.words[i[live] + k] == self.words[j[live] + k]
            found[live[~same]] = k
            live = live[same]
            if not len(live):
                break
        at = np.concatenate(ready)
        if len(at):
            a, b = (self.rank[self._mark(x[at] + shift[at])] for x in (i, j))
            found[at] = shift[at] + self._smallest(np.minimum(a, b), np.maximum(a, b))
        return found

    @staticmethod
    def _mark(place: np.ndarray) -> np.ndarray:
        return place // MODULUS * len(COVER) + MARKED[place % MODULUS]

    def _smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            row = self.table[k]
            found[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return found


def grid(first: np.ndarray, sizes: np.ndarray):
    """(place, period) of the harmonic grids of all texts, some QUERIES_AT_A_TIME at a time, a text's period whole."""
    periods = np.where(sizes >= LEAST, sizes // TURNS, 0)
    text = np.repeat(np.arange(len(sizes)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    counts = -(-(sizes[text] - period) // (2 * period))
    slices = np.cumsum(counts) // QUERIES_AT_A_TIME
    edges = [0, *(np.flatnonzero(np.diff(slices)) + 1).tolist(), len(text)]
    for start, end in zip(edges, edges[1:]):
        if start < end:
            n, p = counts[start:end], period[start:end]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            p, base = np.repeat(p, n), np.repeat(first[text[start:end]], n)
            yield base + 2 * p * step, p, base


def runs_of(words: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, sorted. Texts begin at ``first`` and are followed by a word found nowhere else."""
    extensions = Extensions(words)
    found = []
    for i, p, base in grid(first, sizes):
        some = extensions.words[i] == extensions.words[i + p]
        i, p, base = i[some], p[some], base[some]
        ahead = extensions.lce(i, i + p)
        some = ahead > p
        i, p, base, end = i[some], p[some], base[some], (i + ahead)[some]
        order = np.lexsort((i, end, p))
        i, p, base, end = i[order], p[order], base[order], end[order]
        new = np.ones(len(i), bool)
        new[1:] = (p[1:] != p[:-1]) | (end[1:] != end[:-1])
        i, p, base, end = i[new], p[new], base[new], end[new]
        low, high = np.zeros(len(i), np.int64), np.minimum(2 * p - 1, i - base)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_] + 1) // 2
            at = i[open_] - middle
            reached = extensions.lce(at, at + p[open_]) >= middle
            low[open_[reached]] = middle[reached]
            high[open_[~reached]] = middle[~reached] - 1
        start = i - low
        length = end + p - start
        long_enough = length >= np.maximum(LEAST, TURNS * p)
        found.append(np.stack([start, length, p])[:, long_enough])
    start, length, period = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def values(batch: pa.RecordBatch) -> list[pa.Array]:
    column = batch.column("text")
    split = [t.split() for t in texts(column)]
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    numbered = [np.fromiter((number[w] for w in words), np.int64, len(words)) for words in split]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    first = np.cumsum(sizes + 1) - sizes - 1
    words = np.concatenate([part for n, ids in enumerate(numbered) for part in (ids, [len(number) + n])]).astype(np.int64)
    start, length, period = runs_of(words, first, sizes)
    text = np.searchsorted(first, start, "right") - 1
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    kept = np.cumsum(steps[:-1]) == 0
    edges = np.searchsorted(text, np.arange(len(split) + 1))
    collapsed = []
    for n, (tokens, missing) in enumerate(zip(split, column.is_null().to_pylist())):
        if edges[n] < edges[n + 1]:
            tokens = [w for w, k in zip(tokens, kept[first[n] : first[n] + sizes[n]].tolist()) if k]
        collapsed.append(None if missing else b" ".join(tokens))
    rows = pa.StructArray.from_arrays(
        [pa.array(x) for x in (start - first[text], length, period)], names=["start", "length", "period"]
    )
    runs = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rows)
    return [runs, pa.array(collapsed, pa.binary()).cast(pa.string())]


def find(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of docs), ``runs`` (start and length in words, period; sorted) and ``collapsed``."""
    return annotate(docs, values, RUNS)
