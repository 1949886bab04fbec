"""Sampled segmentation into the pieces of a SentencePiece vocabulary, and lossless decoding.

All ways to cut a text into pieces form a lattice: a node between characters, an edge for each piece. Forward filtering
sums the probabilities of all paths to each node; backward sampling then draws a path from the end, so a whole
segmentation comes with probability proportional to the product of its pieces' probabilities (to the power ``alpha``).
Draws depend on the row's key, the seed and the place in the text alone, so any run on any machine gives the same pieces.

A piece of the vocabulary counts as probable as its rank says: 1 / (rank + SHIFT). A character that is no piece is
written as its UTF-8 bytes, each as probable as the last piece. Pieces hold blanks only at their start (checked when the
vocabulary is read), so the lattice falls apart into words; a slice of rows shares one lattice for each distinct word,
and words are filtered and drawn together, array-wise, ``CHARACTERS`` of them at a time. Memory is bounded by the slice
and its longest text.

Defined results. A null text has null pieces, an empty text none. A blank is put before the text and taken off in
decoding. The character that stands for blanks in pieces is written as bytes where a text holds it. Rows with equal keys
and texts get equal pieces; a null key is a key of its own.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from shoptide.llm.common import annotate

BLANK = "▁"
# Stands for BLANK where the text has that character itself; no UTF-8 text holds a surrogate.
LITERAL = "\ud800"
WORD = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
SHIFT = 10
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
SLICE = 1 << 21
# Characters of distinct words that share a lattice; the words of a slice are done some at a time.
CHARACTERS = 1 << 18
# In place of a piece's number: no piece of that length ends there; a character that is no piece.
NONE, BYTES = 0xFFFF, 0xFFFE
# Bits of a hash by which most strings that are no piece are told apart without a search.
MAYBE = 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit numbers for 64-bit numbers."""
    x = (x + np.uint64(BASE)) & np.uint64(MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Vocabulary:
    """Plain arrays of a SentencePiece model's pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = np.full(256, -1, np.int64)
        self.text: list[bytes] = []
        normal: list[tuple[str, int, float]] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.text.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                normal.append((piece, i, max(0.0, -model.get_score(i))))
                self.text.append(piece.replace(BLANK, " ").encode())
        if model.get_piece_size() > BYTES:
            raise ValueError(f"more than {BYTES} pieces")
        if (self.bytes < 0).any() or any(BLANK in p.lstrip(BLANK) for p, _, _ in normal):
            raise ValueError("the vocabulary needs byte pieces, and blanks only where pieces begin")
        ranks = {i: n for n, (_, i, _) in enumerate(sorted(normal, key=lambda x: (x[2], x[1])))}
        shares = {i: 1 / (ranks[i] + SHIFT) for i in ranks}
        whole = sum(shares.values())
        self.least = float(np.log(1 / (len(ranks) + SHIFT) / whole))
        self.longest = max(len(p) for p, _, _ in normal)
        self.weights, self.hashes, self.ids, self.scores = powers(self.longest + 1), [], [], []
        for size in range(1, self.longest + 1):
            same = [(self.hash(p), i) for p, i, _ in normal if len(p) == size]
            same.sort()
            self.hashes.append(np.array([h for h, _ in same], np.uint64))
            self.ids.append(np.array([i for _, i in same], np.int64))
            self.scores.append(np.array([np.log(shares[i] / whole) for _, i in same], np.float32))
        self.maybe = np.zeros(1 << MAYBE, bool)
        for hashes in self.hashes:
            self.maybe[hashes >> np.uint64(64 - MAYBE)] = True

    def hash(self, piece: str) -> int:
        cp = mixed(code_points(piece).astype(np.uint64))
        return int((cp * self.weights[: len(cp)]).sum(dtype=np.uint64))


def powers(count: int, base: int = BASE) -> np.ndarray:
    factors = np.full(count, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors, out=factors)


INVERSE = pow(BASE, -1, 1 << 64)


def lattice(vocabulary: Vocabulary, words: list[str], alpha: float):
    """Nodes of all words: for each node and piece length, which piece ends there and how likely it is drawn (cumulative).

    Returns (first node and characters of each word, all characters, piece ids, cumulative shares). A node has a row,
    column L - 1 of it is for the piece of L characters.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    cp = code_points("".join(words))
    first_char = np.cumsum(sizes) - sizes
    base = first_char + np.arange(len(words))  # a node more than characters in each word
    word_of = np.repeat(np.arange(len(words)), sizes)
    inside = np.arange(len(cp)) - first_char[word_of]
    # Hash of characters s..s+L-1: sums of mixed(c) * BASE^k, by differences of running sums
    weight = powers(len(cp))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(cp.astype(np.uint64)) * weight, dtype=np.uint64)))
    unweight = powers(len(cp), INVERSE)
    nodes = len(cp) + len(words)
    longest = vocabulary.longest
    piece = np.full((nodes, longest), NONE, np.uint16)
    score = np.full((nodes, longest), -np.inf, np.float32)
    left = sizes[word_of] - inside
    for size in range(1, longest + 1):
        at = np.flatnonzero(left >= size)
        table = vocabulary.hashes[size - 1]
        if not len(at) or not len(table):
            continue
        value = (sums[at + size] - sums[at]) * unweight[at]
        some = np.flatnonzero(vocabulary.maybe[value >> np.uint64(64 - MAYBE)])
        at, value = at[some], value[some]
        found = np.minimum(np.searchsorted(table, value), len(table) - 1)
        hit = table[found] == value
        at, found = at[hit], found[hit]
        node = at + word_of[at] + size
        piece[node, size - 1], score[node, size - 1] = vocabulary.ids[size - 1][found], vocabulary.scores[size - 1][found]
    node = np.arange(len(cp)) + word_of + 1
    at = np.flatnonzero(piece[node, 0] == NONE)
    count = 1 + (cp[at] >= 0x80) + (cp[at] >= 0x800) + (cp[at] >= 0x10000)
    score[node[at], 0] = vocabulary.least * count
    piece[node[at], 0] = BYTES
    del weight, sums, unweight, left, inside
    score *= alpha
    total = np.full(nodes, -np.inf)
    total[base] = 0.0
    order = np.argsort(-sizes, kind="stable")
    by_size = -sizes[order]
    for i in range(1, int(sizes.max(initial=0)) + 1):
        here = base[order[: np.searchsorted(by_size, -i, side="right")]] + i
        reach = min(i, longest)
        ways = total[here[:, None] - np.arange(1, reach + 1)] + score[here, :reach]
        top = ways.max(axis=1)
        cumulative = np.cumsum(np.exp(ways - top[:, None]), axis=1)
        total[here] = top + np.log(cumulative[:, -1])
        score[here, :reach] = cumulative / cumulative[:, -1:]
        score[here, reach:] = 2.0
    return base, sizes, cp, piece, score


def draw_words(nodes, word: np.ndarray, start: np.ndarray, offset: np.ndarray, stream: np.ndarray, out: np.ndarray) -> None:
    """Draws the pieces of occurrences of words of a lattice, from their ends, into ``out`` at the places they begin."""
    base, sizes, cp, piece, shares = nodes
    at = sizes[word]
    alive = np.arange(len(word))
    while len(alive):
        node = base[word[alive]] + at[alive]
        place = (offset[alive] + at[alive]).astype(np.uint64)
        draw = (mixed(stream[alive] + place * np.uint64(BASE)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
        size = 1 + np.count_nonzero(shares[node] <= draw[:, None], axis=1)
        # rounding may leave the last share below 1, and edges that do not exist have a share of 0
        while (bad := piece[node, size - 1] == NONE).any():
            size[bad] -= 1
        at[alive] -= size
        found = piece[node, size - 1].astype(np.int32)
        alone = np.flatnonzero(found == BYTES)  # to be written as bytes
        found[alone] = -2 - cp[node[alone] - word[alive[alone]] - 1].astype(np.int32)
        out[start[alive] + at[alive]] = found
        alive = alive[at[alive] > 0]


def encode_texts(vocabulary: Vocabulary, texts: list[str | None], keys: np.ndarray, alpha: float, seed: int) -> list:
    """Piece ids of each text, None for None."""
    words: defaultdict[str, int] = defaultdict()
    words.default_factory = words.__len__
    occurrences: list[int] = []
    per_text: list[int] = []
    for text in texts:
        found = WORD.findall(BLANK + text.replace(BLANK, LITERAL).replace(" ", BLANK)) if text else []
        occurrences += map(words.__getitem__, found)
        per_text.append(len(found))
    if not occurrences:
        return [None if t is None else np.empty(0, np.int32) for t in texts]
    listed = list(words)
    sizes = np.fromiter(map(len, listed), np.int64, len(listed))
    word = np.array(occurrences, np.int64)
    text_of = np.repeat(np.arange(len(texts)), per_text)
    start = np.cumsum(sizes[word]) - sizes[word]  # of each occurrence, in the characters of the slice
    chars = np.bincount(text_of, weights=sizes[word], minlength=len(texts)).astype(np.int64)
    text_start = np.cumsum(chars) - chars
    stream = mixed(keys ^ np.uint64(seed & MASK))[text_of]
    out = np.full(int(chars.sum()), -1, np.int32)
    offset = start - text_start[text_of]
    edges = np.flatnonzero(np.diff(np.cumsum(sizes) // CHARACTERS)) + 1
    for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(listed)]):
        alive = np.flatnonzero((word >= low) & (word < high))
        draw_words(lattice(vocabulary, listed[low:high], alpha), word[alive] - low, start[alive], offset[alive], stream[alive], out)
    used = out != -1
    counts = np.add.reduceat(used, text_start[chars > 0]) if len(out) else np.empty(0, np.int64)
    flat = out[used].astype(np.int64)
    plain = (flat < -1) & (flat >= -2 - 0x7F)
    flat[plain] = vocabulary.bytes[-2 - flat[plain]]
    bounds = np.zeros(len(texts), np.int64)
    bounds[chars > 0] = counts
    ends = np.cumsum(bounds)
    result: list = []
    for i, text in enumerate(texts):
        part = flat[ends[i] - bounds[i] : ends[i]]
        if len(part) and part.min() < 0:
            part = np.concatenate([as_bytes(vocabulary, int(p)) if p < 0 else [p] for p in part.tolist()])
        result.append(None if text is None else part.astype(np.int32))
    return result


def as_bytes(vocabulary: Vocabulary, marked: int) -> np.ndarray:
    char = chr(-2 - marked)
    return vocabulary.bytes[list((BLANK if char == LITERAL else char).encode())]


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """The text of one row's pieces."""
    return b"".join(map(vocabulary.text.__getitem__, ids.tolist()))[1:].decode()


def shared(spark: SparkSession, model: str):
    """The vocabulary, of a bounded size, as plain values on the executors."""
    parts = spark.sparkContext.broadcast(Vocabulary(model).__dict__)

    def get() -> Vocabulary:
        vocabulary = object.__new__(Vocabulary)
        vocabulary.__dict__.update(parts.value)
        return vocabulary

    return get


def encode(docs: DataFrame, model: str, alpha: float = 1.0, seed: int = 0, check: bool = False) -> DataFrame:
    """``row`` (all columns of docs), ``ids`` and, if asked for, ``lossless``: whether decoding gives the text back."""
    get = shared(docs.sparkSession, model)

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        vocabulary, texts = get(), batch.column("text").to_pylist()
        keys = np.array([xxhash.xxh64_intdigest(str(k), seed=1) for k in batch.column("doc_id").to_pylist()], np.uint64)
        found = encode_texts(vocabulary, texts, keys, alpha, seed)
        out = [pa.array(found, pa.list_(pa.int32()))]
        if check:
            same = [None if t is None else decode_ids(vocabulary, f) == t for t, f in zip(texts, found)]
            out.append(pa.array(same, pa.bool_()))
        return out

    return annotate(docs, values, "ids array<int>" + ", lossless boolean" * check, at_a_time=SLICE)


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``row`` (all columns of ``encoded``, which has ``ids``) and ``decoded``."""
    get = shared(encoded.sparkSession, model)

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        vocabulary = get()
        found = [None if i is None else decode_ids(vocabulary, np.array(i, np.int64)) for i in batch.column("ids").to_pylist()]
        return [pa.array(found, pa.string())]

    return annotate(encoded, values, "decoded string")
