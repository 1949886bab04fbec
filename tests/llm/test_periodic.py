"""Runs of repeated words, against plain search."""

from __future__ import annotations

import random
from fractions import Fraction
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from shoptide.llm import periodic, queries
from shoptide.llm.common import unpacked
from tests.conftest import SF_DIR
from tests.llm.data import documents, empty, odd


def plain_runs(words):
    """All runs by comparing the words at every distance."""
    ids = np.unique(np.array(words, object), return_inverse=True)[1] if words else np.empty(0, int)
    found = {}
    for p in range(1, len(words) // 4 + 1):
        same = np.concatenate(([0], ids[p:] == ids[:-p], [0])).astype(int)
        edges = np.flatnonzero(np.diff(same))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start + p >= max(6, 4 * p):
                found.setdefault((start, end - start + p), p)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found_in(texts):
    runs, collapsed = periodic.values(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]))
    return [[tuple(r.values()) for r in x] for x in runs.to_pylist()], collapsed.to_pylist()


def test_cover_meets_at_every_distance():
    assert {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER} == set(range(periodic.MODULUS))


def test_extensions_equal_plain_comparison():
    random.seed(3)
    words = np.array([random.randrange(2) for _ in range(50)] * 4 + [7] * 70 + list(range(10, 90)))
    extensions = periodic.Extensions(words)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    i, j = i[i != j], j[i != j]
    got = extensions.lce(i, j)
    for a, b, n in zip(i[::37].tolist(), j[::37].tolist(), got[::37].tolist()):
        most = len(words) - max(a, b)
        differ = np.flatnonzero(words[a : a + most] != words[b : b + most])
        assert n == (differ[0] if len(differ) else most)


def test_runs_equal_plain_search():
    random.seed(11)
    texts = []
    for _ in range(400):
        n, kinds = random.choice([0, 1, 5, 6, 7, 8, 13, 60, 300]), random.choice([1, 2, 3, 30])
        words = [f"w{random.randrange(kinds)}" for _ in range(n)]
        if n > 10 and random.random() < 0.7:
            a = random.randrange(n)
            p = 1 + (n - a) // random.randrange(3, 10)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        texts.append(" ".join(words))
    runs, collapsed = found_in(texts)
    assert sum(map(len, runs)) > 100
    for text, r, c in zip(texts, runs, collapsed):
        assert r == plain_runs(text.split()) and c == plain_collapsed(text.split(), r)


@pytest.mark.parametrize(
    "text, want",
    [
        ("a a a a a a", [(0, 6, 1)]),
        ("a a a a a", []),
        ("a b a b a b a b", [(0, 8, 2)]),
        ("a b a b a b a", []),
        ("x a b a b a b a b a y", [(1, 9, 2)]),
        (" ".join("aab" * 4), [(0, 12, 3)]),
        (" ".join("a" * 8 + "b" * 6), [(0, 8, 1), (8, 6, 1)]),
        (" ".join("aaaaaab" * 4), [(0, 6, 1), (0, 28, 7), (7, 6, 1), (14, 6, 1), (21, 6, 1)]),
    ],
)
def test_runs_by_hand(text, want):
    assert found_in([text])[0] == [want]


def test_long_texts():
    runs, collapsed = found_in(["a b c " * 200_000, " ".join(f"w{i % 70001}" for i in range(300_000))])
    assert runs == [[(0, 600_000, 3)], [(0, 300_000, 70001)]]
    assert collapsed[0] == "a b c" and len(collapsed[1].split()) == 70001


def test_odd_rows(spark):
    rows = odd(spark)
    found = periodic.find(rows)
    assert unpacked(rows, found).columns == rows.columns
    got = {(r[0], r[1]): (len(r[2]), r[3]) for r in found.select("row.doc_id", "row.text", "runs", "collapsed").collect()}
    assert got[1, None] == (0, None) and got[2, ""] == (0, "") and got[3, " \t\n "] == (0, "")
    assert got[4, "word"] == (0, "word") and found.count() == rows.count()
    long = next(v for (i, _), v in got.items() if i == 7)
    assert long == (1, "lorem ipsum dolor sit amet")
    assert periodic.find(empty(spark)).count() == 0
    twice = periodic.find(documents(spark, [(1, "a " * 9), (1, "a " * 9)])).select("collapsed").collect()
    assert [r[0] for r in twice] == ["a", "a"]


def test_query_equals_plain_python(spark):
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    several = 0
    for doc_id, text in docs:
        words = (text or "").split()
        h = crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        several += len(runs) > 0
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        r = got[doc_id]
        assert (r.n_runs, r.start, r["length"], r.period, r.exponent_milli) == (len(runs), *want)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r.runs_sha256 == sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == sha256(plain_collapsed(words, runs).encode()).hexdigest()
    assert several > 10
