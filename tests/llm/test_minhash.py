"""Near duplicates over the MinHash forest, against comparing all sets."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from shoptide.llm import minhash
from shoptide.llm.common import words
from shoptide.llm.simhash import shingle_hashes
from tests.llm.data import documents, empty, odd


def shingles(text, width=3):
    tokens = words((text or "").encode())
    if not tokens:
        return frozenset()
    return frozenset(tuple(tokens[i : i + width]) for i in range(max(1, len(tokens) - width + 1)))


def plain(rows, percent=85, width=3):
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if sets[i] and doc_id is not None:
            ids[top(i)] = min(doc_id, ids.get(top(i), doc_id))
    found = [(d, len(s), ids.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    return sorted(found, key=repr)


def found(spark, rows, **options):
    got = minhash.near_duplicates(documents(spark, rows), **options).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=repr)


def edited(random_, base, share):
    return [f"x{random_.randrange(10**9)}" if random_.random() < share else w for w in base]


def test_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in odd(spark).collect()]
    rows += [(20, "two words"), (21, "TWO words"), (22, "É two"), (23, "é two"), (24, ""), (None, "two words")]
    assert found(spark, rows) == plain(rows)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_links_at_the_limit(spark):
    """Sets that share exactly 85 of 100 link, sets that share a shingle less do not."""
    rows = []
    for n in range(40):
        common = [f"c{n}.{i}" for i in range(87)]  # 85 shingles
        for k, extra in enumerate((8, 7)):  # 85 + 8 + 7 shingles in all
            rows.append((10 * n + k, " ".join(common + [f"e{n}.{k}.{i}" for i in range(extra)])))
        rows.append((10 * n + 5, " ".join([f"f{n}.{i}" for i in range(87)] + [f"g{n}.{i}" for i in range(8)])))
        rows.append((10 * n + 6, " ".join([f"f{n}.{i}" for i in range(87)] + [f"h{n}.{i}" for i in range(8)])))
    got = found(spark, rows)
    assert got == plain(rows)
    assert {d: c for d, _, c in got}[1] == 0 and {d: c for d, _, c in got}[6] == 6


def test_groups_of_copies_and_near_copies(spark, monkeypatch):
    """A hot group of near copies, regions and classes in several chunks, chains, copies and boilerplate."""
    monkeypatch.setattr(minhash, "CROWD", 8)
    monkeypatch.setattr(minhash, "CHUNK_NODES", 16)
    monkeypatch.setattr(minhash, "CHUNK_SETS", 10)
    random_ = random.Random(4)
    base = [f"w{random_.randrange(3000)}" for _ in range(120)]
    rows = [(i, " ".join(edited(random_, base, random_.choice([0.0, 0.01, 0.02, 0.04])))) for i in range(120)]
    rows += [(1000 + i, " ".join(base)) for i in range(60)]
    chain = [f"v{i}" for i in range(400)]
    rows += [(2000 + i, " ".join(chain[6 * i : 6 * i + 100])) for i in range(40)]
    frame = [f"frame{i}" for i in range(70)]
    rows += [(3000 + i, " ".join(frame + [f"b{i}.{k}" for k in range(40)])) for i in range(60)]
    got = found(spark, rows)
    assert got == plain(rows)
    assert len({c for d, _, c in got if 2000 <= d < 3000}) == 1 and len({c for d, _, c in got if d >= 3000}) == 60


def test_set_links_equal_plain_comparison():
    random_ = random.Random(8)
    texts = []
    for _ in range(12):
        base = [f"w{random_.randrange(40)}" for _ in range(random_.randrange(3, 80))]
        texts += [" ".join(edited(random_, base, 0.03)) for _ in range(6)]
    sets = [np.unique(shingle_hashes(t.encode(), 3)) for t in texts]
    u, v = minhash.set_links(np.arange(len(sets)), sets, 85)
    root = np.arange(len(sets))
    minhash.merge(root, u, v)
    want = plain(list(enumerate(texts)))
    assert [c for _, _, c in sorted(want)] == root.tolist()


def test_signatures_estimate_similarity():
    one, two = (np.unique(shingle_hashes(" ".join(f"w{i}" for i in range(a, a + 1000)).encode(), 3)) for a in (0, 80))
    shared = np.frombuffer(minhash.signature(one), ">u2") == np.frombuffer(minhash.signature(two), ">u2")
    similarity = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
    assert abs(shared.mean() - similarity) < 0.08
    assert minhash.signature(np.empty(0, np.uint64)) == b""


def test_region_links_join_neighbours_and_the_rest():
    random_ = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(edited(random_, base, 0.01)) for _ in range(20)] + [" ".join(f"z{n}.{i}" for i in range(200)) for n in range(20)]
    sets = [np.unique(shingle_hashes(t.encode(), 3)) for t in texts]
    columns = [pa.array([5] * 40), pa.array([3] * 40, pa.int32()), pa.array(range(40)), pa.array(map(minhash.signature, sets), pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, names=["part", "tree", "node", "signature"])
    (out,) = minhash.region_links(iter([batch]), 170)
    root = np.arange(40)
    minhash.merge(root, out.column("u").to_numpy(), out.column("v").to_numpy())
    assert out.num_rows == 19 and root.tolist() == [0] * 20 + list(range(20, 40))
