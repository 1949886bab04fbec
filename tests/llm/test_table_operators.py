"""SimHash classes, top-k, shards, quality and language-model scores, against plain Python."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from math import log10
from zlib import crc32

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from shoptide.llm import arrays, binpack, bitsliced, cotrain, ngram_lm, queries, simhash
from shoptide.llm.common import hash_bound, sampled, stored
from tests.conftest import SF_DIR
from tests.llm.data import documents, empty, odd


def given(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


# SimHash


def plain_fingerprint(text, width):
    found = (text or "").encode().lower().split()
    shingles = [b" ".join(found[i : i + width]) for i in range(max(1, len(found) - width + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(fps, limit):
    low = np.arange(len(fps))
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps) <= limit
    while True:
        new = np.array([low[n].min() for n in near])
        if (new == low).all():
            return low
        low = new


def test_components_equal_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in given(spark, "documents").collect())
    fps = [plain_fingerprint(t, 3) for _, t in docs]
    low = plain_classes(fps, 3)
    want = {d: (f"{f:016x}", docs[c][0]) for (d, _), f, c in zip(docs, fps, low)}
    got = {r[0]: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, SF_DIR).collect()}
    assert got == want


@pytest.mark.parametrize("limit, half", [(3, 512), (3, 8), (6, 32), (10, 64)])
def test_links_of_a_dense_cluster(spark, limit, half):
    """Many fingerprints around a few centres, so that groups are hot and are cut into chunks."""
    draw = np.random.default_rng(limit)
    centres = draw.integers(0, 1 << 63, 4, dtype=np.uint64)
    fps = set(draw.integers(0, 1 << 63, 200, dtype=np.uint64).tolist())
    for _ in range(300):
        bits = draw.choice(64, draw.integers(0, limit + 3), replace=False)
        fps.add(int(centres[draw.integers(4)]) ^ sum(1 << int(b) for b in bits))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    root = {r.u: r.v for r in simhash.stars(simhash.linked(nodes, limit, half=half)).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for f, c in zip(signed, plain_classes(fps, limit)):
        groups[root.get(f, f)].add(f)
        want[c].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("r", [1, 2, 3])
@pytest.mark.parametrize("limit", [3, 10])
def test_blocks_cover_all_bits_and_every_pair_shares_one(limit, r):
    masks = [m % (1 << 64) for m in simhash.block_masks(limit, r)]
    assert np.bitwise_or.reduce(np.array(masks, np.uint64)) == np.uint64((1 << 64) - 1)
    draw = np.random.default_rng(0)
    for _ in range(200):
        error = sum(1 << int(b) for b in draw.choice(64, limit, replace=False))
        assert any(not error & m for m in masks)


def test_stars_of_a_long_path(spark):
    n = 60
    links = spark.createDataFrame([(i + 1, i) for i in range(n)], "u long, v long")
    assert sorted((r.u, r.v) for r in simhash.stars(links).collect()) == [(i, 0) for i in range(1, n + 1)]


def test_simhash_odd_rows(spark):
    got = simhash.near_duplicates(odd(spark)).collect()
    assert len(got) == odd(spark).count()
    zero = {r.doc_id: r.component_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {None: 1, 1: 1, 2: 1, 3: 1}
    assert simhash.near_duplicates(empty(spark)).count() == 0
    nameless = documents(spark, [(None, "no id at all"), (None, "no id at all")])
    assert [r.component_id for r in simhash.near_duplicates(nameless).collect()] == [None, None]
    assert simhash.one_of_each(nameless).count() == 1


def test_one_of_each_class_stays(spark):
    text = [f"word{i * i}" for i in range(400)]
    near = [*text[:200], "changed", *text[201:]]
    rows = documents(spark, [(5, " ".join(text)), (3, " ".join(near)), (9, " ".join(text)), (9, " ".join(text)), (8, "short")])
    ids = {r.doc_id: r.component_id for r in simhash.near_duplicates(rows).collect()}
    assert ids[5] == ids[9]
    got = simhash.one_of_each(rows)
    assert got.columns == rows.columns and sorted(r.doc_id for r in got.collect()) == sorted(set(ids.values()))
    twice = documents(spark, [(1, "some text"), (1, "some text"), (1, "quite another one"), (2, "some text"), (None, "without an id")])
    assert sorted((r.doc_id or 0, r.text) for r in simhash.one_of_each(twice).collect()) == [
        (0, "without an id"), (1, "quite another one"), (1, "some text"),
    ]
    kept = simhash.one_of_each(odd(spark))
    assert kept.where("doc_id = 6").count() == 2 and kept.where("doc_id = 5").count() == 1
    assert simhash.one_of_each(empty(spark)).count() == 0


def test_one_of_each_equals_brute_force(spark):
    """Edited copies of a few texts, so that classes are chains."""
    draw = np.random.default_rng(4)
    texts = [[f"w{x}" for x in draw.integers(1 << 40, size=400)] for _ in range(4)]
    for _ in range(150):
        new = list(texts[draw.integers(len(texts))])
        new[draw.integers(len(new))] = f"w{draw.integers(1 << 40)}"
        texts.append(new)
    fps = [plain_fingerprint(" ".join(t), 3) for t in texts]
    near = np.array([[(a ^ b).bit_count() <= 3 for b in fps] for a in fps])
    low = np.arange(len(fps))
    while not ((new := np.array([low[n].min() for n in near])) == low).all():
        low = new
    rows = documents(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    assert 4 <= len(set(low.tolist())) < 100
    assert sorted(r.doc_id for r in simhash.one_of_each(rows).collect()) == sorted(set(low.tolist()))


# Top-k


def plain_top(rows, is_query, k, scale=256):
    usable = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, w in usable:
        if is_query(q):
            scores = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in usable if i != q)
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_topk_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in given(spark, "embeddings").collect()]
    got = sorted(tuple(r) for r in queries.op1_topk(spark, SF_DIR).select("query_id", "rank", "vec_id", "score").collect())
    assert got == plain_top(rows, lambda i: i % 50 == 0, 5)


def test_topk_equals_its_sql(spark):
    got = queries.op1_topk(spark, SF_DIR)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    cursor = duck.execute(queries.ORACLES["op1_topk"])
    assert [d[0] for d in cursor.description] == got.columns
    assert sorted(cursor.fetchall()) == sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("spread, bits, block", [(0.5, 12, 40), (0.5, 3, 64), (300.0, 6, 1000), (0.005, 12, 7)])
def test_topk_with_ties_wide_values_and_few_bits(spark, spread, bits, block):
    draw = np.random.default_rng(2)
    rows = [(i, (spread * draw.standard_normal(6)).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]  # equal vectors
    rows += [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (2004, [0.0] * 6)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("rank", F.lit(1))
    got = bitsliced.search(table, F.col("vec_id") % 10 == 0, k=4, block=block, bits=bits, chunk=5)
    assert sorted(tuple(r) for r in got.collect()) == plain_top(rows, lambda i: i % 10 == 0, 4)


def test_topk_of_values_as_they_are(spark):
    """Components are not cut off: 70,000 times 256 is beyond 24 bits, 1,000,000 times 256 too."""
    draw = np.random.default_rng(6)
    rows = [(i, [float(x) for x in draw.choice([70_000.0, -70_000.5, 1e6, -1e6, 0.25, 3.0], 3)]) for i in range(120)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = bitsliced.search(table, F.col("vec_id") % 10 == 0, k=5, block=50)
    assert sorted(tuple(r) for r in got.collect()) == plain_top(rows, lambda i: i % 10 == 0, 5)
    assert bitsliced.quantised(pa.array([[70_000.0]]), 256.0).tolist() == [[17_920_000]]


def test_samples_do_not_vanish_in_large_tables(spark):
    for count in (10, 10**5, 10**9, 10**11, 10**15):
        share = hash_bound(2000, count) / 2**63
        assert abs(share - min(1, 2000 / count)) < 1e-6 * min(1, 2000 / count) + 2**-60
    ids = spark.range(200_000).withColumnRenamed("id", "doc_id")
    assert abs(ids.where(sampled(2000, 200_000)).count() - 2000) < 300
    assert ids.where(sampled(200_000, 200_000)).count() == 200_000


def test_topk_of_few_or_no_rows(spark):
    table = spark.createDataFrame([(50, [1.0, 2.0]), (50, [1.0, 2.0]), (51, [3.0, 4.0])], "vec_id long, embedding array<double>")
    got = bitsliced.search(table, F.col("vec_id") == 50).collect()
    assert [tuple(r) for r in got] == [(50, 1, 51, 256 * 256 * 11)]
    assert bitsliced.search(table.limit(0), F.col("vec_id") == 50).count() == 0


# Shards


def plain_best_fit(sizes, capacity):
    bins = []
    for s in sizes:
        fits = [(left, b) for b, left in enumerate(bins) if left >= s]
        if not fits:
            bins.append(max(capacity, s))
            fits = [(bins[-1], len(bins) - 1)]
        bins[min(fits)[1]] -= s
        yield min(fits)[1]


@pytest.mark.parametrize("seed", range(5))
def test_tree_packs_like_a_plain_search(seed):
    sizes = sorted(np.random.default_rng(seed).integers(1, 60, 200).tolist(), reverse=True)
    assert binpack.pack(sizes, 64) == list(plain_best_fit(sizes, 64))


def test_shards_of_documents(spark):
    got = queries.op3_shards(spark, SF_DIR).toPandas()
    text = {r.doc_id: r.text.encode() for r in given(spark, "documents").collect()}
    assert sorted(got.doc_id) == sorted(text)
    assert all(s == len(text[d]) + 1 and c == crc32(text[d]) for d, s, c in zip(got.doc_id, got["size"], got.text_crc32))
    for _, rows in got.groupby("shard"):
        assert sorted(rows.slot) == list(range(len(rows)))
    got["text"] = got.doc_id.map(text)
    assert (got.groupby("text").shard.nunique() == 1).all()
    sums = got.groupby("shard")["size"].sum()
    assert set(sums.index) == set(range(16)) and sums.max() - sums.min() <= 0.05 * sums.mean()


def test_shards_split_a_group_no_shard_can_hold(spark):
    rows = documents(spark, [(i, "the same text") for i in range(400)] + [(1000 + i, f"text {i}") for i in range(400)])
    sums = binpack.shards(rows, 4).groupBy("shard").agg(F.sum("size").alias("n")).toPandas().n
    assert len(sums) == 4 and sums.max() <= 1.15 * sums.mean()


def test_shards_odd_rows(spark):
    got = binpack.shards(odd(spark), 3).collect()
    assert len(got) == odd(spark).count()
    assert all((r.size, r.text_crc32) == (1, None) for r in got if r.doc_id == 1)
    assert all((r.size, r.text_crc32) == (1, 0) for r in got if r.doc_id == 2)
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert binpack.shards(empty(spark)).count() == 0


# Quality


def test_quality_of_labels_left_out(spark):
    """Labels of every third document are hidden from training."""
    docs, labels = given(spark, "documents"), given(spark, "labels").select("doc_id", "quality")
    model = cotrain.train(docs, labels.where("doc_id % 3 <> 0"))
    found = cotrain.score(docs, model).select("row.doc_id", "score", "text_score", "meta_score").join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    assert len(found) > 15 and found.score.between(0, 1).all()
    assert ((found.score >= 0.5) == (found.quality == 1)).mean() >= 0.9
    assert cotrain.score(odd(spark), model).count() == odd(spark).count()
    assert cotrain.score(empty(spark), model).count() == 0


def test_labels_of_a_rare_class_are_all_taken(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") < 4990).cast("int").alias("quality"))
    chosen, prior = cotrain.labelled_sample(labels, 400)
    counts = dict(chosen.groupBy("label").count().collect())
    assert prior == 0.998 and counts[0.0] == 10 and 150 < counts[1.0] < 250


def test_the_surest_texts_come_from_all_rows_and_once(spark):
    rows = [(i, i, (i - 500) / 10.0, 0.0) for i in range(1000)] + [(2000, 2000, 49.9, 5.0), (1999, 1999, 49.9, -5.0)]
    odds = spark.createDataFrame(rows, "doc_id long, text_hash long, text_view double, meta_view double")
    got = [(r.doc_id, r.label) for r in cotrain.surest(odds, "text_view", 2).orderBy("doc_id").collect()]
    assert got == [(0, 0.0), (1, 0.0), (999, 1.0), (1999, 1.0)]
    assert [(r.doc_id, r.label) for r in cotrain.surest(odds, "meta_view", 9).orderBy("doc_id").collect()] == [(1999, 0.0), (2000, 1.0)]


def test_views_learn_from_each_other(spark):
    """Labels know one word and one source of either class; other words are only seen together with the other view."""
    def text(i, good, known):
        return " ".join([("fine" if good else "poor") if known else ("neat" if good else "vile"), f"w{i % 7}", f"v{i % 5}"] * 3)

    rows = [(i, text(i, i % 2, i < 400), "en", f"s{i % 2}", 10) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    labels = docs.where("doc_id < 400").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    alone, both = (cotrain.train(docs, labels, rounds=n, grow=50) for n in (0, 2))

    def text_right(model):
        found = cotrain.score(docs.where("doc_id >= 400"), model).select("row.doc_id", "text_score").toPandas()
        return ((found.text_score > 0.5) == (found.doc_id % 2 == 1)).mean()

    assert text_right(alone) < 0.7 and text_right(both) == 1.0


def test_unlabelled_texts_are_scored_once_and_not_shuffled(spark, monkeypatch):
    rows = [(i, f"{'fine' if i % 2 else 'poor'} w{i % 60}", "en", f"s{i % 2}", 10) for i in range(300)] + [(None, "no id", "en", "s0", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    labels = spark.createDataFrame([(i, i % 2 if i < 100 else None) for i in range(110)], "doc_id long, quality int")
    seen = []

    def watched(df, name):
        if name == "odds":
            seen.append((spark._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted"), df))
        return stored(df, name)

    monkeypatch.setattr(cotrain, "stored", watched)
    broadcasts = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cotrain.train(docs, labels, rounds=1, grow=5)
        (plan, odds), = seen
        got = sorted(r.doc_id for r in odds.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    first = {}
    for i, text, *_ in rows[100:-1]:
        first.setdefault(text, i)
    assert got == sorted(first.values())
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert len(shuffled) >= 3 and not re.search(r"\b(text|row)#", " ".join(shuffled))


def test_quality_without_both_classes(spark):
    for labels, share in (([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, None)], 0.5)):
        model = cotrain.train(odd(spark), spark.createDataFrame(labels, "doc_id long, quality int"))
        assert {r.score for r in cotrain.score(odd(spark), model).collect()} == {share}


# Language model


def plain_model(texts):
    """Interpolated modified Kneser-Ney bigrams over words, with one end to each text."""
    bigrams, words_ = Counter(), Counter()
    for t in texts:
        tokens = [*(t or "").encode().lower().split(), None]
        words_.update(tokens)
        bigrams.update(zip([b"<s>", *tokens], tokens))

    def level(counts):
        once = [sum(c == j for c in counts.values()) for j in (1, 2, 3, 4)]
        d = [0.5, 1.0, 1.5]
        if all(once):
            y = once[0] / (once[0] + 2 * once[1])
            d = [min(max(j - (j + 1) * y * once[j] / once[j - 1], 0), j) for j in (1, 2, 3)]
        rest = defaultdict(lambda: [0, 0.0])
        for gram, c in counts.items():
            rest[gram[:-1]][0] += c
            rest[gram[:-1]][1] += d[min(c, 3) - 1]
        return counts, d, rest

    high = level(bigrams)
    low = level(Counter((w,) for _, w in bigrams))

    def p(gram, levels, uniform):
        if not levels:
            return uniform
        (counts, d, rest), below = levels[0], p(gram[1:], levels[1:], uniform)
        total, held = rest.get(gram[:-1], (0, 0))
        if not total:
            return below
        c = counts.get(gram, 0)
        return (max(c - (d[min(c, 3) - 1] if c else 0), 0) + held * below) / total

    n, v = sum(words_.values()), len(words_)

    def score(t):
        tokens = [*(t or "").encode().lower().split(), None]
        full = sum(log10(p(g, [high, low], 1 / (v + 1))) for g in zip([b"<s>", *tokens], tokens))
        base = sum(log10((words_[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        return len(tokens), sum(words_[w] > 0 for w in tokens), base, full

    return n, score


def test_scores_equal_a_plain_model(spark):
    texts = {r.doc_id: r.text for r in given(spark, "documents").collect()}
    n, score = plain_model([t for d, t in texts.items() if crc32(str(d).encode()) % 5 != 1])
    got = queries.op10_lm_score(spark, SF_DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        tokens, known, base, full = score(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, n, crc32(str(r.doc_id).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(full)


def test_hot_contexts_and_many_buckets_change_nothing(spark, monkeypatch):
    """Words shared by all texts, packets of a few tokens."""
    texts = [f"the of the a{i} of the b{i % 7} the of" for i in range(40)] + [None, ""]
    rows = documents(spark, list(enumerate(texts)))
    monkeypatch.setattr(ngram_lm, "AT_A_TIME", 16)
    got = ngram_lm.score(rows, ngram_lm.train(rows.repartition(5))).select("row.doc_id", "score").collect()
    _, score = plain_model(texts)
    assert all(r.score == pytest.approx(score(texts[r.doc_id])[3]) for r in got)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_add_up_to_one(spark, order):
    texts = ["a b c a b d", "b c a", "d d a b", "c"]
    model = ngram_lm.train(documents(spark, list(enumerate(texts))), order=order)
    look = ngram_lm.Reader(model)
    words_ = np.concatenate([ngram_lm.token_hashes(w)[:1] for w in (b"a", b"b", b"c", b"d")] + [[ngram_lm.END]])
    new = ngram_lm.token_hashes(b"unseen")[:1]
    for context in ([words_[0]] * (order - 1), [ngram_lm.START] * (order - 1), [new[0]] * (order - 1)):
        grams = np.array([[*context, w] for w in np.append(words_, new)], np.uint64).reshape(-1, order)
        assert look.probabilities(grams).sum() == pytest.approx(1)


def test_scores_of_odd_and_empty_tables(spark):
    model = ngram_lm.train(odd(spark))
    assert ngram_lm.score(odd(spark), model).where("score <= 0").count() == odd(spark).count()
    assert ngram_lm.score(empty(spark), model).count() == 0
    nothing = ngram_lm.score(odd(spark), ngram_lm.train(empty(spark))).select("score", "base_score", "n_known").distinct().collect()
    assert [tuple(r) for r in nothing] == [(0.0, 0.0, 0)]


def test_arrays_are_mapped(tmp_path):
    arrays.save(f"file://{tmp_path}/a/b.npy", np.arange(1000))
    got = arrays.load(f"file://{tmp_path}/a/b.npy")
    assert isinstance(got, np.memmap) and (got == np.arange(1000)).all()
    at, hit = arrays.find(got, np.array([5, 2000]))
    assert at[0] == 5 and hit.tolist() == [True, False]
