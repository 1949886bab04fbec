"""Ranked search over the inverted index, against plain scores."""

from __future__ import annotations

from collections import Counter
from math import floor, log

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.operators import relevance
from tests.conftest import rows

DOCS = [
    (1, "d1", "Red plate"), (2, "d1", "red red red plate"), (3, "d1", "a blue plate of a red kind, and much more besides"),
    (4, "d2", "red"), (5, "d2", "blue"), (6, "d2", None), (7, "d2", ""), (8, None, "red plate"), (9, "d2", "Red plate"),
]


def plain(docs, wanted, every):
    split = {k: "".join(c if c.isalnum() else " " for c in (t or "").lower()).split() for k, _, t in docs}
    mean = sum(map(len, split.values())) / len(split)
    found = {}
    for key, tokens in split.items():
        tf, score = Counter(tokens), 0.0
        for w in wanted:
            df = sum(w in t for t in split.values())
            if tf[w]:
                idf = log(1 + (len(split) - df + 0.5) / (df + 0.5))
                score += idf * tf[w] * 2.2 / (tf[w] + 1.2 * (0.25 + 0.75 * len(tokens) / mean))
        if all(tf[w] for w in wanted) if every else any(tf[w] for w in wanted):
            found[key] = floor(score * 1e6 + 0.5) / 1e6
    return sorted(found.items(), key=lambda x: (-x[1], x[0]))


@pytest.fixture
def index(spark, root):
    docs = spark.createDataFrame(DOCS, "id int, day string, body string")
    return relevance.TextIndex(root, "id", T.IntegerType(), buckets=4).build(docs, "body", F.col("day"))


@pytest.mark.parametrize("every", [True, False])
def test_scores_equal_plain_ones(spark, index, every):
    got = relevance.ranked(index.search(spark, "PLATE, red!", every=every), "id", 100)
    assert [tuple(r) for r in got.collect()] == plain(DOCS, ["plate", "red"], every)


def test_parts_are_searched_alone(spark, index):
    some = [d for d in DOCS if d[1] == "d1"]
    got = relevance.ranked(index.search(spark, "red", ["d1"]), "id", 100)
    assert [tuple(r) for r in got.collect()] == plain(some, ["red"], True)


def test_pages_go_on_after_the_last_hit(spark, index):
    whole = [tuple(r) for r in relevance.ranked(index.search(spark, "red"), "id", 100).collect()]
    pages, after = [], None
    while got := [tuple(r) for r in relevance.ranked(index.search(spark, "red"), "id", 2, after).collect()]:
        pages += got
        after = (got[-1][1], got[-1][0])
    assert pages == whole and len(whole) == 6


@pytest.mark.parametrize("keyword", ["", " ,; ", "unheard", "red unheard"])
def test_keywords_without_hits(spark, index, keyword):
    assert index.search(spark, keyword).count() == 0


def test_only_folders_of_the_keyword_are_opened(spark, index):
    postings = index._read(spark, "postings", ["d1"], ["red"])
    scan = postings._jdf.queryExecution().executedPlan().toString()
    filters = scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "part" in filters and "bucket" in filters and "EqualTo(term,red)" in scan
    read = postings.select(F.input_file_name().alias("file")).distinct().collect()
    assert read and all("/postings/part=d1/" in r.file for r in read)


def test_a_part_that_is_built_again_is_replaced(spark, index):
    again = spark.createDataFrame([(10, "d1", "green plate")], "id int, day string, body string")
    index.build(again, "body", F.col("day"))
    assert rows(index.search(spark, "plate", ["d1"]), "id") == [(10,)]
    kept = [d for d in DOCS if d[1] != "d1"] + [(10, "d1", "green plate")]
    got = relevance.ranked(index.search(spark, "plate"), "id", 100)
    assert [tuple(r) for r in got.collect()] == plain(kept, ["plate"], True)


def test_no_documents(spark, root):
    none = spark.createDataFrame([], "id int, body string")
    index = relevance.TextIndex(root, "id", T.IntegerType()).build(none, "body")
    assert index.search(spark, "red").count() == 0


def test_a_document_is_counted_where_its_text_is(spark, root):
    """Texts are shuffled once; repeated rows of a key count as one longer text only where they are as long."""
    docs = spark.createDataFrame([(1, "a b a"), (1, "b b c"), (1, "a"), (None, "a"), (None, "b"), (2, "")], "id int, body string")
    relevance.TextIndex(root, "id", T.IntegerType(), buckets=2).build(docs, "body")
    found = rows(spark.read.parquet(f"{root}/postings"), "id", "length", "term", "tf")
    want = [(1, 3, "a", 2), (1, 3, "b", 3), (1, 3, "c", 1), (1, 1, "a", 1), (None, 1, "a", 1), (None, 1, "b", 1)]
    assert found == sorted(want, key=repr)
    runs = spark.createDataFrame([(["a", "a", "b"],), (["z"],)], "w array<string>").select(F.inline(relevance._runs("w")))
    assert rows(runs) == [("a", 2), ("b", 1), ("z", 1)]
