"""Spelling variants over variable-length grams, against plain comparison, and the SQL of the new queries."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb
import pytest

from shoptide.llm import queries, spelling
from tests.conftest import SF_DIR
from tests.llm.data import documents, empty, odd


def edits(word, letters):
    for i in range(len(word) + 1):
        yield from (word[:i] + x + word[i:] for x in letters)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + x + word[i + 1 :] for x in letters)


def plain_variants(counts, ratio=10):
    letters = sorted(set("".join(counts)))
    forms, rows = {}, {}
    for word, n in counts.items():
        near = {e for e in edits(word, letters) if e in counts and e != word}
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= ratio * n else None
        rows[word] = (n, len(near))
    found = []
    for word, (n, near) in rows.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        form = forms[word]
        found.append((word, form, root, n, near, None if form is None else counts[form]))
    return sorted(found)


def found(spark, counts):
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(table).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(tuple(r) for r in got)


def vocabulary(random_, size, letters="abcdé", longest=12):
    words = {}
    while len(words) < size:
        word = "".join(random_.choice(letters) for _ in range(random_.randrange(7, longest)))
        words[word] = random_.choice([2, 3, 30, 400])
        for edited in random_.sample(sorted(set(edits(word, letters))), 4):
            if len(edited) >= 7:
                words.setdefault(edited, random_.choice([2, 3, 40]))
    return words


def test_an_edit_leaves_all_but_the_bound():
    random_ = random.Random(1)
    words = vocabulary(random_, 300)
    counts = {}
    for word in words:
        for n in range(2, 6):
            for i in range(len(word) - n + 1):
                counts[word[i : i + n]] = counts.get(word[i : i + n], 0) + 1
    grams = {g for g in counts if len(g) == 2 or counts[g[:-1]] > 8 and counts[g] >= 2}
    assert any(len(g) == 5 for g in grams)
    stems = spelling.stems_of(grams)
    for word in words:
        picked = spelling.decompose(word, grams)
        most = spelling.touched(word, picked, stems)
        assert len(picked) == len(word) - 1 > most
        for edited in edits(word, "abé"):
            if edited != word:
                left = spelling.decompose(edited, grams)
                shared = sum(min(picked.count(g), left.count(g)) for g in set(picked))
                assert shared >= len(picked) - most


def test_variants_equal_plain_comparison(spark, monkeypatch):
    monkeypatch.setattr(spelling, "CROWD", 4)
    counts = vocabulary(random.Random(5), 400)
    counts |= {"aaaaaaa": 5, "aaaaaaaa": 60, "aaaaaaaaa": 700, "aaaaaaaab": 7000, "ÿÿÿÿÿÿÿ": 2, "ÿÿÿÿÿÿÿa": 20, "ÿÿÿÿÿÿÿb": 20}
    got = found(spark, counts)
    assert got == plain_variants(counts)
    by_word = {r[0]: r for r in got}
    assert by_word["ÿÿÿÿÿÿÿ"][1] == "ÿÿÿÿÿÿÿa"  # of equal ones the first in code-point order
    assert by_word["aaaaaaa"][1:3] == ("aaaaaaaa", "aaaaaaaab")  # a chain of forms


def test_odd_words(spark):
    assert found(spark, {}) == []
    assert found(spark, {"lonelyword": 3}) == [("lonelyword", None, "lonelyword", 3, 0, None)]
    nulls = spark.createDataFrame([(None, 4), ("something", 2), ("somethings", 20)], "word string, n long")
    assert sorted(r.word for r in spelling.variants(nulls).collect()) == ["something", "somethings"]
    long = "z" * 30_000
    assert [r[4] for r in found(spark, {long: 2, long + "y": 2, "y" + long + "y": 2})] == [1, 1, 2]
    with pytest.raises(ValueError):
        found(spark, {"short": 3})


def test_words_of_odd_documents(spark):
    rows = documents(spark, [(1, None), (2, ""), (None, "Éclairs ÉCLAIRS eclairs"), (3, "a1bcdefgh snake_casewords x" + "y" * 50_000)])
    got = [r.run for r in spelling.occurrences(rows, r"[A-Za-zÀ-ÿ]{7,}").collect()]
    assert sorted(got) == sorted(["Éclairs", "Éclairs", "eclairs", "bcdefgh", "casewords", "x" + "y" * 50_000])
    assert spelling.occurrences(empty(spark), "[a-z]+").count() == 0
    counted = spelling.counted(spelling.occurrences(odd(spark), "[A-Za-z]{5,}").select(spelling.F.col("run").alias("word")), 5, 2)
    assert {r.word: r.n for r in counted.collect()}["lorem"] == 8000


@pytest.mark.parametrize("name", ["op12_minhash", "op13_spelling"])
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    cursor = duck.execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = sorted((tuple(r) for r in queries.QUERIES[name](spark, SF_DIR).select(*columns).collect()), key=repr)
    assert got == sorted(cursor.fetchall(), key=repr) and len(got) > 100
