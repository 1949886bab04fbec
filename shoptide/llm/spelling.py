"""Spelling variants: words that differ by one inserted, deleted or replaced character, over variable-length grams.

A word is looked at through its grams: from every character on the longest one that is in a dictionary, two characters if
none is. The dictionary holds pieces of up to ``longest`` characters and is pruned by how often they occur in the words: a
piece of two characters or more grows by one only where it occurs more than ``crowd`` times, and only to pieces that
occur at least an eighth as often. So lists of frequent grams are split, rare ones stay whole, and the dictionary is
bounded whatever the input, since ``crowd`` grows with the words.

An edit touches only some of a word's grams: those that begin after it stay, and of those before it the ones that end
before it and that nothing in the dictionary could carry on over it. The most that any one edit touches is the word's own
bound ``touched``, known from the word alone, for insertions into it, too. Words one edit apart so share all but
``touched`` grams of either, each at a place at most one off, the grams of the shorter word never further back. In one
order of all grams, rarest first, the first they share is among the ``touched`` + 1 first grams of both: only these
short lists are merged, by an equi-join on a hash of gram, place and length, and a pair is verified in the join itself: first by
the letters in use, of which an edit changes two at most, then by its edit distance. No list of pairs is kept, and one hot
gram is split like any skewed join.

Every word of ``longest`` + 2 characters or more has more grams than an edit touches, so no pair is missed; shorter ones
are refused. ``variants`` counts a word's near words and picks the most frequent as its ``form`` where that is ``ratio``
times as frequent; ``root`` follows forms to the last by pointer doubling (frequencies grow along, so there is no cycle).

Defined results. Words come as distinct (word, n); a null word is left out. Ties of n go to the word smallest in code-point
order. Words without near words have n_near 0, no form, and are their own root. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import stored

SHORTEST, LONGEST = 2, 5
# A piece is crowded from this share of the words on, and from CROWD occurrences.
CROWD, CROWD_SHARE = 32, 1 / 2000
GRAMS = "word string, size int, gram string, place int, letters long"


def dictionary(words: DataFrame, longest: int = LONGEST) -> dict[str, int]:
    """Grams with the number of places they are picked at; all of two characters that occur, and longer ones as above."""
    count = words.count()
    crowd = max(CROWD, int(count * CROWD_SHARE))
    split = words.select(F.split("word", "").alias("letters"))  # places of an array, so that long words take linear time

    def pieces(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("letters") - n)
        return F.when(F.size("letters") >= n, F.transform(starts, lambda i: F.concat(*[F.get("letters", i + k) for k in range(n)])))

    every = F.explode(F.flatten(F.array_compact(F.array(*[pieces(n) for n in range(SHORTEST, longest + 1)])))).alias("gram")
    often = F.when(F.length("gram") == SHORTEST, 1).otherwise(max(1, crowd // 8))
    counts = stored(split.select(every).groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= often), "grams")
    crowded = counts.where(F.col("n") > crowd).select(F.col("gram").alias("stem"))
    stem = F.expr("substr(gram, 1, length(gram) - 1)")
    longer = counts.withColumn("stem", stem).join(crowded, "stem", "left_semi").where(F.length("gram") > SHORTEST)
    kept = counts.where(F.length("gram") == SHORTEST).unionByName(longer.select("gram", "n"))
    found = dict(kept.toPandas().itertuples(index=False, name=None))  # bounded by the shares above
    picked = dict(found)
    for gram, n in found.items():
        if gram[:-1] in picked:
            picked[gram[:-1]] -= n
    return picked


def stems_of(grams) -> set[str]:
    """What some gram of the dictionary goes on from."""
    return {g[:-1] for g in grams if len(g) > SHORTEST}


def decompose(word: str, grams, longest: int = LONGEST) -> list[str]:
    """The gram of every place: the longest of the dictionary."""
    found = []
    for p in range(len(word) - SHORTEST + 1):
        end = p + SHORTEST
        while end < min(p + longest, len(word)) and word[p : end + 1] in grams:
            end += 1
        found.append(word[p:end])
    return found


def touched(word: str, picked: list[str], stems: set[str], longest: int = LONGEST) -> int:
    """The most grams of a word that one edit may change."""
    most = 0
    for at in range(len(word) + 1):
        before = 0
        for p in range(max(0, at - longest + 1), min(at, len(picked))):
            # A gram ends before the edit and cannot grow over it, or it may change; one character grows to two.
            if p + len(picked[p]) > at or at - p < SHORTEST or word[p:at] in stems:
                before += 1
        most = max(most, before + (at < len(picked)))
    return most


def letters_of(word: str) -> int:
    """A bit for each letter in use, several letters to a bit."""
    bits = 0
    for letter in set(word):
        bits |= 1 << ord(letter) % 63
    return bits


def short_lists(words: DataFrame, picked: dict[str, int], longest: int = LONGEST) -> DataFrame:
    """The ``touched`` + 1 rarest grams of every word, with their places."""
    shared = words.sparkSession.sparkContext.broadcast(picked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        stems = stems_of(counts)
        for batch in batches:
            out = [[], [], [], [], []]
            for word in batch.column(0).to_pylist():
                grams = decompose(word, counts, longest)
                order = sorted(range(len(grams)), key=lambda p: (counts.get(grams[p], 0), grams[p], p))
                letters = letters_of(word)
                for p in order[: touched(word, grams, stems, longest) + 1]:
                    for column, value in zip(out, (word, len(word), grams[p], p, letters)):
                        column.append(value)
            types = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int64())
            names = ["word", "size", "gram", "place", "letters"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    return words.select("word").mapInArrow(run, GRAMS)


def near_pairs(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """All (a, b) of ``words`` (word) that differ by exactly one edit, each pair once."""
    if words.where(F.length("word") < longest + 2).limit(1).count():
        raise ValueError(f"words need {longest + 2} characters for grams of up to {longest}")
    lists = stored(short_lists(words, dictionary(words, longest), longest), "lists")

    def key(size: int, place: int) -> Column:
        return F.xxhash64("gram", F.col("size") + size, F.col("place") + place)

    # The shorter word, or the first of two equally long ones, asks.
    asked = F.explode(F.array(key(0, 0), key(1, 0), key(1, 1))).alias("key")
    left = lists.select(F.col("word").alias("a"), F.col("letters").alias("mine"), asked)
    right = lists.select(F.col("word").alias("b"), "letters", key(0, 0).alias("key"))
    alike = F.bit_count(F.col("mine").bitwiseXOR(F.col("letters"))) <= 2
    own, other = F.length("a"), F.length("b")
    once = (own < other) | ((own == other) & (F.col("a") < F.col("b")))
    pairs = left.join(right, "key").where(alike & once & (F.levenshtein("a", "b", 1) == 1))
    return pairs.select("a", "b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form, by pointer doubling over (word, form)."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = found.join(further, "root", "left")
        moved = stored(stepped.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        found = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return found


def variants(words: DataFrame, ratio: int = 10, longest: int = LONGEST) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``words`` (word, n)."""
    words = stored(words.where("word is not null").select("word", "n"), "words")
    pairs = stored(near_pairs(words, longest), "pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    known = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("m")), "b")
    best = F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("best")
    near = known.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best)
    enough = -F.col("best.m") >= ratio * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.b")).alias("form"),
        F.when(enough, -F.col("best.m")).alias("form_n"),
    )
    rows = stored(rows, "forms")
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def occurrences(docs: DataFrame, pattern: str) -> DataFrame:
    """doc_id and ``run`` for every match in the whole texts, with A-Z (and no other letter) in lower case."""
    runs = F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("run")
    upper = "".join(map(chr, range(65, 91)))
    return docs.select("doc_id", runs).withColumn("run", F.translate("run", upper, upper.lower()))


def counted(words: DataFrame, least_size: int, least_n: int) -> DataFrame:
    """Distinct words (word) of a size with their number ``n``, if large enough."""
    counts = words.where(F.length("word") >= least_size).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least_n)
