"""Language identification by words first, then by character n-grams.

A word seen in training is scored by its log frequency in each language. An unseen word falls back to its character
n-grams, the longest that are known: n from ``longest`` down to 1, the mean log frequency of the known ones of the first
n that has any. A text's score is the softmax of the sums over its words.

Training reads a bounded sample of labelled rows: about ``sample`` per language, chosen by the hash of the id, with
their whole texts. So the model has a bounded size and is broadcast; every other row is only scored. Words and n-grams
count from ``least`` occurrences on.

Defined results. ``und`` with score 0 for a null text, a text without a letter, or if nothing was learned. A text of
which no n-gram is known gets the language with most training rows (ties: the first by name) and score 1 / languages.
Rows with a null language are never trained on; repeated rows are scored one by one; an empty table gives an empty one.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm.common import annotate, sampled, stored

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
SMOOTHING = 0.5


class Model:
    """Log frequencies: a row of ``table`` for each word and n-gram, a column for each language."""

    def __init__(self, languages: list[str], words: dict[str, int], grams: dict[str, int], table: np.ndarray, longest: int):
        self.languages, self.words, self.grams, self.table, self.longest = languages, words, grams, table, longest

    def backoff(self, word: str) -> list[int]:
        """Table rows of the longest known n-grams of a word; n-grams include its two ends."""
        ended = f"_{word}_"
        get = self.grams.get
        for n in range(self.longest, 0, -1):
            if found := [g for i in range(len(ended) - n + 1) if (g := get(ended[i : i + n])) is not None]:
                return found
        return []

    def score(self, text: str | None) -> tuple[str, float]:
        tokens = WORD.findall((text or "").lower())
        if not self.languages or not any(any(map(str.isalpha, t)) for t in tokens):
            return UNKNOWN, 0.0
        found = list(map(self.words.get, tokens))
        known = np.array([k for k in found if k is not None], np.int64)
        total = self.table[known].sum(axis=0, dtype=np.float64)
        rows = [r for t, k in zip(tokens, found) if k is None and (r := self.backoff(t))]
        if rows:
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            flat = self.table[np.concatenate(rows)].astype(np.float64)
            total += (np.add.reduceat(flat, np.cumsum(sizes) - sizes) / sizes[:, None]).sum(axis=0)
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def log_frequencies(counts: DataFrame, languages: list[str], least: int) -> tuple[dict[str, int], np.ndarray]:
    """Rows of (item, one count per language) of a sampled, so bounded, table, as logs relative to the mean language."""
    sums = [F.sum(F.when(F.col("lang") == name, F.col("n"))).alias(f"n{i}") for i, name in enumerate(languages)]
    wide = counts.groupBy("item").agg(*[F.coalesce(s, F.lit(0)).alias(f"n{i}") for i, s in enumerate(sums)])
    wide = wide.where(sum(F.col(f"n{i}") for i in range(len(languages))) >= least)
    pdf = wide.orderBy("item").toPandas()
    n = pdf[[f"n{i}" for i in range(len(languages))]].to_numpy(np.float64) + SMOOTHING
    logs = np.log(n / n.sum(axis=0))
    return {w: i for i, w in enumerate(pdf["item"])}, (logs - logs.mean(axis=1, keepdims=True)).astype(np.float32)


def train(labelled: DataFrame, sample: int = 2000, longest: int = 4, least: int = 2) -> Model:
    """``labelled``: doc_id, text, lang. Reads about ``sample`` rows of each language."""
    rows = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes, key=lambda name: (-sizes[name], name))  # the first wins a tie
    if not languages:
        return Model([], {}, {}, np.empty((0, 0), np.float32), longest)
    picked = F.lit(False)
    for name, size in sizes.items():
        picked = F.when(F.col("lang") == name, sampled(sample, size)).otherwise(picked)
    chosen = rows.where(picked)
    # [^\\W\\d_] of Python is a letter, or a number that isn't a decimal digit
    found = F.expr(r"regexp_extract_all(lower(text), '[\\p{L}\\p{Nl}\\p{No}]+', 0)")
    counts = stored(chosen.select("lang", F.explode(found).alias("item")).groupBy("lang", "item").agg(F.count("*").alias("n")), "words")
    ended = F.concat(F.lit("_"), F.col("item"), F.lit("_"))

    def grams_of(n: int):
        starts = F.sequence(F.lit(1), F.length("item") + 3 - n)
        return F.when(F.length("item") + 2 >= n, F.transform(starts, lambda i: F.substr(ended, i, F.lit(n))))

    split = F.explode(F.flatten(F.array_compact(F.array(*[grams_of(n) for n in range(1, longest + 1)])))).alias("item")
    grams = counts.select("lang", "n", split).groupBy("lang", "item").agg(F.sum("n").alias("n"))
    words, first = log_frequencies(counts, languages, least)
    rest, second = log_frequencies(grams, languages, least)
    return Model(languages, words, {g: i + len(words) for g, i in rest.items()}, np.concatenate([first, second]), longest)


def identify(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``row`` (all columns of docs), ``lang_pred`` and ``score``."""
    parts = spark.sparkContext.broadcast((model.languages, model.words, model.grams, model.table, model.longest))

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        score = Model(*parts.value).score
        found = [score(t) for t in batch.column("text").to_pylist()]
        return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    return annotate(docs, values, "lang_pred string, score double")
