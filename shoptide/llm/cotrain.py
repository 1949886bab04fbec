"""A quality classifier by co-training of two views, the text and what is known about the page.

Each view has a logistic regression. In every round each is fitted on its labelled rows and scores all unlabelled documents;
the texts it is surest of, ``grow`` of either class, become pseudo-labelled rows of the other view. After the rounds each
view is calibrated on labelled rows that neither was fitted on (Platt: a logistic regression on its own log-odds), and
the calibrated log-odds are added up, less the prior once, as for independent views. That scores all documents.

Fitting reads a bounded part, whole texts all: labelled documents, at most about ``sample / 2`` of each class, chosen by the hash
of the id, and 2 * ``grow`` pseudo-labelled ones a view and round, the surest of all. Equal texts count once there, so a
large group of copies is no more than one of them. The classes' shares among the labelled are those of the whole
table again once a view is calibrated. All documents are scored where they are read, and labelled ones dropped after: ids, hashes of
texts and log-odds are shuffled, texts are not. Choosing the surest is a partial aggregate by text and a top-n.

Defined results. Null and empty texts and null metadata have features too (of nothing), so every row gets a score.
Labels that are null are not labels; of several labels of one document the mean counts, from 0.5 on as good. Without rows of
both classes nothing is learned, and every score is the share of good labels, 0.5 if there are none. Of labelled rows with the
same text and id one is learned from, as of pseudo-labelled rows with the same text; one without an id is only scored. Repeated
rows are scored one by one. Of equally sure texts that with the smaller id is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.common import ROW, annotate, pieces, sampled, stored, texts, words

WORD_CELLS, META_CELLS, SHAPES = 512, 256, 8
LETTERS = bytes(b for b in range(256) if chr(b).isalpha() and b < 128) + bytes(range(128, 256))
CAPITALS, DIGITS, BLANKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c"


def text_features(text: bytes) -> np.ndarray:
    """Hashed words (their root share) and shapes: kinds of characters, repeated words and lines, lengths."""
    found = words(text)
    out = np.zeros(WORD_CELLS + SHAPES)
    if found:
        cells = np.fromiter(map(xxhash.xxh32_intdigest, found), np.int64, len(found)) % WORD_CELLS
        out[:WORD_CELLS] = np.sqrt(np.bincount(cells, minlength=WORD_CELLS) / len(found))
    size, count, lines = max(1, len(text)), max(1, len(found)), text.split(b"\n")

    def share(kind: bytes) -> float:
        return (len(text) - len(text.translate(None, kind))) / size

    out[WORD_CELLS:] = [
        share(LETTERS),
        share(CAPITALS),
        share(DIGITS),
        1 - share(LETTERS + DIGITS + BLANKS),
        len(set(found)) / count,
        sum(map(bytes.__eq__, found, found[1:])) / count,
        len(set(lines)) / len(lines),
        log(1 + len(found)) / 10,
    ]
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META_CELLS + 1)
    length = log(1 + max(0, n_chars or 0))
    for name, value in (("source", source), ("lang", lang), ("length", int(length * 2))):
        out[xxhash.xxh32_intdigest(f"{name}={value}") % META_CELLS] = 1
    out[-1] = length / 10
    return out


def meta_rows(batch: pa.RecordBatch) -> list[np.ndarray]:
    columns = [batch.column(c).to_pylist() if c in batch.schema.names else repeat(None, batch.num_rows) for c in ("source", "lang", "n_chars")]
    return [meta_features(*row) for row in zip(*columns)]


def features(rows: DataFrame) -> DataFrame:
    """``row``, ``text_view`` and ``meta_view`` of a bounded table."""

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        kind = pa.list_(pa.float64())
        return [pa.array([text_features(t) for t in texts(batch.column("text"))], kind), pa.array(meta_rows(batch), kind)]

    return annotate(rows, values, "text_view array<double>, meta_view array<double>")


def fit(rows: DataFrame, view: str):
    return LogisticRegression(featuresCol=view, labelCol="label", regParam=0.01, maxIter=50).fit(rows)


def linear(model) -> tuple[np.ndarray, float]:
    return model.coefficients.toArray(), float(model.intercept)


VIEWS = ("text_view", "meta_view")
SURE = log(9.0)


def linear_odds(docs: DataFrame, weights: list[tuple[np.ndarray, float]]) -> DataFrame:
    """``doc_id``, ``text_hash`` and the log-odds of every view, ``text_view`` and ``meta_view``, without the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = ["doc_id", "text_hash"]
    schema = T.StructType([*[docs.schema[c] for c in kept], *[T.StructField(v, T.DoubleType()) for v in VIEWS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for _, part in pieces(batch, 1 << 20):
                    rows = (np.array([text_features(t) for t in texts(part.column("text"))]), np.array(meta_rows(part)))
                    odds = [pa.array(x @ w + bias) for x, (w, bias) in zip(rows, shared.value)]
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *odds], names=schema.names)

    return docs.select(F.struct(*docs.columns).alias(ROW)).mapInArrow(run, schema)


def surest(odds: DataFrame, view: str, grow: int) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``label`` of the texts a view is surest of, ``grow`` of either class, nine to one at least."""
    good = odds.where(F.col(view) >= SURE).orderBy(F.desc(view), "doc_id", "text_hash").limit(grow)
    bad = odds.where(F.col(view) <= -SURE).orderBy(view, "doc_id", "text_hash").limit(grow)
    columns = ("doc_id", "text_hash")
    return good.select(*columns, F.lit(1.0).alias("label")).unionByName(bad.select(*columns, F.lit(0.0).alias("label")))


def learned(rows: DataFrame) -> DataFrame:
    """Features of a bounded table of documents with a ``label``, stored; one row of those with the same id and text."""
    once = rows.dropDuplicates(["doc_id", "text_hash"])
    row = F.col(ROW)
    columns = [row[c].alias(c) for c in ("doc_id", "text_hash", "label")]
    return stored(features(once).select(*columns, *[array_to_vector(v).alias(v) for v in VIEWS]), "learned")


def labelled_sample(labels: DataFrame, sample: int) -> tuple[DataFrame, float]:
    """At most about ``sample / 2`` labels of each class, all of a class that has no more, and the share of good ones of all."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    known = known.agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    good, total = known.agg(F.coalesce(F.sum("label"), F.lit(0.0)), F.count("*")).first()
    of_class = [known.where(F.col("label") == c).where(sampled(sample // 2, int(n))) for c, n in ((1.0, good), (0.0, total - good))]
    return of_class[0].unionByName(of_class[1]), good / total if total else 0.5


def train(docs: DataFrame, labels: DataFrame, rounds: int = 3, grow: int = 500, sample: int = 10_000) -> dict:
    """Weights of both views, their calibrations and the prior. ``labels``: doc_id, quality."""
    chosen, prior = labelled_sample(labels, sample)
    constant = {"prior": prior, "views": []}
    if not 0 < prior < 1:
        return constant
    used = [c for c in ("doc_id", "text", "source", "lang", "n_chars") if c in docs.columns]
    marked = docs.select(used).withColumn("text_hash", F.xxhash64("text"))
    # ``chosen`` has about ``sample`` rows at most, what is picked below 4 * ``grow``
    rows = learned(marked.join(F.broadcast(stored(chosen, "labels")), "doc_id"))
    held_out = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)) == 0
    labelled, check = rows.where(~held_out), rows.where(held_out)
    shares = [part.agg(F.avg("label")).first()[0] for part in (labelled, check)]
    if not all(s is not None and 0 < s < 1 for s in shares):
        return constant
    known = labels.where("quality is not null").select("doc_id").distinct()
    own = {v: labelled for v in VIEWS}
    for _ in range(rounds):
        # joined after scoring: before it, the texts of all documents would be shuffled
        found = linear_odds(marked.where("doc_id is not null"), [linear(fit(own[v], v)) for v in VIEWS])
        unlabelled = found.join(known, "doc_id", "left_anti")
        by_text = unlabelled.groupBy("text_hash").agg(F.min(F.struct("doc_id", *VIEWS)).alias("x"))
        odds = stored(by_text.select("text_hash", "x.*"), "odds")
        for view, other in zip(VIEWS, reversed(VIEWS)):
            # a text keeps its first label
            fresh = surest(odds.join(F.broadcast(own[other].select("text_hash")), "text_hash", "left_anti"), view, grow)
            picked = marked.join(F.broadcast(stored(fresh, "fresh")), ["doc_id", "text_hash"])
            own[other] = own[other].unionByName(learned(picked))
    # Calibrated odds are those of the check rows' shares of the classes; the shift gives them those of all labels.
    shift = log(prior / (1 - prior)) - log(shares[1] / (1 - shares[1]))
    out = []
    for view in VIEWS:
        model = fit(own[view], view)
        graded = model.setRawPredictionCol("raw").transform(check)
        graded = graded.select("label", array_to_vector(F.array(vector_to_array("raw")[1])).alias("odds"))
        platt = LogisticRegression(featuresCol="odds", labelCol="label").fit(graded)
        out.append((*linear(model), float(platt.coefficients[0]), float(platt.intercept) + shift))
    return {"prior": prior, "views": out}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``row`` (all columns of docs), ``text_score``, ``meta_score`` (calibrated) and ``score`` of both, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def sigmoid(odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def values(batch: pa.RecordBatch) -> list[pa.Array]:
        m, n = shared.value, batch.num_rows
        if not m["views"]:
            return [pa.array(np.full(n, m["prior"]))] * 3
        rows = (np.array([text_features(t) for t in texts(batch.column("text"))]), np.array(meta_rows(batch)))
        odds = [a * (x @ weights + bias) + b for x, (weights, bias, a, b) in zip(rows, m["views"])]
        both = odds[0] + odds[1] - log(m["prior"] / (1 - m["prior"]))
        return [pa.array(sigmoid(o)) for o in (*odds, both)]

    return annotate(docs, values, "text_score double, meta_score double, score double", at_a_time=1 << 20)
