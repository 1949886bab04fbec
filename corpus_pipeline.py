"""A training corpus from raw documents: language, near duplicates, benchmark passages, secrets, pieces.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, with the columns of documents; the last returns the
columns of documents and ``ids``. ``run`` writes each stage's rows below ``spark.checkpoint.dir`` and reads them again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm import decontam, langid, pieces, secret_scan, simhash
from shoptide.llm.common import ROW, crc_of_id, stored, table, unpacked
from shoptide.llm.queries import PIECE_MODEL


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a language of the labels; rejects those without a letter or below even odds."""
    model = langid.train(docs.where(crc_of_id() % 5 != 0).select("doc_id", "text", "lang"))
    found = langid.identify(spark, docs, model)
    return unpacked(docs, found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= 0.5)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of fingerprints: three-word shingles, three differing bits at most."""
    return simhash.one_of_each(docs, width=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark, whole or edited."""
    found = decontam.align(docs, table(spark, sf_dir, "benchmark"))
    return unpacked(docs, found.where(F.size("hits") == 0))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, with secrets replaced by a mark."""
    return secret_scan.redact(docs, secret_scan.train(secret_scan.samples(docs)))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their sampled pieces."""
    found = pieces.encode(docs, PIECE_MODEL)
    return found.select(*[F.col(ROW)[c].alias(c) for c in docs.columns if c != "ids"], "ids")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("sentence_pieces", sentence_pieces),
]

# Languages, fingerprints and draws cannot be expressed in SQL; tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
