"""Search hits in order of relevance, over an inverted index.

The index is three tables: ``postings`` (term, document, how often the term is in it, how long it is), ``terms`` (in how
many documents a term is) and ``lengths`` (documents and words). Postings lie in folders by part (a day, a month) and by
the hash of the term, sorted by term, so that a search opens the folders of its own words alone and skips the row groups
of others. A part is replaced as a whole when it is built again.

A hit scores, for each word of the keyword, ``idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean length))`` with
``idf = ln(1 + (N - df + 0.5) / (df + 0.5))`` over the parts searched, rounded to millionths so that sums do not depend on
their order; the smaller key goes first on equal scores. Each task keeps a page's rows at most.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.functions.fields import words

# The usual parameters of this score.
K1, B = 1.2, 0.75
PART, BUCKET = "part", "bucket"


def _runs(terms: str) -> Column:
    """(term, tf) of each stretch of equal terms in a sorted array that is not empty."""
    size = F.size(terms)
    begins = F.filter(F.sequence(F.lit(0), size - 1), lambda i: (i == 0) | (F.get(terms, i) != F.get(terms, i - 1)))
    ends = F.concat(F.slice(begins, F.lit(2), size), F.array(size))
    return F.zip_with(begins, ends, lambda a, b: F.struct(F.get(terms, a).alias("term"), (b - a).cast("bigint").alias("tf")))


@dataclass(frozen=True)
class TextIndex:
    """``key`` tells documents apart; it must be unique within a part, and a document belongs to one part."""

    path: str
    key: str
    key_type: T.DataType
    buckets: int = 16

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _schema(self, *fields: T.StructField) -> T.StructType:
        return T.StructType([*fields, T.StructField(PART, T.StringType()), T.StructField(BUCKET, T.IntegerType())])

    def _write(self, rows: DataFrame, name: str, *folders: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*folders).parquet(f"{self.path}/{name}")

    def build(self, docs: DataFrame, text: str, part: Column | None = None) -> TextIndex:
        """Index the documents' ``text``; the parts they belong to are replaced."""
        part = F.lit("all") if part is None else F.coalesce(part.cast("string"), F.lit("none"))
        texts = docs.select(F.col(self.key), part.alias(PART), F.coalesce(F.col(text), F.lit("")).alias("body"))
        length = F.size(words(F.col("body")))
        rows = texts.select(PART, length.alias("length"))
        lengths = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("docs"), F.sum("length").cast("bigint").alias("total"))
        self._write(lengths.coalesce(1), "lengths", PART)
        # Texts are shuffled, not their words; a document's words are then counted where it is.
        split = texts.repartition(self.key).select(self.key, PART, words(F.col("body")).alias("words"))
        merged = split.groupBy(PART, self.key, F.size("words").alias("length")).agg(F.flatten(F.collect_list("words")).alias("words"))
        postings = merged.where("length > 0").select(self.key, PART, "length", F.sort_array("words").alias("words"))
        postings = postings.select(self.key, PART, "length", F.inline(_runs("words"))).withColumn(BUCKET, self._bucket(F.col("term")))
        self._write(postings.hint("rebalance", PART, BUCKET).sortWithinPartitions(PART, BUCKET, "term"), "postings", PART, BUCKET)
        spark = docs.sparkSession
        terms = self._read(spark, "postings").groupBy(PART, BUCKET, "term").agg(F.count(F.lit(1)).alias("df"))
        self._write(terms.sortWithinPartitions(PART, BUCKET, "term"), "terms", PART, BUCKET)
        return self

    def _read(self, spark: SparkSession, name: str, parts: Sequence[str] | None = None, wanted: Sequence[str] | None = None) -> DataFrame:
        fields = {
            "postings": [(self.key, self.key_type), ("length", T.IntegerType()), ("term", T.StringType()), ("tf", T.LongType())],
            "terms": [("term", T.StringType()), ("df", T.LongType())],
        }[name]
        schema = self._schema(*[T.StructField(n, t) for n, t in fields])
        rows = spark.read.schema(schema).parquet(f"{self.path}/{name}")
        rows = rows if parts is None else rows.where(F.col(PART).isin(list(parts)))
        if wanted is None:
            return rows
        buckets = [r[0] for r in spark.createDataFrame([(w,) for w in wanted], "w string").select(self._bucket(F.col("w"))).collect()]
        return rows.where(F.col(BUCKET).isin(buckets) & F.col("term").isin(list(wanted)))

    def search(self, spark: SparkSession, keyword: str, parts: Sequence[str] | None = None, every: bool = True) -> DataFrame:
        """``key`` and ``score`` of the documents with every word of the keyword, or with any of them.

        Only the index's figures of the keyword's words come to the driver: one count each.
        """
        wanted = sorted(set(spark.range(1).select(words(F.lit(keyword))).first()[0]))
        lengths = spark.read.schema(f"docs bigint, total bigint, {PART} string").parquet(f"{self.path}/lengths")
        lengths = lengths if parts is None else lengths.where(F.col(PART).isin(list(parts)))
        docs, total = lengths.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
        df = {r["term"]: r["df"] for r in self._read(spark, "terms", parts, wanted).groupBy("term").agg(F.sum("df").alias("df")).collect()}
        postings = self._read(spark, "postings", parts, wanted)
        idf = F.lit(0.0)
        for term, n in df.items():
            idf = F.when(F.col("term") == term, F.lit(log(1 + (docs - n + 0.5) / (n + 0.5)))).otherwise(idf)
        spread = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("length") / F.lit(total / docs if total else 1.0))
        part = idf * F.col("tf") * F.lit(K1 + 1) / (F.col("tf") + spread)
        scored = postings.groupBy(self.key).agg(F.sum(part).alias("score"), F.count(F.lit(1)).alias("found"))
        hits = scored.where(F.col("found") == len(wanted)) if every else scored
        return hits.select(self.key, (F.floor(F.col("score") * 1e6 + 0.5) / 1e6).alias("score"))


def ranked(hits: DataFrame, key: str, size: int, after: tuple[float, object] | None = None) -> DataFrame:
    """The ``size`` best hits, or those after the (score, key) a page ended with, however deep that is."""
    if after is not None:
        score, last = after
        hits = hits.where((F.col("score") < score) | ((F.col("score") == score) & (F.col(key) > last)))
    return hits.orderBy(F.desc("score"), F.asc(key)).limit(size)
