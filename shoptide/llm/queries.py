"""Queries of the operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm import binpack, bitsliced, cotrain, decontam, langid, licenses, minhash, ngram_lm, periodic, pieces, secret_scan, simhash, spelling
from shoptide.llm.common import ROW, crc_of_id, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


ORACLES["op1_topk"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
scores AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5"""


@query
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return bitsliced.search(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256.0)


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", crc_of_id() % 5 == 0)
    model = langid.train(docs.where("not held_out"))
    found = langid.identify(spark, docs.select("doc_id", "text", "held_out"), model)
    return found.select(f"{ROW}.doc_id", f"{ROW}.held_out", "lang_pred", "score")


@query
def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = binpack.shards(table(spark, sf_dir, "documents").select("doc_id", "text"), count=16)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    model = cotrain.train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    found = cotrain.score(docs, model)
    return found.select(f"{ROW}.doc_id", "text_score", "meta_score", "score", (F.col("score") >= 0.5).alias("keep"))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.align(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        f"{ROW}.doc_id",
        (F.size("hits") > 0).alias("contaminated"),
        F.coalesce(F.get("hits", F.lit(0))["score"], F.lit(0.0)).alias("score"),
        F.get("hits", F.lit(0))["item_id"].alias("item_id"),
        F.col("hits.item_id").alias("item_ids"),
    )


@query
def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pieces.encode(docs, PIECE_MODEL, check=True)
    return found.select(f"{ROW}.doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(secret_scan.samples(docs)))

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")  # a second parameter would be the position

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS[:3])]
    digest = F.sha2(secret_scan.as_text("base").cast("binary"), 256).alias("base_sha256")
    return found.select(f"{ROW}.doc_id", *counts, digest, secret_scan.as_text("spans").alias("spans"))


@query
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, spans = F.col("places.label"), F.col("spans.label")
    start = F.col("places.word")
    return found.select(
        f"{ROW}.doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"),
        F.array_max(start).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, spans))), ",").alias("labels"),
        F.coalesce(F.array_max("spans.share"), F.lit(0.0)).alias("score"),
        "spans",
    )


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=3, max_bits=3)


@query
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", crc_of_id() % 5 == 1)
    model = ngram_lm.train(docs.where("not held_out"))
    found = ngram_lm.score(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    return found.select(f"{ROW}.doc_id", f"{ROW}.held_out", *columns, perplexity)


def replanted(docs: DataFrame) -> DataFrame:
    """The table of op11: of a tenth of the texts, chosen by the id, a part of their end repeats its first words."""
    h = crc_of_id()
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("words")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    source = lambda i: (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    put = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", source(i))))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(put, " ")).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(replanted(table(spark, sf_dir, "documents").select("doc_id", "text")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    higher = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    best = F.aggregate("runs", none, lambda held, r: F.when(held.isNull() | higher(r, held), r).otherwise(held))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select(f"{ROW}.doc_id", F.size("runs").cast("long").alias("n_runs"), "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        digest(F.array_join(lines, "")).alias("runs_sha256"),
        digest(F.coalesce("collapsed", F.lit(""))).alias("collapsed_sha256"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op12_minhash"] = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, r, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s
  FROM worded),
keyed AS (SELECT doc_id, r, len(s) AS n, CASE WHEN len(s) > 0 THEN s END AS s FROM shingled),
nodes AS (SELECT s, min(doc_id) AS low, any_value(n) AS n, min(r) AS node FROM keyed WHERE n > 0 GROUP BY s),
grams AS (SELECT node, n, unnest(s) AS g FROM nodes),
near AS (
  SELECT a.node AS u, b.node AS v FROM grams a JOIN grams b ON a.g = b.g AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(node, other) AS (SELECT node, node FROM nodes UNION SELECT r.node, near.v FROM reach r JOIN near ON near.u = r.other),
of AS (SELECT reach.node, min(n.low) AS low FROM reach JOIN nodes n ON n.node = reach.other GROUP BY reach.node)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, CASE WHEN k.n > 0 THEN of.low ELSE k.doc_id END AS component_id,
  CASE WHEN k.n > 0 THEN k.doc_id IS NOT DISTINCT FROM of.low ELSE true END AS kept
FROM keyed k LEFT JOIN nodes ON nodes.s = k.s LEFT JOIN of ON of.node = nodes.node"""


@query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=3, percent=85)


ORACLES["op13_spelling"] = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, CAST(range(8) AS BIGINT[])),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) x(b))),
runs AS (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), '{_UPPER}', '{_LOWER}') AS run FROM documents)
  GROUP BY ALL),
keyed AS (SELECT run, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, k, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) + 1 AS INTEGER)])), 4294967295) AS h
  FROM keyed, crc_table),
cut AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[1:CAST(h % len(run) AS INTEGER)] || run[CAST(h % len(run) AS INTEGER) + 2:] ELSE run END AS word, k FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM cut WHERE len(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
gaps AS (SELECT word, n, i, word[1:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(len(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.rest, a.word, a.n FROM gaps a JOIN words w ON w.word = a.rest
  UNION SELECT a.word, w.word, w.n FROM gaps a JOIN words w ON w.word = a.rest),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS form, max(n) AS form_n FROM near GROUP BY word),
formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * words.n THEN form END AS form,
    CASE WHEN form_n >= 10 * words.n THEN form_n END AS form_n FROM words LEFT JOIN best ON best.word = words.word),
chain(word, last) AS (SELECT word, word FROM words UNION SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.last AND f.form IS NOT NULL)
SELECT f.word, f.form, c.last AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.last AND e.form IS NULL"""


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.occurrences(table(spark, sf_dir, "documents").select("doc_id", "text"), r"[A-Za-z\u00C0-\u00FF]{7,}")
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = runs.withColumn("h", F.crc32(named.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("run")).alias("word"))
    return spelling.variants(spelling.counted(words, least_size=7, least_n=2)).select("word", "form", "root", "n", "n_near", "form_n")
