r"""Secrets by fixed patterns and by two character Markov models. DataFrame functions only.

Patterns give the base spans (``assign``, ``access``, ``hex``). The method adds ``markov`` spans: of each run of
``CANDIDATE`` characters with a letter and a digit that touches no base span, the log-likelihoods under a Markov model of
random strings and one of ordinary identifiers are compared, character by character; a ratio of ``threshold`` or more
makes it a secret. Ratios are whole thousandths, so that sums do not depend on their order.

The models are trained from labelled samples (token, secret). ``samples`` derives them from the documents: what the
patterns found, in all of them, is random; other identifiers, of a bounded part (about ``sample`` documents, chosen by
the hash of the id, whole texts), are ordinary. The counts have at most 2 x 128 x 128 cells, whatever the input.

Defined results. A null or empty text has no spans. Positions count code points from 0, ends are exclusive. Spans are
sorted by start, then by kind in the order above. Without a sample of either label no markov spans are added. Repeated
rows are scanned one by one; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import ROW, sampled

# The patterns and least lengths of the base spans. Letters of the keyword in either case, ASCII only.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the run after AKIA is greedy, so 20 or more of it are the runs that do not fail
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "markov"]

CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{8,}"
CODES = 128
BLOCK = 64
NEAR, FAR = 1 << 10, 1 << 16  # characters that are redacted at a time, and whose spans are looked up at a time


def given(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """Each whole number joined with all before it; ``join`` is associative.

    An array that grows by one is copied at each step, so it grows to ``BLOCK`` at most: blocks are joined within
    themselves, then the blocks' totals in the same way, ``levels`` times. The work is linear up to BLOCK^levels values.
    """

    def onto(before: Column, x: Column) -> Column:
        return F.coalesce(join(before, x), x)

    def short(xs: Column) -> Column:
        last = lambda out: F.get(out, F.size(out) - 1)
        return F.aggregate(xs, F.array().cast("array<int>"), lambda out, x: F.concat(out, F.array(onto(last(out), x))))

    def in_blocks(xs: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda b: short(F.slice(xs, b * BLOCK + 1, F.lit(BLOCK))))
        return F.when(F.size(xs) == 0, xs).otherwise(given(blocks, lifted))

    def lifted(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.get(b, F.size(b) - 1))
        before = F.concat(F.array(F.lit(None).cast("int")), running(totals, join, levels - 1))
        return F.flatten(F.zip_with(blocks, F.slice(before, F.lit(1), F.size(blocks)), lambda b, t: F.transform(b, lambda x: onto(t, x))))

    return short(values) if levels == 1 else given(values, in_blocks)


def places(text: Column, pattern: str, rank: int) -> Column:
    """(start, rank, end, token) of each match: lengths of gaps and matches, added up."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start: int, rank: int, end: int, token: string>>")

    def placed(pairs: Column) -> Column:
        ends = running(F.transform(pairs, lambda p: F.length(p["gap"]) + F.length(p["token"])), lambda a, b: a + b)
        span = lambda p, end: F.struct(
            (end - F.length(p["token"])).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), p["token"].alias("token")
        )
        return F.zip_with(pairs, ends, span)

    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("token"), g.alias("gap")))
    return F.when(text.rlike(pattern), given(pairs, placed)).otherwise(empty)


def apart(spans: Column, base: Column) -> Column:
    """Those of ``spans`` that touch no span of ``base``: in order of their ends, no base span begun before reaches into them."""

    def clear(both: Column) -> Column:
        reach = running(F.transform(both, lambda x: x["reach"]), F.greatest)
        beside = F.zip_with(both, reach, lambda x, r: F.when(x["span"].isNotNull() & (r <= x["span"]["start"]), x["span"]))
        return F.array_compact(beside)

    none = F.lit(None).cast("struct<start: int, rank: int, end: int, token: string>")
    begun = F.transform(base, lambda b: F.struct(b["start"].alias("at"), F.lit(1).alias("later"), b["end"].alias("reach"), none.alias("span")))
    ended = F.transform(spans, lambda s: F.struct(s["end"].alias("at"), F.lit(0).alias("later"), F.lit(0).alias("reach"), s.alias("span")))
    return F.when((F.size(base) == 0) | (F.size(spans) == 0), spans).otherwise(given(F.array_sort(F.concat(begun, ended)), clear))


def base_spans(text: Column) -> Column:
    """All base spans with their tokens, sorted by start, then by kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_enough = F.zip_with(places(text, ASSIGN, 0), values, lambda s, v: F.when(F.length(v) >= ASSIGN_LEAST, s))
    assign = F.when(text.rlike(ASSIGN), F.array_compact(long_enough)).otherwise(places(F.lit(""), ASSIGN, 0))
    return F.array_sort(F.concat(assign, places(text, ACCESS, 1), places(text, HEX, 2)))


def character_codes(token: Column) -> Column:
    return F.transform(F.regexp_extract_all(token, F.lit("."), F.lit(0)), F.ascii)


def pairs_of(token: Column) -> Column:
    """Index of (character before, character) in a CODES x CODES table; 0 is before the first."""
    codes = character_codes(token)
    return F.zip_with(F.slice(F.concat(F.array(F.lit(0)), codes), 1, F.size(codes)), codes, lambda a, b: a * CODES + b)


def samples(docs: DataFrame, sample: int = 20_000) -> DataFrame:
    """(token, secret): values the patterns find in any document, and other identifiers of about ``sample`` documents."""
    chosen = sampled(sample, docs.count())
    text = F.col("text")
    rows = docs.select("text", chosen.alias("chosen")).where(F.col("chosen") | text.rlike(ASSIGN) | text.rlike(ACCESS) | text.rlike(HEX))
    values = F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= ASSIGN_LEAST)
    exact = F.concat(F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)), F.regexp_extract_all(text, F.lit(HEX), F.lit(0)))
    secrets = F.array_distinct(F.concat(values, exact))
    plain = F.when(F.col("chosen"), F.regexp_extract_all(text, F.lit(IDENTIFIER), F.lit(0))).otherwise(F.array().cast("array<string>"))
    found = rows.select(secrets.alias("secrets"), plain.alias("plain"))
    labelled = F.concat(
        F.transform("secrets", lambda t: F.struct(t.alias("token"), F.lit(True).alias("secret"))),
        F.transform(F.array_except("plain", "secrets"), lambda t: F.struct(t.alias("token"), F.lit(False).alias("secret"))),
    )
    return found.select(F.explode(labelled).alias("x")).select("x.token", "x.secret")


def train(labelled: DataFrame) -> list[int]:
    """Log-likelihood ratios in thousandths, for each pair of character codes; all 0 if a label has no sample."""
    counts = labelled.where("token is not null and secret is not null")
    counts = counts.select("secret", F.explode(pairs_of(F.col("token"))).alias("pair")).where(F.col("pair").between(0, CODES**2 - 1))
    cells = {(r["secret"], r["pair"]): r["count"] for r in counts.groupBy("secret", "pair").count().collect()}
    if {s for s, _ in cells} != {True, False}:
        return [0] * CODES**2
    symbols = len({pair % CODES for _, pair in cells})
    rows = {(s, a): sum(cells.get((s, a * CODES + b), 0) for b in range(CODES)) for s in (True, False) for a in range(CODES)}

    def log_share(secret: bool, pair: int) -> float:
        return log((cells.get((secret, pair), 0) + 0.5) / (rows[secret, pair // CODES] + 0.5 * symbols))

    return [round(1000 * (log_share(True, p) - log_share(False, p))) for p in range(CODES**2)]


def scan(docs: DataFrame, ratios: list[int], threshold: int = 9210) -> DataFrame:
    """``row`` (all columns of docs), ``base`` and ``spans`` (both sorted arrays of start, rank of the kind, end)."""
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")
    text = F.col("text")
    bare = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias(ROW), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(ROW, "text", bare(base_spans(text)).alias("base"))

    def ratio(token: Column) -> Column:
        return F.aggregate(pairs_of(token), F.lit(0).cast("long"), lambda total, p: total + F.get(table, p))

    def secrets(candidates: Column) -> Column:
        mixed = F.filter(candidates, lambda s: s["token"].rlike("[0-9]") & s["token"].rlike("[A-Za-z]"))
        return F.filter(apart(mixed, F.col("base")), lambda s: ratio(s["token"]) >= threshold)

    added = bare(given(places(text, CANDIDATE, 3), secrets))
    return rows.select(ROW, "text", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def as_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    part = F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["rank"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(part, ",")


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """The text with a mark for each span; spans that overlap are one.

    Finding the character at a position reads all before it, so the text is taken in parts, each with the spans in it.
    """

    def parts(whole: Column, size: int) -> Column:
        return F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))

    def within(found: Column, at: Column, size: int) -> Column:
        return F.filter(found, lambda s: (s["start"] < at + size) & (s["end"] > at))

    def cut(part: Column, at: Column, found: Column) -> Column:
        def step(held: Column, s: Column) -> Column:
            begin = s["start"] - at
            gap = F.when(s["opens"] & (begin >= 0), F.concat(F.substr(part, held["at"] + 1, begin - held["at"]), F.lit(mark)))
            out = F.concat(held["out"], F.coalesce(gap, F.lit("")))
            return F.struct(F.greatest(held["at"], s["end"] - at).alias("at"), out.alias("out"))

        nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
        return F.aggregate(found, nothing, step, lambda held: F.concat(held["out"], F.substr(part, held["at"] + 1)))

    def in_parts(found: Column) -> Column:
        def far(block: Column, i: Column) -> Column:
            near = lambda part, j, some: cut(part, i * FAR + j * NEAR, within(some, i * FAR + j * NEAR, NEAR))
            of_block = lambda some: F.array_join(F.transform(parts(block, NEAR), lambda part, j: near(part, j, some)), "")
            return given(within(found, i * FAR, FAR), of_block)

        return F.array_join(F.transform(parts(text, FAR), far), "")

    def opening(sorted_spans: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), running(F.transform(sorted_spans, lambda s: s["end"]), F.greatest))
        opens = lambda s, end: F.struct(s["start"].alias("start"), s["end"].alias("end"), (s["start"] >= end).alias("opens"))
        return F.zip_with(sorted_spans, F.slice(ends, F.lit(1), F.size(sorted_spans)), opens)

    return given(given(spans, opening), in_parts)


def redact(docs: DataFrame, ratios: list[int], mark: str = "[secret]") -> DataFrame:
    """``docs`` with each span of secrets replaced by ``mark``; overlapping spans are one. ``n_chars`` follows the text."""
    clean = F.when(F.size("spans") > 0, redacted(F.col("text"), F.col("spans"), mark)).otherwise(F.col(ROW)["text"])
    rows = scan(docs, ratios).select(ROW, clean.alias("clean"))
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        count = F.when(F.col("clean") == F.col(ROW)["text"], F.col(ROW)["n_chars"]).otherwise(F.length("clean"))
        changed["n_chars"] = count.cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col(ROW)[c]).alias(c) for c in docs.columns])
