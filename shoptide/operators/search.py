"""Keyword search over sale details, with shares by gender and age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import constants as C
from shoptide.functions.fields import has_all_words, percent, percent_rest


def search(sale: DataFrame, keyword: str, date: str | None = None, column: str = "sku_name") -> DataFrame:
    """Sales whose product name has every word of the keyword, of one day or of all.

    On a table partitioned by ``dt`` the day is a partition filter.
    """
    hits = sale if date is None else sale.where(F.col("dt") == date)
    return hits.where(has_all_words(F.col(column), keyword))


def page(hits: DataFrame, number: int, size: int, order: tuple[str, ...] = ("order_detail_id",)) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows in a fixed order."""
    if number < 1 or size < 0:
        raise ValueError("pages count from 1 and have no negative size")
    return hits.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(hits: DataFrame, last: str | None, size: int, key: str = "order_detail_id") -> DataFrame:
    """The ``size`` rows after the one with the key ``last`` (None: from the start), in order of the key.

    Every task keeps ``size`` rows at most, however deep the page is.
    """
    return (hits if last is None else hits.where(F.col(key) > last)).orderBy(key).limit(size)


def top_terms(hits: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values with their counts; the smaller value goes first on equal counts."""
    counts = hits.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(k)


def total_hits(hits: DataFrame) -> DataFrame:
    return hits.agg(F.count(F.lit(1)).alias("total"))


def _side_by_side(*single_rows: DataFrame) -> DataFrame:
    """One row out of several single-row results with columns of their own."""
    stacked = single_rows[0]
    for other in single_rows[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.any_value(c, F.lit(True)).alias(c) for c in stacked.columns])


def _term_counts(hits: DataFrame) -> DataFrame:
    """Counts by gender, counts by age and the total, out of one pass over the hits.

    The hits are counted by gender and age together first, and only those few counts are split up.
    """
    counts = hits.groupBy("user_gender", "user_age").agg(F.count(F.lit(1)).alias("c"))
    no_gender, no_age = F.lit(None).cast("string").alias("gender"), F.lit(None).cast("int").alias("age")
    kinds = F.array(
        F.struct(F.lit("total").alias("kind"), no_gender, no_age),
        F.struct(F.lit("gender").alias("kind"), F.col("user_gender").alias("gender"), no_age),
        F.struct(F.lit("age").alias("kind"), no_gender, F.col("user_age").alias("age")),
    )
    return counts.select(F.inline(kinds), "c").groupBy("kind", "gender", "age").agg(F.sum("c").alias("n"))


def _ratios(terms: DataFrame) -> DataFrame:
    """One row: total and the five shares.

    Women are what men leave, and the middle age band what the outer ones leave, so unknown genders and ages
    count there.
    """

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    figures = terms.agg(
        counted(F.col("kind") == "total").alias("total"),
        counted(F.col("gender") == C.MALE).alias("male"),
        counted(F.col("age") < C.AGE_YOUNG_BELOW).alias("young"),
        counted(F.col("age") >= C.AGE_OLD_FROM).alias("old"),
    )
    return _shares(figures)


def _shares(figures: DataFrame, *keep: str) -> DataFrame:
    """Shares out of the counts ``total``, ``male``, ``young`` and ``old``."""
    shares = figures.select(
        "total",
        *keep,
        percent(F.col("male"), F.col("total")).alias("male_ratio"),
        percent(F.col("young"), F.col("total")).alias("young_ratio"),
        percent(F.col("old"), F.col("total")).alias("old_ratio"),
    )
    return shares.select(
        "total",
        *keep,
        "male_ratio",
        percent_rest(F.col("male_ratio")).alias("female_ratio"),
        "young_ratio",
        percent_rest(F.col("young_ratio"), F.col("old_ratio")).alias("middle_ratio"),
        "old_ratio",
    )


def report_figures(hits: DataFrame) -> DataFrame:
    """One row with ``total``, the shares by gender and the shares by age."""
    return _ratios(_term_counts(hits))


def cell_figures(cells: DataFrame) -> DataFrame:
    """The same row out of cells (user_gender, user_age, n), however they are split up further."""

    def counted(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    figures = cells.agg(
        counted(F.lit(True)).alias("total"),
        counted(F.col("user_gender") == C.MALE).alias("male"),
        counted(F.col("user_age") < C.AGE_YOUNG_BELOW).alias("young"),
        counted(F.col("user_age") >= C.AGE_OLD_FROM).alias("old"),
    )
    return _shares(figures)


def gender_ratio(hits: DataFrame) -> DataFrame:
    """Shares by gender, one row per label."""
    figures = report_figures(hits)
    return figures.select(
        F.inline(
            F.array(
                F.struct(F.lit(C.LABEL_MALE).alias("name"), F.col("male_ratio").alias("value")),
                F.struct(F.lit(C.LABEL_FEMALE).alias("name"), F.col("female_ratio").alias("value")),
            )
        )
    )


def age_ratio(hits: DataFrame) -> DataFrame:
    """Shares by age band, one row per label."""
    figures = report_figures(hits)
    return figures.select(
        F.inline(
            F.array(
                F.struct(F.lit(C.LABEL_YOUNG).alias("name"), F.col("young_ratio").alias("value")),
                F.struct(F.lit(C.LABEL_MIDDLE).alias("name"), F.col("middle_ratio").alias("value")),
                F.struct(F.lit(C.LABEL_OLD).alias("name"), F.col("old_ratio").alias("value")),
            )
        )
    )


def _stat(title: str, options: list[tuple[str, str]]) -> Column:
    listed = [F.struct(F.lit(label).alias("name"), F.col(value).alias("value")) for label, value in options]
    return F.struct(F.lit(title).alias("title"), F.array(*listed).alias("options"))


def sale_report(sale: DataFrame, keyword: str, number: int, size: int, date: str | None = None) -> DataFrame:
    """One row: ``total``, ``stat`` (ages, then genders) and ``detail``, the rows of one page."""
    hits = search(sale, keyword, date)
    figures = report_figures(hits).select(
        "total",
        F.array(
            _stat(
                C.TITLE_AGE,
                [(C.LABEL_YOUNG, "young_ratio"), (C.LABEL_MIDDLE, "middle_ratio"), (C.LABEL_OLD, "old_ratio")],
            ),
            _stat(C.TITLE_GENDER, [(C.LABEL_MALE, "male_ratio"), (C.LABEL_FEMALE, "female_ratio")]),
        ).alias("stat"),
    )
    # Only the page, at most ``size`` rows, is gathered into one array.
    listed = F.array_sort(F.collect_list(F.struct("order_detail_id", F.struct(*sale.columns).alias("row"))))
    rows = page(hits, number, size).agg(F.transform(listed, lambda x: x.getField("row")).alias("detail"))
    return _side_by_side(figures, rows)


def day_report(hits: DataFrame, size: int, key: str = "order_detail_id") -> DataFrame:
    """Figures, and the ids of the first page joined by commas as ``page_ids``.

    Two scans of the same pruned folder, the second of one column: counts are a hash aggregate, and of the page each
    task keeps ``size`` ids, so no key is sorted.
    """
    counts = hits.groupBy("user_gender", "user_age").agg(F.count(F.lit(1)).alias("n"))
    first = page_after(hits.select(key), None, size).agg(F.array_join(F.array_sort(F.collect_list(key)), ",").alias("page_ids"))
    first = first.select(F.nullif("page_ids", F.lit("")).alias("page_ids"))
    return _side_by_side(cell_figures(counts), first)


def sale_report_json(report: DataFrame) -> DataFrame:
    return report.select(F.to_json(F.struct("total", "stat", "detail")).alias("value"))
