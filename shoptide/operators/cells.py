"""Counts kept by cell, changed by every batch, so that a dashboard reads cells and no history.

A batch changes a cell by how many of its rows come into it less how many leave it; a cell's count is the sum of its
changes. Changes are rows like any others: appended under the batch's id, so a batch that is run again replaces its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cell_changes(before: DataFrame, after: DataFrame, cell: Sequence[str]) -> DataFrame:
    """``cell`` and ``n``: rows of ``after`` less rows of ``before``, where they differ."""
    both = after.select(*cell, F.lit(1).alias("by")).unionByName(before.select(*cell, F.lit(-1).alias("by")))
    return both.groupBy(*cell).agg(F.sum("by").alias("n")).where("n <> 0")


def cell_counts(changes: DataFrame, cell: Sequence[str]) -> DataFrame:
    """``cell`` and its count ``n``, without cells that have become empty."""
    return changes.groupBy(*cell).agg(F.sum("n").alias("n")).where("n <> 0")


def earlier_firsts(batch: DataFrame, known: DataFrame, key: str, first: str) -> DataFrame:
    """The batch's smallest ``first`` by key, where it is the key's first ever or before the one known (``known_first``)."""
    now = batch.where(F.col(key).isNotNull() & F.col(first).isNotNull()).groupBy(key).agg(F.min(first).alias(first))
    held = known.select(key, F.col(first).alias("known_first"))
    return now.join(held, key, "left").where(F.col("known_first").isNull() | (F.col(first) < F.col("known_first")))
