"""First and last record per key, membership, and single-value lookups.

First and last are row numbers limited to 1. Spark applies such a limit within every task before it shuffles, so
a key that holds a third of all rows sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], direction) -> DataFrame:
    """Only keys and order are sorted; columns that nobody asks for later are not read at all.

    The order has to end with something unique (an id, an offset), or equal rows are picked by luck.
    """
    ranked = Window.partitionBy(*keys).orderBy(*[direction(c) for c in order])
    return df.withColumn("rank_in_key", F.row_number().over(ranked)).where("rank_in_key = 1").drop("rank_in_key")


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key."""
    return _one_per_key(df, keys, order, F.asc)


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key: what a put-by-key store holds after all of them."""
    return _one_per_key(df, keys, order, F.desc)


def exists_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``other``. The key list is made distinct first, so hot keys there collapse."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def missing_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")


def exclude_listed(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the first column of the list, a blacklist for one."""
    return missing_in(df, listed.select(F.col(listed.columns[0]).alias(key)), [key])


def scalar_lookup(
    df: DataFrame, other: DataFrame, key: str, value: str, order: Sequence[str], name: str = "value"
) -> DataFrame:
    """Add the value of the last row of the key in ``other``; 0 where there is none."""
    last = latest_by_key(other.select(key, value, *[o for o in order if o != value]), [key], order)
    found = last.select(key, F.col(value).cast("bigint").alias(name))
    return df.join(found, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))


def coalesced_record(preferred: str, other: str, fields: Sequence[str], present: Column) -> list[Column]:
    """Fields of the preferred side's record where it is present, else of the other side's."""
    return [
        F.when(present, F.col(f"{preferred}.{field}")).otherwise(F.col(f"{other}.{field}")).alias(field)
        for field in fields
    ]
