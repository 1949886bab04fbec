"""User dimension: the latest record per user, and a cache in front of the user table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.operators.keyed import coalesced_record, latest_by_key, missing_in

USER_FIELDS = ["id", "login_name", "user_level", "birthday", "gender"]


def latest_users(feed: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """The last record of every user in a feed of inserts and updates."""
    return latest_by_key(feed, ["id"], order)


def resolve_users(cache: DataFrame, table: DataFrame) -> DataFrame:
    """One record per user: the cached one where there is one, else the table's.

    Both sides hold a user once, so this join has no hot keys; the sales are then joined once, not twice.
    """
    both = cache.select(*USER_FIELDS).alias("c").join(
        table.select(*USER_FIELDS).alias("t"), F.col("c.id") == F.col("t.id"), "full_outer"
    )
    return both.select(*coalesced_record("c", "t", USER_FIELDS, F.col("c.id").isNotNull()))


def write_back(cache: DataFrame, table: DataFrame, asked: DataFrame) -> DataFrame:
    """The cache after a batch that asked for the users ``asked(id)``: misses found in the table are added."""
    missed = missing_in(asked.select("id").distinct(), cache, ["id"])
    found = table.select(*USER_FIELDS).join(missed, "id", "left_semi")
    return cache.select(*USER_FIELDS).unionByName(found)


def user_json(users: DataFrame) -> DataFrame:
    """Looked-up users as JSON objects."""
    return users.select("id", F.to_json(F.struct("id", "gender", "user_level", "birthday")).alias("user_json"))
