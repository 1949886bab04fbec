"""Relational and file tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    table: str,
    *,
    split_on: str | None = None,
    bounds: tuple[str, str] | None = None,
    connections: int = 8,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a relational read; with ``split_on`` the table is read in ranges over several connections."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if split_on is not None:
        if bounds is None:
            raise ValueError("split_on needs the bounds of the column")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(connections),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A table behind JDBC. Filters and column choices made on the result are sent to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A Parquet table of a folder of tables."""
    return spark.read.parquet(f"{path}/{table}.parquet")


def between_days(df: DataFrame, column: str, first: str | None, last: str | None = None) -> DataFrame:
    """Rows of the days ``first`` to ``last``, as a range of the raw column that reaches the file scan.

    Without ``first`` all rows up to ``last``; without ``last`` one day.
    """
    stop = F.date_add(F.lit(last or first).cast("date"), 1).cast("timestamp_ntz")
    rows = df.where(F.col(column) < stop)
    return rows if first is None else rows.where(F.col(column) >= F.lit(first).cast("timestamp_ntz"))
