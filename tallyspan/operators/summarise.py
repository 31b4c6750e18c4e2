"""Counts, bounds, latest rows, option lists, rolling averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def coverage(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Rows and non-NULL values per key."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_cnt"),
        F.count(F.col(value)).alias("non_null_cnt"),
    )


def coverage_gaps(df: DataFrame, keys: Sequence[str], expected: DataFrame, value: str = "value") -> DataFrame:
    """Coverage over an expected key list, so that absent keys show as 0."""
    found = coverage(df, keys, value)
    return expected.join(found, list(keys), "left").select(
        *keys,
        F.coalesce("rows_cnt", F.lit(0).cast("bigint")).alias("rows_cnt"),
        F.coalesce("non_null_cnt", F.lit(0).cast("bigint")).alias("non_null_cnt"),
    )


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value of a column."""
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = ()) -> DataFrame:
    """Each key's row with the largest ``order``, whole rows only.

    An aggregate, not a ranking window: every task reduces its share to one row
    per key before the exchange, so a hot key never gathers in one task.
    ``ties`` decides between rows of the same ``order`` (the larger wins).
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(order, *ties) if ties else F.col(order)
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def latest_rows(df: DataFrame, order: str) -> DataFrame:
    """All rows at the largest ``order`` of the whole frame.

    The maximum is one scalar, which Spark also pushes into a file scan.
    """
    return df.where(F.col(order) == df.agg(F.max(order)).scalar())


def any_flag(df: DataFrame, keys: Sequence[str], flag: str, out: str) -> DataFrame:
    """1 for keys with at least one raised flag, else 0."""
    return df.groupBy(*keys).agg((F.max(flag) > 0).cast("int").alias(out))


def options(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of the given columns."""
    return df.select(*columns).distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "row_count") -> DataFrame:
    """Keys that occur more than once; NULL keys are not counted."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(out))
        .where(F.col(out) > 1)
    )


def rolling_average(df: DataFrame, keys: Sequence[str], year: str, value: str, span: int, out: str) -> DataFrame:
    """Average over the ``span`` calendar years up to each year that has data.

    Values are reduced to one sum and count per (key, year) before the window,
    so a hot key reaches its task as one row per calendar year, however many
    rows it had.
    """
    yearly = df.groupBy(*keys, year).agg(F.sum(value).alias("_sum"), F.count(value).alias("_cnt"))
    recent = Window.partitionBy(*keys).orderBy(year).rangeBetween(-(span - 1), 0)
    known = F.nullif(F.sum("_cnt").over(recent), F.lit(0))
    return yearly.select(*keys, year, (F.sum("_sum").over(recent) / known).alias(out))


def status_counts(df: DataFrame, status: str = "status", out: str = "items") -> DataFrame:
    """Items per status."""
    return df.groupBy(status).agg(F.count(F.lit(1)).alias(out))
