"""Union of sources and lookups."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all sources, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def lookup(df: DataFrame, table: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join to a lookup table.

    No broadcast hint: Spark broadcasts the table itself when its measured size
    is below the session's threshold (a seed is a local relation with an exact
    size) and otherwise sorts and merges, where adaptive execution splits a hot
    key. A hint would skip that check.
    """
    return df.join(table, list([on] if isinstance(on, str) else on), how)


def fill_missing(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """NULL attributes replaced by their default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def enrich_from_dictionary(
    long: DataFrame,
    dictionary: DataFrame,
    on: str = "dataset_id",
    attributes: Sequence[str] = ("metric_group", "metric_key", "sex", "settlement_type"),
    defaults: Mapping[str, str] = {"sex": "total", "settlement_type": "total"},
) -> DataFrame:
    """Attach the dictionary's meaning; rows it does not know are dropped."""
    meaning = fill_missing(dictionary.select(on, *attributes), defaults)
    return lookup(long, meaning, on, "inner")
