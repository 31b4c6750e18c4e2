"""Dimensions discovered from facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.text import first_match
from tallyspan.operators.enrich import lookup, union_sources


def discover_dimension(df: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key with its smallest name as representative.

    Pairs are counted first: that is a hash aggregate, whereas a minimum over
    text directly on the facts sorts all of them. The condition on the count
    keeps the optimizer from dropping this step as redundant.
    """
    pairs = df.groupBy(key, name).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 0")
    return pairs.groupBy(key).agg(F.min(name).alias(name))


def name_counts(df: DataFrame, key: str, name: str, *by: str) -> DataFrame:
    """Rows per key and name (and `by`), as ``n_rows``: what a maintained dimension keeps of its facts."""
    return df.groupBy(*by, key, name).agg(F.count(F.lit(1)).alias("n_rows"))


def merged_names(added: Sequence[DataFrame], removed: Sequence[DataFrame], key: str, name: str) -> DataFrame:
    """Counts of several runs as one; names of removed facts leave once none of their rows is left."""
    signed = [df.select(key, name, "n_rows") for df in added] + [df.select(key, name, (-F.col("n_rows")).alias("n_rows")) for df in removed]
    summed = union_sources(signed).groupBy(key, name).agg(F.sum("n_rows").alias("n_rows"))
    return summed.where("n_rows > 0")


def representatives(counts: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key with its smallest name, as :func:`discover_dimension` finds it in the facts."""
    return counts.where("n_rows > 0").groupBy(key).agg(F.min(name).alias(name))


def override_names(base: DataFrame, overrides: DataFrame, key: str, raw: str, clean: str, out: str) -> DataFrame:
    """Clean name where one is given, the raw name otherwise."""
    known = overrides.select(F.col(key).cast("bigint").alias(key), clean)
    return lookup(base, known, key, "left").withColumn(out, F.coalesce(F.col(clean), F.col(raw)))


def classify(df: DataFrame, column: str, patterns: Sequence[tuple[str, str]], otherwise: str, out: str) -> DataFrame:
    """Level of each row from the first pattern its text matches."""
    return df.withColumn(out, first_match(column, patterns, otherwise))
