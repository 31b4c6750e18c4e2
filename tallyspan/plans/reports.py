"""Report queries over the marts: cards, trends, rankings, splits, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan import fixed_values as fv
from tallyspan.functions.text import code_label, two_decimals, whole_number
from tallyspan.operators import reshape, scope, summarise


def scoped(
    mart: DataFrame,
    prefix: str | None = None,
    first: int | None = None,
    last: int | None = None,
    geo: int | None = None,
) -> DataFrame:
    """Mart rows of a prefix, a year range and optionally one geography."""
    rows = scope.year_range(scope.in_prefix(mart, prefix), first, last)
    return rows if geo is None else scope.slice_on(rows, geo_code=geo)


def geo_options(overview: DataFrame) -> DataFrame:
    """Choices for a geography picker: code, name, label."""
    found = summarise.options(overview, ["geo_code", "geo_name"])
    return found.withColumn("label", code_label("geo_name", "geo_code"))


def latest_cards(overview: DataFrame) -> DataFrame:
    """Headline figures of every geography at its own latest year, as text."""
    counts = ["population_total", "birth_total", "death_total", "natural_increase", "net_migration"]
    figures = overview.select("geo_code", "year", *counts, "cbr_per_1000")
    latest = summarise.latest_per_key(figures, ["geo_code"], "year")
    return latest.select(
        "geo_code",
        "year",
        *[whole_number(c).alias(c) for c in counts],
        two_decimals("cbr_per_1000").alias("cbr_per_1000"),
    )


def trend_series(overview: DataFrame) -> DataFrame:
    """Measures as (geo_code, year, measure, value) rows; missing points are kept."""
    columns = scope.existing(overview, fv.TREND_MEASURES)
    return reshape.unpivot_long(overview, ["geo_code", "year"], columns, "measure", "value", None, keep_nulls=True)


def district_ranking(overview: DataFrame) -> DataFrame:
    """All geographies at the latest year of the scope, lowest net migration rate first."""
    rows = summarise.latest_rows(overview, "year").select(*scope.existing(overview, fv.RANKING_COLUMNS))
    order = "net_mig_per_1000" if "net_mig_per_1000" in rows.columns else "net_migration"
    return rows.orderBy(F.col(order).asc_nulls_last(), F.col("geo_code"))


def segment_series(
    split: DataFrame,
    columns: list[str],
    prefix: str | None = None,
    first: int | None = None,
    last: int | None = None,
    geo: int | None = None,
) -> DataFrame:
    """Population components as (geo_code, year, segment, value) rows of the scope; gaps are kept."""
    columns = scope.existing(split, columns)
    return reshape.unpivot_long(scoped(split, prefix, first, last, geo), ["geo_code", "year"], columns, "segment", "value", None, keep_nulls=True)


def gap_warnings(split: DataFrame) -> DataFrame:
    """Whether each geography has a year without the women component."""
    return summarise.any_flag(split, ["geo_code"], "missing_women_flag", "has_gap")


def coverage_listing(coverage: DataFrame) -> DataFrame:
    return coverage.orderBy("metric_key", "year")


def births_check(
    births: DataFrame,
    first: int | None = None,
    last: int | None = None,
    prefix: str | None = None,
    geo: int | None = None,
) -> DataFrame:
    """Births with their parts and difference, for the chosen years, prefix and geography."""
    rows = scoped(births, prefix, first, last, geo)
    return rows.select("geo_code", *scope.existing(rows, fv.BIRTH_CHECK_COLUMNS))
