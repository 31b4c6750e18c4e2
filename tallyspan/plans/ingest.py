"""From landed extracts to the stored atomic table."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan import fixed_values as fv
from tallyspan.operators.enrich import union_sources
from tallyspan.plans import checks
from tallyspan.plans.warehouse import (
    STAGING_COLUMNS,
    YEARS,
    demography_atomic,
    read_atomic,
    rejects,
    staging_long,
    write_atomic,
)
from tallyspan.session import new_shared_path
from tallyspan.sources import seeds
from tallyspan.sources.replace import replaced
from tallyspan.sources.wide_csv import Group, audited_groups, header_groups, scan

REJECTS = "dataset_id int, code string, geo_name_raw string, year int, found string, reason string"


def scan_staging(
    spark: SparkSession,
    sources: Mapping[int, str],
    years: Sequence[str] = YEARS,
    first_years: Mapping[int, int] = fv.DATASET_FIRST_YEAR,
    skip: Collection[int] = fv.UNSTAGED_DATASETS,
) -> DataFrame:
    """All sources as one long table.

    Years outside the list are ignored even where a file has them; a dataset
    with its own first year is cut there; ``skip`` names sources that are
    catalogued but not staged. Sources that share a header are one scan, so the
    plan grows with the number of headers, not of datasets.
    """
    groups = header_groups(spark, {i: path for i, path in sources.items() if i not in skip})
    return _staged(spark, groups, years, first_years, skip)


def scan_audited(
    spark: SparkSession,
    records: DataFrame,
    years: Sequence[str] = YEARS,
    first_years: Mapping[int, int] = fv.DATASET_FIRST_YEAR,
    skip: Collection[int] = fv.UNSTAGED_DATASETS,
    sources: Mapping[int, str] | None = None,
) -> DataFrame:
    """:func:`scan_staging` over the readable files of audit records; ``sources`` spares scans of folders that hold several datasets."""
    return _staged(spark, audited_groups(spark, records, sources), years, first_years, skip)


def _staged(
    spark: SparkSession,
    groups: Sequence[Group],
    years: Sequence[str],
    first_years: Mapping[int, int],
    skip: Collection[int],
) -> DataFrame:
    staged = [staging_long(scan(spark, group), years) for group in groups]
    if not staged:  # no file holds a header
        return spark.createDataFrame([], "dataset_id int, geo_code bigint, geo_name_raw string, year int, value double")
    return _in_build(union_sources(staged), first_years, skip).select(*STAGING_COLUMNS)


def _in_build(rows: DataFrame, first_years: Mapping[int, int], skip: Collection[int]) -> DataFrame:
    """Rows of the staged datasets, from each one's first year on; rows without a year stay."""
    for dataset_id, year in first_years.items():
        rows = rows.where((F.col("dataset_id") != dataset_id) | F.col("year").isNull() | (F.col("year") >= year))
    return rows.where(~F.col("dataset_id").isin(*skip)) if skip else rows


def scan_rejected(
    spark: SparkSession,
    sources: Mapping[int, str],
    years: Sequence[str] = YEARS,
    first_years: Mapping[int, int] = fv.DATASET_FIRST_YEAR,
    skip: Collection[int] = fv.UNSTAGED_DATASETS,
) -> DataFrame:
    """What the scan with the same arguments leaves out, and why."""
    groups = header_groups(spark, {i: path for i, path in sources.items() if i not in skip})
    found = [rejects(scan(spark, group), years) for group in groups]
    if not found:
        return spark.createDataFrame([], REJECTS)
    return _in_build(union_sources(found), first_years, skip)


def rejected_audited(
    spark: SparkSession,
    records: DataFrame,
    years: Sequence[str] = YEARS,
    first_years: Mapping[int, int] = fv.DATASET_FIRST_YEAR,
    skip: Collection[int] = fv.UNSTAGED_DATASETS,
    sources: Mapping[int, str] | None = None,
) -> DataFrame:
    """:func:`scan_rejected` over the readable files of audit records, and one row for each file that could not be read."""
    found = [rejects(scan(spark, group), years) for group in audited_groups(spark, records, sources)]
    file_id = F.regexp_extract("path", fv.RAW_FILE_ID_PATTERN, 1).try_cast("int")
    nothing = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("string").alias("geo_name_raw"), F.lit(None).cast("int").alias("year")]
    faults = records.where("path is not null and profile_error is not null").select(
        file_id.alias("dataset_id"), *nothing, F.col("path").alias("found"), F.concat(F.lit("file: "), F.col("profile_error")).alias("reason")
    )
    return _in_build(union_sources([*found, faults]), first_years, skip)


def unread_years(spark: SparkSession, sources: Mapping[int, str], years: Sequence[str] = YEARS) -> list[str]:
    """Year columns that files hold and a build over `years` does not read."""
    headers = {c for group in header_groups(spark, sources) for c in group.header}
    return sorted(c for c in headers if len(c) == 4 and c.isdigit() and c not in years)


def build_atomic(
    spark: SparkSession,
    sources: Mapping[int, str],
    path: str | None = None,
    dictionary: DataFrame | None = None,
    rejects_path: str | None = None,
    years: Sequence[str] = YEARS,
    first_years: Mapping[int, int] = fv.DATASET_FIRST_YEAR,
    skip: Collection[int] = fv.UNSTAGED_DATASETS,
) -> DataFrame:
    """Scan, unpivot, enrich and store; returns the stored table.

    The whole chain is map-only: no exchange between the files and the table.
    With ``rejects_path`` a second scan lists there what the first one left
    out, in place of an earlier list.
    """
    path = path or new_shared_path(spark, "atomic")
    dictionary = seeds.dim_metric(spark) if dictionary is None else dictionary
    store_atomic(spark, scan_staging(spark, sources, years, first_years, skip), dictionary, path)
    if rejects_path:
        left = scan_rejected(spark, sources, years, first_years, skip)
        replaced(spark, rejects_path, lambda staged: left.write.parquet(staged))
    return read_atomic(spark, path)


def store_atomic(spark: SparkSession, staging: DataFrame, dictionary: DataFrame, path: str) -> list[tuple]:
    """Enrich staged rows and store them in place of an earlier table; returns the report of all row tests on the way."""
    staged = checks.observed_staging(staging)
    rows = checks.observed_atomic(demography_atomic(staged.frame, dictionary))
    replaced(spark, path, lambda where: write_atomic(rows.frame, where))
    return [*staged.report(), *rows.report()]
