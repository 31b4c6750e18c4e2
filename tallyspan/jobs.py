"""The warehouse as jobs: build, load, test, export, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan import fixed_values as fv
from tallyspan.operators.quality import run_rules
from tallyspan.plans import checks, ingest, refresh
from tallyspan.plans import warehouse as wh
from tallyspan.sources import audit as fa
from tallyspan.sources import catalog, export, manifest, replace, seeds

STORED = ["dim_geo", *wh.MARTS]


def build_warehouse(
    spark: SparkSession, sources: Mapping[int, str], root: str, prefix: str | None = fv.DEFAULT_GEO_PREFIX,
    years: Sequence[str] = wh.YEARS, first_years: Mapping[int, int] = fv.DATASET_FIRST_YEAR,
) -> dict[str, DataFrame]:
    """Raw extracts to stored tables under ``root``; returns every model by name.

    The atomic table, the geography dimension and the marts are written, and
    under ``rejects`` what could not be read. Facts are row slices of the atomic
    table and stay views over it. ``prefix`` scopes the marts, ``None`` keeps
    every geography. The overview mart reads the stored dimension instead of
    deriving it again; independent models are written side by side. Row tests
    are counted while tables are written. Each table is replaced whole once its
    new rows are complete.
    """
    root = root.rstrip("/")
    replace.removed(spark, [f"{root}/{refresh.STATE}"])  # what a refresh would compare with
    staging = ingest.scan_staging(spark, sources, years, first_years)
    tests = {row[:3]: row for row in ingest.store_atomic(spark, staging, seeds.dim_metric(spark), f"{root}/{refresh.ATOMIC}")}
    left = ingest.scan_rejected(spark, sources, years, first_years)
    replace.replaced(spark, f"{root}/rejects", lambda path: left.write.parquet(path))
    atomic = wh.read_atomic(spark, f"{root}/{refresh.ATOMIC}")
    tests |= refresh.write_models(spark, root, STORED, atomic, prefix, seeds.geo_override(spark))
    refresh.write_tests(spark, root, tests)
    return load_warehouse(spark, root)


def refresh_warehouse(
    spark: SparkSession, sources: Mapping[int, str], root: str, prefix: str | None = fv.DEFAULT_GEO_PREFIX, **build: object
) -> tuple[list[str], dict[str, DataFrame]]:
    """What :func:`plans.refresh.refresh` wrote, and every model by name."""
    done = refresh.refresh(spark, sources, root, prefix, **build)
    return done, load_warehouse(spark, root)


def load_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The stored models, also registered as views under their published names."""
    root = root.rstrip("/")
    for name in [refresh.ATOMIC, *STORED]:
        replace.recover(spark, f"{root}/{name}")
    atomic = wh.read_atomic(spark, f"{root}/{refresh.ATOMIC}")
    models = wh.build_models(spark, atomic)
    models.update({name: spark.read.parquet(f"{root}/{name}") for name in STORED})
    catalog.register_views(models)
    catalog.register_staging_views(atomic.select(*wh.STAGING_COLUMNS))
    return models


def test_warehouse(models: Mapping[str, DataFrame]) -> DataFrame:
    """Report of all declared tests, all by scans of the stored models."""
    return run_rules(checks.tested_tables(models), checks.RULES)


def test_stored(spark: SparkSession, root: str) -> DataFrame:
    """Report of all declared tests: row tests as counted when the tables were written, on staged rows before any lookup."""
    models = checks.tested_tables(load_warehouse(spark, root))
    return checks.finished_report(spark, models, list(refresh.read_tests(spark, root.rstrip("/")).values()))


def export_marts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The registered marts as CSV; one status row per mart."""
    return export.export_tables(spark, wh.MARTS, out_dir)


def audit_landing(spark: SparkSession, manifest_path: str, raw_dir: str, out: str) -> DataFrame:
    """Audit records of the manifest's files, kept as JSON in a folder of their own run under ``out``; returns the tally."""
    run = f"{out.rstrip('/')}/run={datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
    fa.write_audit(fa.audit(spark, manifest.read_manifest(spark, manifest_path), raw_dir), run)
    return fa.audit_tally(spark.read.json(run))


def _runs(spark: SparkSession, out: str) -> tuple[DataFrame, list[str]]:
    """All records, and the last two runs, the newer first."""
    records = spark.read.json(out).withColumn("run", F.col("run").cast("string"))
    return records, [r.run for r in records.select("run").distinct().orderBy(F.desc("run")).limit(2).collect()]


def landing_changes(spark: SparkSession, out: str) -> DataFrame:
    """Files that are new, missing, changed or unchanged between the last two audits; all new after the first one."""
    records, runs = _runs(spark, out)
    landed = records.where("path is not null")
    before = landed.where(F.col("run") == (runs[1] if len(runs) > 1 else ""))
    return fa.compare_snapshots(before, landed.where(F.col("run") == runs[0]))


def stale_files(spark: SparkSession, out: str, max_age_days: int, as_of: Column | None = None) -> DataFrame:
    """Files of the last audit that are older than the limit on a day (today), with their age in days."""
    records, runs = _runs(spark, out)
    landed = records.where((F.col("run") == runs[0]) & F.col("path").isNotNull())
    stamped = landed.select("filename", "path", F.to_timestamp("modified_at").alias("modified_at"))
    return fa.freshness(stamped, "modified_at", F.current_date() if as_of is None else as_of, max_age_days).where("not fresh")
