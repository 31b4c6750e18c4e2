"""The whole warehouse from files to exported marts."""

import csv
import os
import time

import pytest

from tallyspan import fixed_values as fv
from tallyspan import jobs
from tallyspan.__main__ import main
from tallyspan.sources import audit as fa
from tallyspan.sources.wide_csv import registry

GEOS = [(1714, "Namangan viloyati"), (1714401, "Namangan shahri"), (1714999, "Yangi TUMANI"), (1718, "Boshqa viloyati")]
YEARS = list(range(2010, 2025))


def cell(dataset, geo, year):
    """Whole numbers in which every total is the sum of its parts."""
    parts = {223: (224, 225), 226: (227, 228), 230: (232, 233), 243: (235, 242), 246: (244, 245)}
    if dataset in parts:
        return sum(cell(p, geo, year) for p in parts[dataset])
    if dataset == 247:
        return cell(246, geo, year) - cell(248, geo, year) - (100 if year == 2011 else 0)
    return (dataset * 7 + geo % 1000 + year * 3) % 500 + (1000 if dataset in (244, 245) else 1)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for i in fv.STAGED_DATASETS:
        years = [y for y in [*YEARS, 2025] if y <= (2025 if i in (244, 245, 246, 247, 248) else 2024) and y >= (2014 if i == 244 else 2010)]
        with open(root / f"sdmx_data_{i}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(["Code", "Klassifikator", "Klassifikator_ru", "Klassifikator_en", "Klassifikator_uzc", *years])
            for code, name in GEOS:
                out.writerow([code, name, "r", "e", "u", *[cell(i, code, y) for y in years]])
    return str(root)


@pytest.fixture(scope="module")
def models(spark, raw, tmp_path_factory):
    return jobs.build_warehouse(spark, registry(raw, fv.STAGED_DATASETS), str(tmp_path_factory.mktemp("out") / "wh"))


def test_counts(models):
    geos = len(GEOS) - 1
    assert models["int_demography_atomic"].count() == len(GEOS) * (18 * 15 + 11)
    for mart in ["mart_region_overview_yearly", "mart_population_split_yearly", "mart_births_by_sex_yearly"]:
        assert models[mart].count() == geos * 15
    coverage = models["mart_metric_coverage"].collect()
    assert len(coverage) == 281 and {(r["rows_cnt"], r["non_null_cnt"]) for r in coverage} == {(geos, geos)}
    assert models["fact_population_yearly"].count() == len(GEOS) * (4 * 15 + 11)
    assert models["fact_demography_flows_yearly"].count() == len(GEOS) * 14 * 15


def test_figures(models):
    for r in models["mart_region_overview_yearly"].collect():
        g, y = r["geo_code"], r["year"]
        births, deaths, people = cell(223, g, y), cell(226, g, y), cell(246, g, y)
        moved = cell(268, g, y) - cell(269, g, y)
        assert (r["natural_increase"], r["net_migration"]) == (births - deaths, moved)
        assert r["cbr_per_1000"] == births / people * 1000 and r["net_mig_per_1000"] == moved / people * 1000
    levels = {r["geo_code"]: (r["geo_name"], r["geo_level"]) for r in models["dim_geo"].collect()}
    assert levels[1714401] == ("Namangan shahri", "shahar") and levels[1714999] == ("Yangi TUMANI", "tuman")
    for r in models["mart_population_split_yearly"].collect():
        assert r["missing_women_flag"] == int(r["year"] < 2014)
        assert r["sex_diff"] == (None if r["year"] < 2014 else 0.0)
        assert r["settlement_diff"] == (100.0 if r["year"] == 2011 else 0.0)


def test_declared_tests_pass(models):
    report = jobs.test_warehouse(models).collect()
    assert len(report) == 61 and all(r["passed"] for r in report)


def test_views_carry_published_names(spark, models):
    assert spark.table("stg_sdmx_244_long").count() == len(GEOS) * 11
    assert spark.sql("select max(year) from mart_metric_coverage").first()[0] == 2024


def test_export(spark, models, tmp_path):
    status = {r["table_name"]: (r["status"], r["rows"]) for r in jobs.export_marts(spark, str(tmp_path)).collect()}
    assert status["mart_metric_coverage"] == ("ok", 281) and len(status) == 4


def test_command_line(spark, raw, tmp_path):
    (tmp_path / "manifest.csv").write_text("dataset_id,url,filename\n223,http://x,sdmx_data_223.csv\n238,http://x,sdmx_data_238.csv\n")
    main(["audit", "--manifest", str(tmp_path / "manifest.csv"), "--raw", raw, "--records", str(tmp_path / "audit")])
    got = {r["dataset_id"]: (r["status"], r["rows"] if "rows" in r else None) for r in spark.read.json(str(tmp_path / "audit")).collect()}
    assert got == {"223": ("ok", 4), "238": ("missing", None)}
    out = str(tmp_path / "wh")
    main(["build", "--raw", raw, "--out", out, "--ids", "223", "224", "225", "--prefix", "1718"])
    main(["test", "--out", out])
    main(["export", "--out", out, "--csv", str(tmp_path / "csv")])
    back = spark.read.csv(str(tmp_path / "csv" / "mart_births_by_sex_yearly"), header=True)
    assert back.count() == 15 and {r["geo_code"] for r in back.collect()} == {"1718"}


def test_changes_and_age_of_landed_files(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "records")
    raw.mkdir()
    names = ["a.csv", "b.csv", "c.csv"]
    for name in names[:2]:
        (raw / name).write_text("Code,Name\n1,x\n2,y\n")
    expected = spark.createDataFrame([(n,) for n in names], "filename string")

    def audit_once():
        run = f"{out}/run={time.time_ns()}"
        fa.write_audit(fa.audit(spark, expected, str(raw)), run)

    audit_once()
    assert {r.status for r in jobs.landing_changes(spark, out).collect()} == {"new"}
    (raw / "a.csv").write_text("Code,Name\n2,y\n1,x\n")
    (raw / "c.csv").write_text("Code,Name\n1,x\n")
    (raw / "b.csv").unlink()
    audit_once()
    got = {r.path.rsplit("/", 1)[1]: r.status for r in jobs.landing_changes(spark, out).collect()}
    assert got == {"a.csv": "changed", "b.csv": "missing", "c.csv": "new"}
    assert jobs.stale_files(spark, out, 1).count() == 0
    os.utime(raw / "c.csv", (0, 0))
    audit_once()
    assert [r.filename for r in jobs.stale_files(spark, out, 1).collect()] == ["c.csv"]
