"""Rebuilds of what changed, replacement of whole folders, tests counted while writing."""

import csv
import os

import pytest
from pyspark.sql import functions as F

from tallyspan import jobs
from tallyspan.operators import dimension, quality
from tallyspan.operators.quality import Rule
from tallyspan.plans import checks, ingest, refresh
from tallyspan.plans import warehouse as wh
from tallyspan.sources import catalog, export, replace, seeds
from tallyspan.sources.wide_csv import registry

NAMES = ["Klassifikator", "Klassifikator_ru", "Klassifikator_en", "Klassifikator_uzc"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def land(folder, dataset, shift=0, name="Namangan shahri", codes=(1714401, 1714402)):
    with open(folder / f"sdmx_data_{dataset}.csv", "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["Code", *NAMES, 2010, 2011])
        for code in codes:
            out.writerow([code, name, "r", "e", "u", dataset + shift, 7 + shift])


def files(root):
    """Every data file with its time and content length, by path below the root."""
    found = {}
    for folder, _, names in os.walk(root):
        for n in names:
            if n.endswith(".parquet"):
                path = os.path.join(folder, n)
                found[os.path.relpath(path, root)] = os.stat(path).st_mtime_ns
    return found


def changed_tables(before, after):
    return {p.split("/")[0] for p, _ in set(before.items()) ^ set(after.items())} - {"_state", "_tests"}


@pytest.fixture
def landed(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    ids = [223, 224, 225, 226, 246]
    for i in ids:
        land(raw, i)
    return raw, registry(str(raw), ids), str(tmp_path / "wh")


def full(spark, sources):
    """Every stored model, built anew."""
    models = wh.build_models(spark, ingest.build_atomic(spark, sources), None)
    return {name: rows(models[name].select(sorted(models[name].columns))) for name in [refresh.ATOMIC, *refresh.EDGES]}


def stored(spark, root):
    found = {name: spark.read.parquet(f"{root}/{name}") for name in refresh.EDGES} | {refresh.ATOMIC: wh.read_atomic(spark, f"{root}/{refresh.ATOMIC}")}
    return {name: rows(df.select(sorted(df.columns))) for name, df in found.items()}


def test_only_changed_datasets_are_written(spark, landed):
    raw, sources, root = landed
    refresh.refresh(spark, sources, root, None)
    assert stored(spark, root) == full(spark, sources)
    before = files(root)
    assert refresh.refresh(spark, sources, root, None) == [] and files(root) == before

    land(raw, 224, shift=5)
    done = refresh.refresh(spark, sources, root, None)
    after = files(root)
    assert done[0] == "dataset=224" and "mart_population_split_yearly" not in done and "mart_births_by_sex_yearly" in done
    same = {p for p in before if p.startswith(refresh.ATOMIC) and "dataset_id=224" not in p}
    assert same and all(after.get(p) == before[p] for p in same)
    assert stored(spark, root) == full(spark, sources)

    del sources[226]  # retired
    land(raw, 225, codes=())  # empty now
    land(raw, 227)  # late
    sources |= registry(str(raw), [227])
    refresh.refresh(spark, sources, root, None)
    assert stored(spark, root) == full(spark, sources)
    assert {r.dataset_id for r in wh.read_atomic(spark, f"{root}/{refresh.ATOMIC}").collect()} == {223, 224, 227, 246}


def test_a_seed_rebuilds_what_depends_on_it(spark, landed):
    _, sources, root = landed
    refresh.refresh(spark, sources, root, None)
    before = files(root)
    overrides = spark.createDataFrame([(1714401, "Another name")], seeds.GEO_OVERRIDE)
    assert refresh.refresh(spark, sources, root, None, overrides=overrides) == ["dim_geo", "mart_region_overview_yearly"]
    assert changed_tables(before, files(root)) == {"dim_geo", "mart_region_overview_yearly"}
    named = {r.geo_code: r.geo_name for r in spark.read.parquet(f"{root}/mart_region_overview_yearly").collect()}
    assert named[1714401] == "Another name"


def test_a_new_dictionary_rebuilds_all(spark, landed):
    _, sources, root = landed
    refresh.refresh(spark, sources, root, None)
    renamed = seeds.dim_metric(spark).withColumn("metric_key", F.when(F.col("dataset_id") == 224, "girls").otherwise(F.col("metric_key")))
    refresh.refresh(spark, sources, root, None, dictionary=renamed)
    keys = {r.metric_key for r in wh.read_atomic(spark, f"{root}/{refresh.ATOMIC}").where("dataset_id = 224").collect()}
    assert keys == {"girls"}


def test_a_name_leaves_with_its_last_dataset(spark, landed):
    raw, sources, root = landed
    for i in (223, 224, 226, 246):
        land(raw, i, codes=(1718001,))
    land(raw, 225, name="A smallest name", codes=(1718001,))
    refresh.refresh(spark, sources, root, None)

    def names():
        return {r.geo_name_raw for r in spark.read.parquet(f"{root}/{refresh.NAMES}").collect()}, {r.geo_name for r in spark.read.parquet(f"{root}/dim_geo").collect()}

    assert names() == ({"A smallest name", "Namangan shahri"}, {"A smallest name"})
    del sources[225]
    refresh.refresh(spark, sources, root, None)
    assert names() == ({"Namangan shahri"}, {"Namangan shahri"})
    land(raw, 224, name="B name", codes=(1718001,))
    refresh.refresh(spark, sources, root, None)
    assert names()[1] == {"B name"} and stored(spark, root) == full(spark, sources)


def test_merged_names_are_those_of_all_facts(spark):
    facts = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c"), (None, "d"), (3, None)], "k int, name string")
    gone = facts.where("name = 'a'")
    counts = dimension.name_counts(facts, "k", "name")
    merged = dimension.merged_names([counts], [dimension.name_counts(gone, "k", "name")], "k", "name")
    assert rows(dimension.representatives(merged, "k", "name")) == rows(dimension.discover_dimension(facts.where("name is null or name <> 'a'"), "k", "name"))
    one = dimension.merged_names([counts], [dimension.name_counts(gone.limit(1), "k", "name")], "k", "name")
    assert rows(dimension.representatives(one, "k", "name")) == rows(dimension.discover_dimension(facts, "k", "name"))


def test_rejects_follow_their_dataset(spark, landed):
    raw, sources, root = landed
    land(raw, 224, name="x", codes=("bad", 1714401))
    refresh.refresh(spark, sources, root, None)
    assert rows(spark.read.parquet(f"{root}/rejects").select("code", "reason", "dataset_id")) == [("bad", "code", 224)]
    land(raw, 224)
    land(raw, 225, codes=("worse",))
    refresh.refresh(spark, sources, root, None)
    assert rows(spark.read.parquet(f"{root}/rejects").select("code", "reason", "dataset_id")) == [("worse", "code", 225)]


def test_a_refresh_that_breaks_off_is_done_again(spark, landed, monkeypatch):
    raw, sources, root = landed
    refresh.refresh(spark, sources, root, None)
    land(raw, 223, shift=9)
    monkeypatch.setattr(refresh, "write_models", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh.refresh(spark, sources, root, None)
    monkeypatch.undo()
    assert "dataset=223" in refresh.refresh(spark, sources, root, None)
    assert stored(spark, root) == full(spark, sources)


def test_levels_follow_the_edges():
    assert refresh.levels()[0][0] == "dim_geo" and ["mart_region_overview_yearly"] == refresh.levels()[1]
    assert refresh.affected(["geo_override"], []) == ["dim_geo", "mart_region_overview_yearly"]
    assert refresh.affected([], []) == []
    assert set(refresh.affected(["prefix"], [])) == set(wh.MARTS)


# --- replacement ---------------------------------------------------------------


def test_a_failing_export_leaves_the_earlier_one(spark, tmp_path):
    out = str(tmp_path / "out")
    catalog.register_views({"some_mart": spark.range(3)})
    assert rows(export.export_tables(spark, ["some_mart"], out)) == [("some_mart", "ok", 3, None)]
    catalog.register_views({"some_mart": spark.range(5, numPartitions=2).selectExpr("if(id = 4, raise_error('no'), id) AS id")})
    assert [r.status for r in export.export_tables(spark, ["some_mart"], out).collect()] == ["failed"]
    assert rows(spark.read.schema("id bigint").csv(f"{out}/some_mart", header=True)) == [(0,), (1,), (2,)]
    assert os.listdir(out) == ["some_mart"]
    catalog.register_views({"some_mart": spark.range(1)})
    assert rows(export.export_tables(spark, ["some_mart"], out)) == [("some_mart", "ok", 1, None)]
    assert spark.read.csv(f"{out}/some_mart", header=True).count() == 1


def test_a_failing_rebuild_leaves_the_earlier_tables(spark, landed, monkeypatch):
    raw, sources, root = landed
    jobs.build_warehouse(spark, sources, root, None)
    before = {m: rows(spark.read.parquet(f"{root}/{m}")) for m in ["dim_geo", *wh.MARTS]}
    monkeypatch.setattr(wh, "mart_births_by_sex_yearly", lambda *_: spark.range(1).selectExpr("raise_error('no') AS x"))
    land(raw, 223, shift=1)
    with pytest.raises(Exception, match="no"):
        jobs.build_warehouse(spark, sources, root, None)
    assert rows(spark.read.parquet(f"{root}/mart_births_by_sex_yearly")) == before["mart_births_by_sex_yearly"]
    monkeypatch.undo()
    jobs.build_warehouse(spark, sources, root, None)
    assert stored(spark, root) == full(spark, sources)


def test_a_broken_off_swap_is_mended(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(3).write.parquet(path)
    os.rename(path, path + "._old-abc")  # the run ended here
    assert replace.exists(spark, path) and spark.read.parquet(path).count() == 3
    assert not replace.exists(spark, str(tmp_path / "nowhere" / "table"))
    replace.replaced(spark, path, lambda staged: spark.range(7).write.parquet(staged))
    assert spark.read.parquet(path).count() == 7 and os.listdir(tmp_path) == ["table"]


# --- tests while writing ---------------------------------------------------------


def test_observed_rules_report_as_scans_do(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (None, "z")], "k int, v string")
    rules = [Rule("t", "k", "not_null"), Rule("t", "v", "accepted_values", ("a", "b")), Rule("some", "v", "not_null")]
    tables = {"t": "true", "some": "k is null"}
    seen = quality.Observed(df, quality.row_rules([*rules, Rule("t", "k", "unique")], tables))
    seen.frame.write.parquet(str(tmp_path / "t"))
    want = quality.run_rules({"t": df, "some": quality.Slice(df, "k is null")}, rules)
    assert sorted(seen.report()) == rows(want)
    assert quality.Observed(df, []).report() == []


def test_tables_that_are_seen_to_be_empty_count_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string").where("false")
    seen = quality.Observed(df, quality.row_rules([Rule("t", "k", "not_null")], {"t": "true"}))
    seen.frame.write.parquet(str(tmp_path / "t"))
    assert seen.report() == [("t", "k", "not_null", 0, 0, True)]
    catalog.register_views({"nothing": df})
    assert rows(export.export_tables(spark, ["nothing"], str(tmp_path / "out"))) == [("nothing", "ok", 0, None)]


def test_the_suite_scans_only_for_keys(spark, landed, plan):
    _, sources, root = landed
    models = jobs.build_warehouse(spark, sources, root, None)
    report = jobs.test_stored(spark, root)
    assert rows(report) == rows(jobs.test_warehouse(models))
    reads = [line for line in plan(report).splitlines() if "FileScan" in line]
    assert reads and all("value" not in line.split("ReadSchema")[1] and "year" not in line.split("ReadSchema")[1] for line in reads)


def test_staged_rows_lost_in_the_dictionary_are_tested(spark, landed):
    raw, sources, root = landed
    land(raw, 223, codes=("", 1714401))  # a row without a code
    jobs.build_warehouse(spark, sources, root, None)
    failed = {(r.table_name, r.column_name): r.n_failed for r in jobs.test_stored(spark, root).where("not passed").collect()}
    assert failed[("stg_sdmx_223_long", "geo_code")] == 2
    no_births = seeds.dim_metric(spark).where("dataset_id <> 223")
    tests = ingest.store_atomic(spark, ingest.scan_staging(spark, sources), no_births, f"{root}/other")
    assert ("stg_sdmx_223_long", "geo_code", "not_null", 4, 2, False) in tests
    assert wh.read_atomic(spark, f"{root}/other").where("dataset_id = 223").count() == 0
    assert checks.TESTED_STAGING
