"""Operators on small fixtures that hold the edge cases."""

import math
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspan.functions import measures as ms
from tallyspan.functions import text as tx
from tallyspan.operators import enrich, quality, reshape, scope, summarise
from tallyspan.operators.quality import Check, Rule, Slice
from tallyspan.plans import checks, reports, star
from tallyspan.plans import warehouse as wh
from tallyspan.plans.star_queries import QUERIES
from tallyspan.sources import seeds


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


WIDE = "Code long, Klassifikator string, `2010` string, `2011` string, `2012` string, `2025` string"


@pytest.fixture
def wide(spark):
    return spark.createDataFrame(
        [(1714, "a", "1.5", None, None, "9"), (17, "b", "-", " ", None, "9"), (5, None, " 2 ", "x1", None, None)], WIDE
    )


def test_staging_drops_missing_and_reports_bad_cells(wide):
    assert rows(wh.staging_long(wide, wh.YEARS, 223)) == [(223, 1714, "a", 2010, 1.5), (223, 5, None, 2010, 2.0)]
    assert rows(wh.rejected_cells(wide, wh.YEARS, 223)) == [(223, 17, "b", 2010, "-"), (223, 5, None, 2011, "x1")]


def test_staging_ignores_years_outside_the_range(wide):
    assert {r["year"] for r in wh.staging_long(wide, ["2025"], 1).collect()} == {2025}
    assert {r["year"] for r in wh.staging_long(wide, wh.YEARS, 1).collect()} == {2010}


def test_unpivot_null_rules(spark):
    df = spark.createDataFrame([(1, 1.0, None)], "k int, a double, b double")
    assert rows(reshape.unpivot_long(df, ["k"], ["a", "b"])) == [(1, "a", 1.0)]
    assert rows(reshape.unpivot_long(df, ["k"], ["a", "b"], keep_nulls=True)) == [(1, "a", 1.0), (1, "b", None)]


def test_unpivot_with_an_all_empty_text_column(spark):
    df = spark.createDataFrame([(1, 1.0, None)], "k int, `2010` double, `2011` string")
    assert rows(reshape.unpivot_long(df, ["k"], ["2010", "2011"], "year")) == [(1, "2010", 1.0)]


def test_pivot_takes_larger_duplicate_and_keeps_unmatched_keys(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (1, "x", 3.0), (1, "y", None), (2, "other", 5.0)], "k int, metric_key string, value double")
    assert rows(reshape.pivot_max(df, ["k"], {"x": "x", "y": "y"})) == [(1, 3.0, None), (2, None, None)]


def test_prefix_scope(spark):
    codes = spark.createDataFrame([(c,) for c in [1714, 1714401, 17, 171, 2714]], "geo_code long")
    for prefix in ["1714", " 1714 ", "", "  "]:
        assert rows(scope.in_prefix(codes, prefix)) == [(1714,), (1714401,)]
    assert rows(scope.in_prefix(codes, None)) == rows(codes)
    assert rows(scope.in_prefix(codes, "%")) == []
    assert rows(scope.in_prefix(codes, "17_4")) == []


@pytest.mark.parametrize("prefix", ["1", "17", "1714", "17144", "2714"])
def test_region_scope_equals_prefix_scope(spark, prefix):
    codes = spark.createDataFrame([(c,) for c in [1714, 1714401, 17, 171, 2714, 1]], "geo_code long")
    tagged = scope.with_region_code(codes)
    assert rows(scope.in_region(tagged, prefix).drop("region_code")) == rows(scope.in_prefix(codes, prefix))


def test_dictionary_drops_unknown_and_fills_missing_attributes(spark):
    long = spark.createDataFrame([(1, 9.0), (2, 8.0), (3, 7.0)], "dataset_id int, value double")
    meaning = spark.createDataFrame(
        [(1, "g", "a", None, "urban"), (2, "g", "b", "male", None)],
        "dataset_id int, metric_group string, metric_key string, sex string, settlement_type string",
    )
    assert rows(enrich.enrich_from_dictionary(long, meaning)) == [
        (1, 9.0, "g", "a", "total", "urban"),
        (2, 8.0, "g", "b", "male", "total"),
    ]


def test_union_is_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    assert rows(enrich.union_sources([a, b])) == [(1, "x"), (2, "y")]


def test_dim_geo_names_and_levels(spark):
    raw = [
        (1714, "Namangan viloyati eski"), (1714, "A viloyati"), (1, "X SHAHRI tumani"), (2, "y Tumani"),
        (3, "Z respublikasi"), (4, "nothing"), (5, None),
    ]
    geo = wh.dim_geo(spark.createDataFrame(raw, "geo_code long, geo_name_raw string"), seeds.geo_override(spark))
    assert rows(geo) == [
        (1, "X SHAHRI tumani", "shahar"),
        (1714, "Namangan viloyati", "viloyat"),
        (2, "y Tumani", "tuman"),
        (3, "Z respublikasi", "respublika"),
        (4, "nothing", "nomalum"),
        (5, None, "nomalum"),
    ]


def test_measures_on_missing_and_zero(spark):
    df = spark.createDataFrame([(6.0, 3.0, 2.0), (1.0, 0.0, None), (None, 2.0, 1.0)], "a double, b double, c double")
    got = df.select(
        ms.ratio("a", "b", 1000), ms.share("a", "b"), ms.parts_diff("a", ["b", "c"]), ms.missing_flag("c"), ms.balance("a", "b")
    )
    assert [tuple(r) for r in got.collect()] == [
        (2000.0, 200.0, 1.0, 0, 3.0),
        (None, None, None, 1, 1.0),
        (None, None, None, 0, None),
    ]


def test_rates_reproduce_published_figures(spark):
    """City figures of 2024 and 2023, as published, to the last bit."""
    df = spark.createDataFrame(
        [(696.5, 20317.0, 3569.0, 8.0, 12.0), (678.2, 21738.0, 3363.0, 16.0, 29.0)],
        "population double, births double, deaths double, arrivals double, departures double",
    )
    got = df.select(
        ms.ratio("births", "population", 1000),
        ms.ratio("deaths", "population", 1000),
        ms.ratio(ms.balance("arrivals", "departures"), "population", 1000),
    )
    assert [tuple(r) for r in got.collect()] == [
        (29170.13639626705, 5124.192390524048, -5.74300071787509),
        (32052.491890297842, 4958.714243585962, -19.16838690651725),
    ]
    true = df.select(ms.ratio("births", "population", 1000, 1000)).first()[0]
    assert math.isclose(true, 29.17013639626705)


def test_births_shares_reproduce_published_figures(spark):
    atomic = spark.createDataFrame(
        [(1714, 2011, "birth_total", 52203.0), (1714, 2011, "birth_girls", 25011.0), (1714, 2011, "birth_boys", 27192.0)],
        "geo_code long, year int, metric_key string, value double",
    )
    assert rows(wh.mart_births_by_sex_yearly(atomic)) == [
        (1714, 2011, 52203.0, 25011.0, 27192.0, 47.91103959542555, 52.08896040457445, 0.0)
    ]


def test_population_split_reproduces_published_figures(spark):
    cells = {"population_total": 2379.5, "population_men": 1203.0, "population_urban": 1434.1, "population_rural": 783.1}
    atomic = spark.createDataFrame(
        [(1714, 2011, "population", k, v) for k, v in cells.items()],
        "geo_code long, year int, metric_group string, metric_key string, value double",
    )
    assert rows(wh.mart_population_split_yearly(atomic)) == [
        (1714, 2011, 2379.5, 1203.0, None, 1434.1, 783.1, None, 162.30000000000018, 1)
    ]


CHECK = Check("c", "t", ("p", "q"), {"axis": "total"})
GRID = "k int, metric_key string, axis string, value double"


def test_reconcile_reads_noise_gaps_and_real_differences(spark):
    df = spark.createDataFrame(
        [
            (1, "t", "total", 0.3), (1, "p", "total", 0.1), (1, "q", "total", 0.2),
            (2, "t", "total", 262.3), (2, "p", "total", 50.0), (2, "q", "total", 50.0),
            (3, "t", "total", 1.0), (3, "p", "total", 1.0),
            (4, "t", "part", 1.0), (5, "other", "total", 1.0),
        ],
        GRID,
    )
    got = {r["k"]: (r["reading"], r["diff"]) for r in quality.reconcile(df, [CHECK], ["k"]).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1][0] == "ok" and got[3] == ("gap", None)
    assert got[2][0] == "investigate" and math.isclose(got[2][1], 162.3)


def test_reconcile_report_equals_single_checks(spark):
    rng = random.Random(3)
    keys = [m for c in checks.CHECKS.values() for m in c.metrics]
    axes = [("total", "total"), ("male", "total"), ("female", "total"), ("total", "urban"), ("total", "rural")]
    data = [(1714000 + rng.randrange(5), 2010 + rng.randrange(3), rng.choice(keys), *rng.choice(axes), float(rng.randrange(9))) for _ in range(400)]
    atomic = spark.createDataFrame(data, "geo_code long, year int, metric_key string, sex string, settlement_type string, value double")
    report = checks.reconciliation_report(atomic)
    for name, check in checks.CHECKS.items():
        one = checks.reconciliation_check(atomic, name)
        assert rows(report.where(F.col("check_name") == name).select("geo_code", "year", "total", "part1", "part2", "diff")) == rows(
            one.select("geo_code", "year", *check.metrics, "diff")
        )


def test_rules_count_rows_and_failures(spark):
    t = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (2, None), (3, "it's")], "k int, v string")
    p = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    report = quality.run_rules(
        {"t": t, "p": p, "s": Slice(t, "v = 'b'")},
        [
            Rule("t", "k", "not_null"), Rule("t", "k", "unique"), Rule("t", "v", "accepted_values", ("a", "it's")),
            Rule("t", "k", "relationships", parent="p", parent_column="id"), Rule("s", "k", "not_null"),
        ],
    )
    assert rows(report) == sorted(
        [
            ("t", "k", "not_null", 5, 1, False), ("t", "k", "unique", 5, 1, False),
            ("t", "v", "accepted_values", 5, 2, False), ("t", "k", "relationships", 5, 2, False),
            ("s", "k", "not_null", 2, 1, False),
        ],
        key=repr,
    )


def test_rules_on_empty_tables_pass(spark):
    t = spark.createDataFrame([], "k int")
    rules = [Rule("t", "k", test, values=(1,), parent="t", parent_column="k") for test in ("not_null", "unique", "accepted_values", "relationships")]
    assert {(r["n_rows"], r["n_failed"], r["passed"]) for r in quality.run_rules({"t": t}, rules).collect()} == {(0, 0, True)}


def test_unknown_rule_is_an_error(spark):
    with pytest.raises(ValueError):
        quality.run_rules({"t": spark.range(1)}, [Rule("t", "id", "positive")])


def test_sixty_one_tests_are_declared():
    kinds = [r.test for r in checks.RULES]
    assert {k: kinds.count(k) for k in set(kinds)} == {"not_null": 48, "unique": 5, "accepted_values": 5, "relationships": 3}


def test_latest_per_key_and_latest_overall_differ(spark):
    df = spark.createDataFrame([(1, 2020, "a"), (1, 2021, "b"), (2, 2019, "c")], "geo int, year int, v string")
    assert rows(summarise.latest_per_key(df, ["geo"], "year")) == [(1, 2021, "b"), (2, 2019, "c")]
    assert rows(summarise.latest_rows(df, "year")) == [(1, 2021, "b")]


def test_latest_per_key_keeps_whole_rows_on_ties(spark):
    df = spark.createDataFrame([(1, 2020, 1, None), (1, 2020, 2, "z"), (1, 2019, 9, "y")], "k int, year int, id int, v string")
    assert rows(summarise.latest_per_key(df, ["k"], "year", ["id"])) == [(1, 2020, 2, "z")]


def test_ranking_puts_missing_last_and_orders_ties(spark):
    df = spark.createDataFrame(
        [(3, "c", 2024, None), (2, "b", 2024, -1.0), (1, "a", 2024, -1.0), (4, "d", 2024, -5.0), (5, "e", 2023, -9.0)],
        "geo_code int, geo_name string, year int, net_mig_per_1000 double",
    )
    assert [r["geo_code"] for r in reports.district_ranking(df).collect()] == [4, 1, 2, 3]


def test_ranking_falls_back_to_net_migration(spark):
    df = spark.createDataFrame([(1, "a", 2024, 2.0), (2, "b", 2024, 1.0)], "geo_code int, geo_name string, year int, net_migration double")
    assert [r["geo_code"] for r in reports.district_ranking(df).collect()] == [2, 1]


def test_cards_keep_missing_figures(spark):
    columns = ["population_total", "birth_total", "death_total", "natural_increase", "net_migration", "cbr_per_1000"]
    df = spark.createDataFrame([(1, 2024, 1234567.9, 10.0, None, -1500.7, 0.0, 29.166)], "geo_code int, year int, " + ", ".join(f"{c} double" for c in columns))
    assert rows(reports.latest_cards(df)) == [(1, 2024, "1,234,567", "10", None, "-1,500", "0", "29.17")]


def test_rolling_average_is_a_range_of_years(spark):
    df = spark.createDataFrame([(1, 2010, 3.0), (1, 2011, 6.0), (1, 2014, 9.0), (1, 2015, None)], "k int, year int, value double")
    assert rows(summarise.rolling_average(df, ["k"], "year", "value", 3, "avg")) == [(1, 2010, 3.0), (1, 2011, 4.5), (1, 2014, 9.0), (1, 2015, 9.0)]


def test_coverage_counts_known_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None)], "k string, value double")
    assert rows(summarise.coverage(df, ["k"])) == [("a", 2, 1)]
    expected = spark.createDataFrame([("a",), ("b",)], "k string")
    assert rows(summarise.coverage_gaps(df, ["k"], expected)) == [("a", 2, 1), ("b", 0, 0)]


def test_duplicates_ignore_missing_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1), (2, 1)], "a int, b int")
    assert rows(summarise.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2)]


def test_text_helpers(spark):
    df = spark.createDataFrame([(' \t"a "" b"\xa0', 5.0)], "s string, x double")
    assert df.select(tx.strip_quotes("s"), tx.code_label("s", F.lit(7)), tx.two_decimals("x")).first()[0] == 'a "" b'
    assert df.select(tx.first_match(F.lit("B tumani SHAHRI"), [("shahri", "city"), ("tumani", "district")], "?")).first()[0] == "city"


def test_hot_key_results_are_whole(spark):
    """One key holds a third of the rows; compared with plain Python."""
    rng = random.Random(1)
    data = [(1 if i % 3 == 0 else rng.randrange(2, 500), 2010 + rng.randrange(5), rng.choice("abc"), float(rng.randrange(100))) for i in range(30000)]
    df = spark.createDataFrame(data, "geo_code int, year int, metric_key string, value double").repartition(8)
    want = {}
    for g, y, k, v in data:
        want.setdefault((g, y), {}).setdefault(k, []).append(v)
    got = {(r["geo_code"], r["year"]): (r["a"], r["b"]) for r in reshape.pivot_max(df, ["geo_code", "year"], {"a": "a", "b": "b"}).collect()}
    assert got == {g: (max(m["a"]) if "a" in m else None, max(m["b"]) if "b" in m else None) for g, m in want.items()}
    total = {}
    for g, y, _, v in data:
        total.setdefault(g, {}).setdefault(y, []).append(v)
    rolled = {(r["geo_code"], r["year"]): r["avg"] for r in summarise.rolling_average(df, ["geo_code"], "year", "value", 2, "avg").collect()}
    for g, by_year in total.items():
        for y in by_year:
            inside = by_year[y] + by_year.get(y - 1, [])
            assert math.isclose(rolled[(g, y)], sum(inside) / len(inside))


def test_the_suite_tests_the_models_themselves(spark):
    """A broken fact and a broken staging table fail, though the atomic table is sound."""
    sf = "/root/testdata/sf0.001"
    models = wh.build_models(spark, star.atomic(spark, sf))
    good = models["fact_population_yearly"]
    bad = good.limit(3).withColumns({"geo_code": F.lit(None).cast("bigint"), "metric_key": F.lit("unknown")})
    staged = spark.createDataFrame([(223, None, "a", None, 1.0)], "dataset_id int, geo_code bigint, geo_name_raw string, year int, value double")
    tables = checks.tested_tables({**models, "fact_population_yearly": bad, "stg_sdmx_223_long": staged})
    rules = [r for r in checks.RULES if r.table in ("fact_population_yearly", "stg_sdmx_223_long")]
    failed = {(r.table_name, r.column_name, r.test) for r in quality.run_rules(tables, rules).where("not passed").collect()}
    assert ("fact_population_yearly", "geo_code", "not_null") in failed
    assert ("fact_population_yearly", "metric_key", "accepted_values") in failed
    assert any(table == "stg_sdmx_223_long" for table, _, _ in failed)


def test_the_suite_sees_every_region_and_rows_without_a_metric(spark, monkeypatch):
    """A null year in a region other than 1714, and a null code in staging that the dictionary join loses."""
    sf, staged_long = "/root/testdata/sf0.001", star.staged_long
    columns = "dataset_id int, geo_code bigint, geo_name_raw string, year int, value double"
    bad = spark.createDataFrame([(226, 1718, "b", None, 1.0), (223, None, "a", 2011, 1.0)], columns)
    monkeypatch.setattr(star, "staged_long", lambda *a: staged_long(*a).unionByName(bad))
    no_223 = seeds.dim_metric(spark).where("dataset_id <> 223")
    monkeypatch.setattr(star.seeds, "dim_metric", lambda spark: no_223)
    failed = {(r.table_name, r.column_name) for r in QUERIES["dq_suite_all"](spark, sf).where("not passed").collect()}
    assert ("mart_region_overview_yearly", "year") in failed
    assert ("mart_metric_coverage", "year") in failed
    assert ("stg_sdmx_223_long", "geo_code") in failed


@pytest.mark.parametrize("name", ["overview_slice", "overview_of_geo"])
def test_the_scope_of_a_report_is_its_own(spark, monkeypatch, name):
    """Without the report's filter, other regions are there."""
    monkeypatch.setattr(reports, "scoped", lambda mart, *a, **k: mart)
    codes = {str(r.geo_code)[:4] for r in QUERIES[name](spark, "/root/testdata/sf0.001").select("geo_code").distinct().collect()}
    assert codes > {"1714"}


# --- prefixes as ranges ---


@given(st.text("0123456789-+ x", max_size=5), st.lists(st.integers(-(2**63), 2**63 - 1) | st.integers(-3000, 3000), max_size=30))
def test_prefix_ranges_are_the_prefix(prefix, numbers):
    ranges = scope.prefix_ranges(prefix)
    for n in [*numbers, 0, -(2**63), 2**63 - 1]:
        assert any(low <= n <= high for low, high in ranges) == str(n).startswith(prefix)


@given(st.integers(-999, 999), st.integers(-(2**31), 2**31 - 1))
def test_prefix_ranges_stay_within_the_type(prefix, number):
    ranges = scope.prefix_ranges(str(prefix), 31)
    assert any(low <= number <= high for low, high in ranges) == str(number).startswith(str(prefix))
    assert all(-(2**31) <= low <= high < 2**31 for low, high in ranges)


def test_prefix_of_codes_of_any_type(spark):
    rows = [(1714, "1714"), (-1714, "-1714"), (None, None), (17, "17"), (171, "0171")]
    for kind in ("int", "bigint"):
        df = spark.createDataFrame(rows, "c bigint, t string").selectExpr(f"cast(c as {kind}) as c", "t")
        assert sorted(r.c for r in scope.in_prefix(df, "171", "c").collect()) == [171, 1714]
        assert [r.c for r in scope.in_prefix(df, "-1", "c").collect()] == [-1714]
        assert scope.in_prefix(df, "1_", "c").count() == 0
        assert [r.t for r in scope.in_prefix(df, "01", "t").collect()] == ["0171"]


def test_prefix_reaches_the_scan(spark, plan, tmp_path):
    spark.range(200_000).selectExpr("id as geo_code").sortWithinPartitions("geo_code").write.parquet(str(tmp_path / "codes"))
    df = scope.in_prefix(spark.read.parquet(str(tmp_path / "codes")), "17149")
    text = plan(df)
    assert "GreaterThanOrEqual(geo_code,17149)" in text and "LessThanOrEqual(geo_code,171499)" in text
    assert df.count() == 11
