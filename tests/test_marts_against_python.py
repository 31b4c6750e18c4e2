"""Marts over random rows with duplicates and gaps, recomputed in plain Python."""

import random

import pytest

from tallyspan import fixed_values as fv
from tallyspan.plans import checks
from tallyspan.plans import warehouse as wh
from tallyspan.sources import seeds

META = {int(r["dataset_id"]): r for r in fv.rows(fv.METRIC_DICTIONARY_CSV)}
OVERRIDES = {int(r["geo_code"]): r["geo_name_clean"] for r in fv.rows(fv.GEO_OVERRIDE_CSV)}
GEOS = [1714, 1714401, 1714207, 1714999, 1714777, 1718, 17]


@pytest.fixture(scope="module", params=[1, 2])
def case(request, spark):
    rng = random.Random(request.param)
    names = ["x shahri", "Y TUMANI", "z viloyati", "w respublikasi", "v"]
    long = []
    for _ in range(2500):
        # One geography holds a third of the rows.
        geo = 1714 if rng.random() < 0.33 else rng.choice(GEOS)
        value = float(rng.choice([0, 0, rng.randrange(1, 50), rng.randrange(50, 900) / 10]))
        long.append((rng.choice([*META, 777]), geo, rng.choice(names), rng.randrange(2010, 2016), value))
    df = spark.createDataFrame(long, "dataset_id int, geo_code long, geo_name_raw string, year int, value double")
    return wh.demography_atomic(df, seeds.dim_metric(spark)), [r for r in long if r[0] in META]


def in_scope(code):
    return str(code).startswith("1714")


def pivot(long, wanted):
    out = {}
    for dataset, geo, _, year, value in long:
        key = META[dataset]["metric_key"]
        if in_scope(geo) and key in wanted:
            cell = out.setdefault((geo, year), {})
            cell[key] = max(cell.get(key, value), value)
    return out


def minus(a, *parts):
    if a is None or any(p is None for p in parts):
        return None
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return a - total


def per(a, b, scale):
    return None if a is None or not b else a / b * scale


def as_map(df, *skip):
    columns = [c for c in df.columns if c not in ("geo_code", "year", *skip)]
    return {(r["geo_code"], r["year"]): tuple(r[c] for c in columns) for r in df.collect()}


def test_dim_geo(case, spark):
    atomic, long = case
    levels = {"shahri": "shahar", "tumani": "tuman", "viloyati": "viloyat", "respublikasi": "respublika"}
    want = {}
    for geo in {r[1] for r in long}:
        raw = min(r[2] for r in long if r[1] == geo)
        level = next((v for k, v in levels.items() if k in raw.lower()), "nomalum")
        want[geo] = (OVERRIDES.get(geo, raw), level)
    geo = wh.dim_geo(atomic, seeds.geo_override(spark))
    assert {r["geo_code"]: (r["geo_name"], r["geo_level"]) for r in geo.collect()} == want


def test_overview(case, spark):
    atomic, long = case
    geo = wh.dim_geo(atomic, seeds.geo_override(spark))
    got = as_map(wh.mart_region_overview_yearly(atomic, geo), "geo_name", "geo_level")
    want = {}
    for k, m in pivot(long, fv.OVERVIEW_MEASURES).items():
        pop, births, deaths, arrived, left = (m.get(c) for c in fv.OVERVIEW_MEASURES[:5])
        moved = minus(arrived, left)
        want[k] = (
            *[m.get(c) for c in fv.OVERVIEW_MEASURES], minus(births, deaths), moved,
            per(births, pop, 1000), per(deaths, pop, 1000), per(moved, pop, 1000),
        )
    assert got == want


def test_split_births_and_coverage(case):
    atomic, long = case
    want = {}
    for k, m in pivot(long, fv.POPULATION_MEASURES).items():
        total, men, women, urban, rural = (m.get(c) for c in fv.POPULATION_MEASURES)
        want[k] = (total, men, women, urban, rural, minus(total, men, women), minus(total, urban, rural), int(women is None))
    assert as_map(wh.mart_population_split_yearly(atomic)) == want
    want = {}
    for k, m in pivot(long, fv.BIRTH_MEASURES.values()).items():
        total, girls, boys = (m.get(c) for c in fv.BIRTH_MEASURES.values())
        want[k] = (total, girls, boys, per(girls, total, 100), per(boys, total, 100), minus(total, girls, boys))
    assert as_map(wh.mart_births_by_sex_yearly(atomic)) == want
    counts = {}
    for dataset, geo, _, year, _ in long:
        if in_scope(geo):
            key = (META[dataset]["metric_key"], year)
            counts[key] = counts.get(key, 0) + 1
    got = {(r["metric_key"], r["year"]): r["rows_cnt"] for r in wh.mart_metric_coverage(atomic).collect()}
    assert got == counts


def test_checks(case):
    atomic, long = case
    report = {}
    for r in checks.reconciliation_report(atomic).collect():
        report.setdefault(r["check_name"], {})[(r["geo_code"], r["year"])] = (r["total"], r["part1"], r["part2"], r["diff"])
    for name, check in checks.CHECKS.items():
        want = {k: (*[m.get(c) for c in check.metrics], minus(*[m.get(c) for c in check.metrics])) for k, m in pivot(long, check.metrics).items()}
        assert report[name] == want


def test_duplicate_grain(case):
    atomic, long = case
    seen = {}
    for dataset, geo, _, year, _ in long:
        seen[(geo, year, META[dataset]["metric_key"])] = seen.get((geo, year, META[dataset]["metric_key"]), 0) + 1
    got = {(r["geo_code"], r["year"], r["metric_key"]): r["row_count"] for r in checks.duplicate_grain(atomic).collect()}
    assert got == {k: n for k, n in seen.items() if n > 1}
