"""The warehouse's declared tests and reconciliation checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tallyspan import fixed_values as fv
from tallyspan.functions.measures import missing_flag
from tallyspan.operators import scope, summarise
from tallyspan.operators.quality import (
    REPORT,
    Check,
    Observed,
    Rule,
    Slice,
    check_table,
    contract,
    reconcile,
    row_rules,
    run_rules,
    sql_literal,
)

KEYS = ["geo_code", "year"]
ATOMIC_GRAIN = ["geo_code", "year", "metric_key", "sex", "settlement_type"]

# Each check keeps only the total of the axis it does not split.
CHECKS = {
    c.name: c
    for c in [
        Check("births_total_vs_girls_boys", "birth_total", ("birth_girls", "birth_boys"),
              {"settlement_type": "total"}),
        Check("deaths_total_vs_women_men", "death_total", ("death_women", "death_men"),
              {"settlement_type": "total"}),
        Check("population_total_vs_men_women", "population_total", ("population_men", "population_women"),
              {"settlement_type": "total"}),
        Check("population_total_vs_urban_rural", "population_total", ("population_urban", "population_rural"),
              {"sex": "total"}),
        Check("marriages_total_vs_urban_rural", "marriages_total", ("marriages_urban", "marriages_rural"),
              {"sex": "total"}),
        Check("divorces_total_vs_urban_rural", "divorces_total", ("divorces_urban", "divorces_rural"),
              {"sex": "total"}),
    ]
}

# As published, three checks cannot find their parts: two slice away the parts'
# own sex, one asks for metric keys the dictionary does not have.
PUBLISHED_CHECKS = {
    **CHECKS,
    "births_total_vs_girls_boys": Check(
        "births_total_vs_girls_boys", "birth_total", ("birth_girls", "birth_boys"),
        {"sex": "total", "settlement_type": "total"}),
    "deaths_total_vs_women_men": Check(
        "deaths_total_vs_women_men", "death_total", ("death_women", "death_men"),
        {"sex": "total", "settlement_type": "total"}),
    "divorces_total_vs_urban_rural": Check(
        "divorces_total_vs_urban_rural", "divorce_total", ("divorce_urban", "divorce_rural"),
        {"sex": "total"}),
}


def reconciliation_check(
    atomic: DataFrame, name: str, prefix: str | None = fv.DEFAULT_GEO_PREFIX, checks: Mapping[str, Check] = CHECKS
) -> DataFrame:
    """One check with its own measure names."""
    out = check_table(scope.in_region(atomic, prefix), checks[name], KEYS)
    if name == "population_total_vs_men_women":
        out = out.withColumn("missing_women_flag", missing_flag("population_women"))
    return out


def reconciliation_report(atomic: DataFrame, prefix: str | None = fv.DEFAULT_GEO_PREFIX, tolerance: float = 1e-6) -> DataFrame:
    """All checks in one pass."""
    return reconcile(scope.in_region(atomic, prefix), list(CHECKS.values()), KEYS, tolerance=tolerance)


TESTED_STAGING = [223, 224, 225, 226, 227, 242, 268]
_GROUPS = (fv.STOCK_GROUP, *fv.FLOW_GROUPS)
_LEVELS = tuple(label for _, label in fv.GEO_LEVEL_PATTERNS) + (fv.GEO_LEVEL_UNKNOWN,)


def _required(table: str, *columns: str) -> list[Rule]:
    return [Rule(table, c, "not_null") for c in columns]


RULES: list[Rule] = [
    *_required("dim_metric", "dataset_id", "metric_group", "metric_key"),
    Rule("dim_metric", "dataset_id", "unique"),
    Rule("dim_metric", "metric_group", "accepted_values", _GROUPS),
    *_required("geo_override", "geo_code", "geo_name_clean"),
    Rule("geo_override", "geo_code", "unique"),
    *contract(
        [f"stg_sdmx_{i}_long" for i in TESTED_STAGING],
        {"dataset_id": ["not_null"], "geo_code": ["not_null"], "year": ["not_null"]},
    ),
    *_required("int_demography_atomic", "geo_code", "dataset_id", "year", "metric_group", "metric_key",
               "sex", "settlement_type"),
    Rule("int_demography_atomic", "metric_group", "accepted_values", _GROUPS),
    Rule("int_demography_atomic", "geo_code", "relationships", parent="dim_geo", parent_column="geo_code"),
    Rule("int_demography_atomic", "sex", "relationships", parent="dim_sex", parent_column="sex_id"),
    Rule("int_demography_atomic", "settlement_type", "relationships", parent="dim_settlement_type",
         parent_column="settlement_type_id"),
    *_required("dim_geo", "geo_code", "geo_name", "geo_level"),
    Rule("dim_geo", "geo_code", "unique"),
    Rule("dim_geo", "geo_level", "accepted_values", _LEVELS),
    *_required("dim_sex", "sex_id"),
    Rule("dim_sex", "sex_id", "unique"),
    *_required("dim_settlement_type", "settlement_type_id"),
    Rule("dim_settlement_type", "settlement_type_id", "unique"),
    *_required("fact_population_yearly", "geo_code", "year", "metric_key"),
    Rule("fact_population_yearly", "metric_key", "accepted_values", tuple(fv.POPULATION_MEASURES)),
    *_required("fact_demography_flows_yearly", "metric_group"),
    Rule("fact_demography_flows_yearly", "metric_group", "accepted_values", tuple(fv.FLOW_GROUPS)),
    *_required("mart_region_overview_yearly", "geo_code", "year"),
    *_required("mart_population_split_yearly", "geo_code", "year"),
    *_required("mart_metric_coverage", "metric_key", "year"),
]


def tested_tables(models: Mapping[str, DataFrame], staging: DataFrame | None = None) -> dict[str, DataFrame | Slice]:
    """The models as they are, and the staging tables.

    A staging table among the models is tested itself, else as its dataset's
    rows of ``staging``, all of them in one pass. Without ``staging`` the atomic
    rows stand in, where rows that found no metric in the dictionary are not
    among those.
    """
    rows = models["int_demography_atomic"] if staging is None else staging
    staged = {f"stg_sdmx_{i}_long": Slice(rows, f"dataset_id = {i}") for i in TESTED_STAGING}
    return {**staged, **models}


#: Tables that are row slices of the stored atomic table.
FACTS = {
    "fact_population_yearly": f"metric_group = {sql_literal(fv.STOCK_GROUP)}",
    "fact_demography_flows_yearly": f"metric_group in ({', '.join(map(sql_literal, fv.FLOW_GROUPS))})",
}


def observed_staging(staging: DataFrame) -> Observed:
    """The row tests of all staging tables, counted on the staged rows before any lookup."""
    return Observed(staging, row_rules(RULES, {f"stg_sdmx_{i}_long": f"dataset_id = {i}" for i in TESTED_STAGING}))


def observed_atomic(atomic: DataFrame) -> Observed:
    """The row tests of the atomic table and of the facts, its slices."""
    return Observed(atomic, row_rules(RULES, {"int_demography_atomic": "true", **FACTS}))


def observed_model(name: str, model: DataFrame) -> Observed:
    """The row tests of one written model."""
    return Observed(model, row_rules(RULES, {name: "true"}))


def finished_report(spark: SparkSession, models: Mapping[str, DataFrame], written: Sequence[tuple]) -> DataFrame:
    """The whole report: what was counted while the models were written, and the tests that need a scan of their own.

    Scanned are keys (unique, relationships) and the few rows of the seeds.
    """
    done = {tuple(row[:3]) for row in written}
    rest = [r for r in RULES if (r.table, r.column, r.test) not in done]
    return spark.createDataFrame(list(written), REPORT).union(run_rules(models, rest))


def duplicate_grain(atomic: DataFrame) -> DataFrame:
    """Rows of the atomic table that share a grain, which a max-pivot would hide."""
    return summarise.duplicate_keys(atomic, ATOMIC_GRAIN)
