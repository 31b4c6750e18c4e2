"""Long table, dimensions, facts and marts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan import fixed_values as fv
from tallyspan.functions.measures import balance, missing_flag, parts_diff, ratio, share
from tallyspan.functions.text import code_number, is_bad_code
from tallyspan.operators import dimension, enrich, reshape, scope, summarise
from tallyspan.sources import seeds
from tallyspan.sources.wide_csv import BROKEN

STAGING_COLUMNS = ["dataset_id", "geo_code", "geo_name_raw", "year", "value"]
YEARS = [str(y) for y in range(fv.FIRST_YEAR, fv.LAST_YEAR + 1)]


def datasets_of(keys: Iterable[str] = (), groups: Iterable[str] = ()) -> list[int]:
    """Ids of the datasets that carry the metrics or metric groups.

    A model that needs a few metrics can thereby open only their sources.
    """
    keys, groups = set(keys), set(groups)
    known = fv.rows(fv.METRIC_DICTIONARY_CSV)
    return [int(r["dataset_id"]) for r in known if r["metric_key"] in keys or r["metric_group"] in groups]


def staging_long(
    wide: DataFrame,
    years: Sequence[str],
    dataset_id: int | None = None,
    code: str = "Code",
    name: str = "Klassifikator",
) -> DataFrame:
    """Wide extract to the long contract, one typed row per known cell.

    Cells that are not numbers become NULL and are dropped here, as are rows
    with a wrong number of fields or a code that is no whole number;
    :func:`rejects` lists them all.
    """
    cells = _raw_cells(wide, years, dataset_id, code, name)
    # not "value is not null": the optimizer would put the whole conversion into the filter and do it again behind it
    return cells.where(_is_number("cell")).withColumn("value", _as_double("cell")).select(*STAGING_COLUMNS)


def rejected_cells(
    wide: DataFrame,
    years: Sequence[str],
    dataset_id: int | None = None,
    code: str = "Code",
    name: str = "Klassifikator",
) -> DataFrame:
    """Filled cells that are not numbers, as found."""
    cells = _raw_cells(wide, years, dataset_id, code, name)
    return cells.where(_is_bad()).select("dataset_id", "geo_code", "geo_name_raw", "year", "cell")


def rejects(wide: DataFrame, years: Sequence[str], code: str = "Code", name: str = "Klassifikator") -> DataFrame:
    """What staging leaves out, and why: ``dataset_id, code, geo_name_raw, year, found, reason``.

    Reasons: ``fields`` (another number of fields than the header, found is the
    raw row), ``code`` (filled, but no whole number) and ``cell`` (filled, but
    no number).
    """
    # One pass: a row is taken apart only where its code, its fields or, as one look at all of them tells, a cell may be at fault.
    years = scope.existing(wide, list(years))
    cells = [F.col(f"`{y}`").cast("string") for y in years]
    suspect = ~F.array_join(F.array(*cells), ",", "").rlike(plain_cells(len(years))) if years else F.lit(False)
    text, at_fault = F.col(code).cast("string"), _is_broken(wide) | is_bad_code(code)
    nothing = F.lit(None).cast("int")

    def item(code: Column, year: Column, found: Column, reason: Column) -> Column:
        return F.struct(code.alias("code"), year.alias("year"), found.alias("found"), reason.alias("reason"))

    broken = F.col(BROKEN) if BROKEN in wide.columns else F.lit(None).cast("string")
    whole = item(text, nothing, F.when(_is_broken(wide), broken).otherwise(text), F.when(_is_broken(wide), F.lit("fields")).otherwise(F.lit("code")))
    number = code_number(code).cast("string")
    single = [item(number, F.lit(y).cast("int"), cell, F.lit("cell")) for y, cell in zip(years, cells, strict=True)]
    bad = F.filter(F.array(*single), lambda x: _is_bad(x["found"])) if single else F.array(whole).cast(ITEMS)
    items = F.when(at_fault, F.array(whole).cast(ITEMS)).otherwise(bad.cast(ITEMS))
    found = wide.where(at_fault | suspect).select(F.col("dataset_id").cast("int").alias("dataset_id"), F.col(name).alias("geo_name_raw"), F.inline(items))
    return found.select("dataset_id", "code", "geo_name_raw", "year", "found", "reason")


ITEMS = "array<struct<code: string, year: int, found: string, reason: string>>"


def plain_cells(n: int) -> str:
    """Pattern of n cells, joined by commas, that are all empty or plain decimals far from the bounds of a double; a comma in a cell does not match."""
    cell = r" *(?:[+-]?\d{1,300}(?:\.\d*)?)? *"
    return rf"^{cell}(?:,{cell}){{{n - 1}}}\z"


#: A decimal number; suffixes, hexadecimal, NaN and infinities are none, nor is what a double cannot hold.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _as_double(cell: str | Column) -> Column:
    return F.btrim(cell).try_cast("double")


def _is_number(cell: str | Column) -> Column:
    """Null for a null cell, and for a number's text that a double cannot be read from."""
    return F.btrim(cell).rlike(NUMBER) & (F.abs(_as_double(cell)) < float("inf"))


def _is_bad(cell: str | Column = "cell") -> Column:
    return (F.btrim(cell) != "") & ~F.coalesce(_is_number(cell), F.lit(False))


def _is_broken(wide: DataFrame) -> Column:
    return F.col(BROKEN).isNotNull() if BROKEN in wide.columns else F.lit(False)


def _raw_cells(wide: DataFrame, years: Sequence[str], dataset_id: int | None, code: str, name: str) -> DataFrame:
    tagged = wide if dataset_id is None else wide.withColumn("dataset_id", F.lit(dataset_id))
    tagged = tagged.where(~_is_broken(tagged) & ~is_bad_code(code))
    present = scope.existing(tagged, list(years))
    # what a row's cells share is read once per row
    rows = tagged.select(
        F.col("dataset_id").cast("int").alias("dataset_id"), code_number(code).alias("geo_code"), F.col(name).alias("geo_name_raw"), *[f"`{y}`" for y in present]
    )
    long = reshape.unpivot_long(rows, ["dataset_id", "geo_code", "geo_name_raw"], present, "year", "cell", "string")
    return long.withColumn("year", F.col("year").cast("int"))


def demography_atomic(long: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The single conformed table: long rows with their metric's meaning."""
    known = enrich.enrich_from_dictionary(long, dictionary)
    return known.select(
        "dataset_id", "geo_code", "geo_name_raw", "year",
        "metric_group", "metric_key", "sex", "settlement_type", "value",
    )


#: The stored table's partitions: a mart opens only its own metrics, a rebuild only its own datasets.
PARTITIONS = ["metric_key", "dataset_id"]


def write_atomic(atomic: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Store the conformed table for all later reads.

    Partitioned by metric and dataset, so a mart opens only its own metrics;
    sorted within each task by code, which puts a region's codes of one length
    side by side, so a region scope skips row groups and pages. A local sort
    only: no exchange, hence no hot partition when one metric or region
    dominates. ``dynamic`` replaces only the partitions that the rows are in.
    """
    (
        scope.with_region_code(atomic)
        .sortWithinPartitions(*PARTITIONS, "geo_code")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


#: As stored, so that a table without rows can be read, too.
ATOMIC = (
    "dataset_id int, geo_code bigint, geo_name_raw string, year int, metric_group string, sex string, "
    "settlement_type string, value double, region_code string, metric_key string"
)


def read_atomic(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema(ATOMIC).parquet(path)
    return stored.select(*[field.split()[0] for field in ATOMIC.split(", ")])


def dim_geo(atomic: DataFrame, overrides: DataFrame) -> DataFrame:
    """Geographies found in the facts, with clean names and levels."""
    return dim_geo_of(dimension.discover_dimension(atomic, "geo_code", "geo_name_raw"), overrides)


def dim_geo_of(base: DataFrame, overrides: DataFrame) -> DataFrame:
    """The dimension over one raw name per geography."""
    named = dimension.override_names(base, overrides, "geo_code", "geo_name_raw", "geo_name_clean", "geo_name")
    levelled = dimension.classify(named, "geo_name_raw", fv.GEO_LEVEL_PATTERNS, fv.GEO_LEVEL_UNKNOWN, "geo_level")
    return levelled.select("geo_code", "geo_name", "geo_level")


def fact_population_yearly(atomic: DataFrame) -> DataFrame:
    """Stock fact."""
    stock = scope.slice_on(atomic, metric_group=fv.STOCK_GROUP)
    kept = {c: c for c in ["geo_code", "year", "metric_key", "sex", "settlement_type"]}
    return scope.rename_only(stock, {**kept, "value": "population_cnt"})


def fact_demography_flows_yearly(atomic: DataFrame, groups: Sequence[str] = fv.FLOW_GROUPS) -> DataFrame:
    """Flow fact. ``fv.PUBLISHED_FLOW_GROUPS`` gives the published literal filter."""
    flows = scope.keys_in(atomic, "metric_group", groups)
    kept = {c: c for c in ["geo_code", "year", "metric_group", "metric_key", "sex", "settlement_type"]}
    return scope.rename_only(flows, {**kept, "value": "event_cnt"})


def mart_region_overview_yearly(
    atomic: DataFrame,
    geo: DataFrame,
    prefix: str | None = fv.DEFAULT_GEO_PREFIX,
    population_unit: float = 1.0,
) -> DataFrame:
    """Headline measures and rates per geography and year.

    The dimension joins after the pivot, when the rows are fewest.
    ``population_unit=1`` reproduces the published rates; the source counts
    population in thousands, so ``1000`` gives true rates per 1000 people.
    """
    rows = scope.slice_on(scope.in_region(atomic, prefix), sex="total", settlement_type="total")
    rows = scope.keys_in(rows, "metric_key", fv.OVERVIEW_MEASURES)
    wide = reshape.pivot_max(rows, ["geo_code", "year"], {m: m for m in fv.OVERVIEW_MEASURES})
    named = enrich.lookup(wide, scope.in_prefix(geo, prefix), "geo_code", "left")
    return named.select(
        "geo_code", "geo_name", "geo_level", "year",
        *fv.OVERVIEW_MEASURES,
        balance("birth_total", "death_total").alias("natural_increase"),
        balance("in_migration", "out_migration").alias("net_migration"),
        ratio("birth_total", "population_total", 1000, population_unit).alias("cbr_per_1000"),
        ratio("death_total", "population_total", 1000, population_unit).alias("cdr_per_1000"),
        ratio(balance("in_migration", "out_migration"), "population_total", 1000, population_unit)
        .alias("net_mig_per_1000"),
    )


def mart_population_split_yearly(atomic: DataFrame, prefix: str | None = fv.DEFAULT_GEO_PREFIX) -> DataFrame:
    """Population by sex and by settlement, with differences and a gap flag."""
    rows = scope.slice_on(scope.in_region(atomic, prefix), metric_group=fv.STOCK_GROUP)
    rows = scope.keys_in(rows, "metric_key", fv.POPULATION_MEASURES)
    wide = reshape.pivot_max(rows, ["geo_code", "year"], {m: m for m in fv.POPULATION_MEASURES})
    return wide.select(
        "*",
        parts_diff("population_total", ["population_men", "population_women"]).alias("sex_diff"),
        parts_diff("population_total", ["population_urban", "population_rural"]).alias("settlement_diff"),
        missing_flag("population_women").alias("missing_women_flag"),
    )


def mart_births_by_sex_yearly(atomic: DataFrame, prefix: str | None = fv.DEFAULT_GEO_PREFIX) -> DataFrame:
    """Births by sex with shares and the difference to the total."""
    rows = scope.keys_in(scope.in_region(atomic, prefix), "metric_key", list(fv.BIRTH_MEASURES.values()))
    wide = reshape.pivot_max(rows, ["geo_code", "year"], fv.BIRTH_MEASURES)
    return wide.select(
        "*",
        share("birth_girls", "total_birth_yearly").alias("share_girls"),
        share("birth_boys", "total_birth_yearly").alias("share_boys"),
        parts_diff("total_birth_yearly", ["birth_girls", "birth_boys"]).alias("sex_diff"),
    )


def mart_metric_coverage(atomic: DataFrame, prefix: str | None = fv.DEFAULT_GEO_PREFIX) -> DataFrame:
    """Rows and known values per metric and year."""
    return summarise.coverage(scope.in_region(atomic, prefix), ["metric_key", "year"])


MARTS = [
    "mart_region_overview_yearly",
    "mart_population_split_yearly",
    "mart_births_by_sex_yearly",
    "mart_metric_coverage",
]


def build_models(
    spark: SparkSession, atomic: DataFrame, prefix: str | None = fv.DEFAULT_GEO_PREFIX, geo: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every model above the atomic table, by its published name."""
    geo = dim_geo(atomic, seeds.geo_override(spark)) if geo is None else geo
    return {
        "int_demography_atomic": atomic,
        "dim_geo": geo,
        "dim_metric": seeds.dim_metric(spark),
        "geo_override": seeds.geo_override(spark),
        "dim_sex": seeds.dim_sex(spark),
        "dim_settlement_type": seeds.dim_settlement_type(spark),
        "fact_population_yearly": fact_population_yearly(atomic),
        "fact_demography_flows_yearly": fact_demography_flows_yearly(atomic),
        "mart_region_overview_yearly": mart_region_overview_yearly(atomic, geo, prefix),
        "mart_population_split_yearly": mart_population_split_yearly(atomic, prefix),
        "mart_births_by_sex_yearly": mart_births_by_sex_yearly(atomic, prefix),
        "mart_metric_coverage": mart_metric_coverage(atomic, prefix),
    }
