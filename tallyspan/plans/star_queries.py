"""Every operator and model as a named query over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan import fixed_values as fv
from tallyspan.functions import measures as ms
from tallyspan.functions import text as tx
from tallyspan.operators import dimension, enrich, quality, reshape, scope, summarise
from tallyspan.operators.quality import Rule
from tallyspan.plans import checks, ingest, refresh, reports, star
from tallyspan.plans import warehouse as wh
from tallyspan.session import new_shared_path
from tallyspan.sources import audit as fa
from tallyspan.sources import catalog, export, manifest, seeds, wide_csv

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- shared inputs -----------------------------------------------------------


def _geo(spark: SparkSession, sf: str) -> DataFrame:
    return wh.dim_geo(star.atomic(spark, sf), seeds.geo_override(spark))


def _overview(spark: SparkSession, sf: str, prefix: str | None = fv.DEFAULT_GEO_PREFIX, population_unit: float = 1.0) -> DataFrame:
    # The dimension needs every dataset, so both read the same rows and share their exchange.
    atomic = star.atomic(spark, sf)
    geo = wh.dim_geo(atomic, seeds.geo_override(spark))
    return wh.mart_region_overview_yearly(atomic, geo, prefix, population_unit)


def _split(spark: SparkSession, sf: str, prefix: str | None = fv.DEFAULT_GEO_PREFIX) -> DataFrame:
    return wh.mart_population_split_yearly(star.atomic(spark, sf, fv.POPULATION_MEASURES), prefix)


def _births(spark: SparkSession, sf: str, prefix: str | None = fv.DEFAULT_GEO_PREFIX) -> DataFrame:
    return wh.mart_births_by_sex_yearly(star.atomic(spark, sf, fv.BIRTH_MEASURES.values()), prefix)


def _stored_atomic(spark: SparkSession, sf: str) -> DataFrame:
    """The atomic table written to the shared folder, for plans that read it often."""
    path = new_shared_path(spark, "atomic")
    wh.write_atomic(star.atomic(spark, sf), path)
    return wh.read_atomic(spark, path)


def _written_extracts(spark: SparkSession, sf: str) -> dict[int, str]:
    """All datasets as wide CSV in the shared folder; id to path."""
    path = new_shared_path(spark, "extracts")
    wide_csv.write_wide(star.wide_extracts(spark, sf), path)
    return wide_csv.registry(path, star.DATASETS, wide_csv.WRITTEN_NAMING)


def _table(name: str) -> Query:
    return lambda spark, sf: star.read_table(spark, sf, name)


_orders, _lineitem, _customer = _table("orders"), _table("lineitem"), _table("customer")


# --- reshape -----------------------------------------------------------------


def _rates(spark: SparkSession, sf: str) -> DataFrame:
    zero = F.lit(0.0)
    return _lineitem(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_discount", zero).alias("discount"),
        F.nullif("l_tax", zero).alias("tax"),
    )


@query
def unpivot_drop_nulls(spark, sf):
    return reshape.unpivot_long(_rates(spark, sf), ["l_orderkey", "l_linenumber"], ["discount", "tax"], "rate")


@query
def unpivot_keep_nulls(spark, sf):
    return reshape.unpivot_long(
        _rates(spark, sf), ["l_orderkey", "l_linenumber"], ["discount", "tax"], "rate", keep_nulls=True
    )


@query
def unpivot_restricted_years(spark, sf):
    late = [y for y in wh.YEARS if int(y) >= fv.DATASET_FIRST_YEAR[244]]
    return wh.staging_long(star.wide_extracts(spark, sf), late)


@query
def staging_contract(spark, sf):
    return wh.staging_long(star.wide_extracts(spark, sf), wh.YEARS)


@query
def conditional_pivot(spark, sf):
    return reshape.pivot_max(
        _lineitem(spark, sf), ["l_orderkey"], {"qty_a": "A", "qty_r": "R"}, "l_returnflag", "l_quantity"
    )


def _text_cells(spark: SparkSession, sf: str) -> DataFrame:
    part = star.read_table(spark, sf, "part")
    return part.select(
        F.col("p_partkey").alias("Code"),
        F.col("p_name").alias("Klassifikator"),
        F.col("p_size").cast("string").alias("2010"),
        F.col("p_type").alias("2011"),
        F.lit(None).cast("string").alias("2012"),
        F.lit(" ").alias("2013"),
    )


@query
def typed_cells(spark, sf):
    return wh.staging_long(_text_cells(spark, sf), wh.YEARS, 223)


@query
def rejected_cells(spark, sf):
    return wh.rejected_cells(_text_cells(spark, sf), wh.YEARS, 223)


# --- sources and sinks -------------------------------------------------------


@query
def csv_extracts_to_atomic(spark, sf):
    return ingest.build_atomic(spark, _written_extracts(spark, sf)).drop("region_code")


def _rough_extracts(spark: SparkSession, sf: str) -> dict[int, str]:
    """Parts as an extract with bad codes, text cells and names over two lines, and one with good codes."""
    code = F.col("p_partkey").cast("string")
    part = star.read_table(spark, sf, "part")
    bad = F.when(F.col("p_partkey") % 10 == 0, F.concat(code, F.lit("x"))).otherwise(code)
    path = new_shared_path(spark, "rough-extracts")
    wide_csv.write_wide(
        part.select(
            F.explode(F.array(F.struct(F.lit(223).alias("dataset_id"), bad.alias("Code")), F.struct(F.lit(224).alias("dataset_id"), code.alias("Code")))).alias("row"),
            F.concat("p_name", F.lit('\n"second", line')).alias("Klassifikator"),
            F.col("p_size").cast("string").alias("2010"),
            F.col("p_type").alias("2011"),
        ).select("row.*", "Klassifikator", "2010", "2011"),
        path,
    )
    return wide_csv.registry(path, [223, 224], wide_csv.WRITTEN_NAMING)


@query
def csv_rejects(spark, sf):
    """What a scan leaves out of a rough extract."""
    return ingest.scan_rejected(spark, {223: _rough_extracts(spark, sf)[223]})


@query
def csv_line_breaks(spark, sf):
    """What a scan reads of rough extracts, names over two lines kept."""
    return ingest.scan_staging(spark, _rough_extracts(spark, sf))


@query
def raw_rough_tables(spark, sf):
    """Raw tables over rough extracts: text codes where one is no number, else numbers."""
    names = catalog.register_sources(spark, _rough_extracts(spark, sf), "raw_rough", new_shared_path(spark, "raw-schema"))
    return enrich.union_sources(
        spark.table(name).select(
            F.lit(name).alias("table_name"), F.lit(dict(spark.table(name).dtypes)["Code"]).alias("code_type"),
            F.col("Code").cast("string").alias("code"), F.col("Klassifikator").alias("name"), F.col("2010").alias("y2010"), F.col("2011").alias("y2011"),
        )
        for name in names
    )


@query
def raw_source_tables(spark, sf):
    """The raw tables as registered, one per dataset."""
    names = catalog.register_sources(spark, _written_extracts(spark, sf), "raw", new_shared_path(spark, "raw-schema"))
    years = [f"cast(`{y}` as double) as y{y}" for y in wh.YEARS]
    return enrich.union_sources(
        spark.table(name).selectExpr(f"'{name}' as table_name", "Code as code", "Klassifikator as klassifikator", *years)
        for name in names
    )


@query
def staging_views(spark, sf):
    """All staging views by name, put together again."""
    long = _stored_atomic(spark, sf).select(*wh.STAGING_COLUMNS)
    return enrich.union_sources(spark.table(name) for name in catalog.register_staging_views(long))


@query
def manifest_rows(spark, sf):
    pages = star.read_table(spark, sf, "pages")
    path = new_shared_path(spark, "manifest")
    quoted = F.concat(F.lit(' "'), F.col("url"), F.lit('" '))
    pages.select(
        F.col("page_id").alias(" dataset_id "), quoted.alias("url"),
        F.format_string("page_%d.html", F.col("page_id")).alias("filename"), F.lit("yearly").alias("periodicity"),
    ).write.csv(path, header=True, sep="\t", quote="", escape="\\")
    return manifest.read_manifest(spark, path)


@query
def manifest_records(spark, sf):
    """A manifest whose notes hold line breaks, quotes and delimiters."""
    pages = star.read_table(spark, sf, "pages")
    path = new_shared_path(spark, "manifest")
    note = F.concat(F.lit("line one of "), F.col("page_id"), F.lit(';\n"line two", with, commas'))
    pages.select(
        F.col("page_id").alias("dataset_id"), "url", F.format_string("page_%d.html", F.col("page_id")).alias("filename"), note.alias("notes"),
    ).write.csv(path, header=True, escape='"')
    return manifest.read_manifest(spark, path)


def _extract_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Audit of the written extracts against a manifest of all catalogued datasets."""
    landed = list(_written_extracts(spark, sf).values())
    expected = seeds.dim_metric(spark).select(
        F.col("dataset_id").cast("string").alias("dataset_id"),
        F.format_string("sdmx_data_%d.csv", F.col("dataset_id")).alias("filename"),
        "metric_key",
    )
    filename = F.concat(F.regexp_extract("path", "source=([^/]+)/", 1), F.lit(".csv"))
    path = new_shared_path(spark, "audit")
    fa.write_audit(fa.audit(spark, expected, landed, filename=filename), path)
    return spark.read.schema(
        "dataset_id string, metric_key string, status string, bytes bigint, digest string, "
        "rows bigint, cols int, columns array<string>, profile_error string"
    ).json(path)


@query
def file_audit(spark, sf):
    return (
        _extract_audit(spark, sf)
        .groupBy("dataset_id", "metric_key")
        .agg(
            F.max("status").alias("status"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.max("cols").alias("cols"),
            F.max(F.element_at("columns", 2)).alias("second_column"),
            F.count_if(F.length("digest") == 64).alias("digests"),
            F.count("bytes").alias("files"),
        )
        .select("dataset_id", "metric_key", "status", "rows", "cols", "second_column",
                (F.col("digests") == F.col("files")).alias("all_digested"))
    )


@query
def audit_tally(spark, sf):
    per_item = _extract_audit(spark, sf).groupBy("dataset_id").agg(F.max("status").alias("status"))
    return fa.audit_tally(per_item)


def _exported(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    atomic, geo = _stored_atomic(spark, sf), new_shared_path(spark, "dim_geo")
    wh.dim_geo(atomic, seeds.geo_override(spark)).write.parquet(geo)
    models = wh.build_models(spark, atomic, None, spark.read.parquet(geo))
    catalog.register_views({name: models[name] for name in wh.MARTS})
    out = new_shared_path(spark, "export")
    return export.export_tables(spark, [*wh.MARTS, "mart_not_built"], out), out


@query
def export_status(spark, sf):
    return _exported(spark, sf)[0]


@query
def export_roundtrip(spark, sf):
    _, out = _exported(spark, sf)
    mart = spark.table("mart_births_by_sex_yearly")
    return spark.read.schema(mart.schema).csv(f"{out}/mart_births_by_sex_yearly", header=True, escape='"')


@query
def optional_table(spark, sf):
    catalog.register_views({"mart_births_by_sex_yearly": _births(spark, sf, None)})
    spark.catalog.dropTempView("mart_not_built")
    present = {n: catalog.optional_table(spark, n) for n in ["mart_births_by_sex_yearly", "mart_not_built"]}
    return enrich.union_sources(
        df.select(F.lit(name).alias("table_name"), "geo_code", "year") for name, df in present.items() if df is not None
    )


@query
def stored_atomic_slice(spark, sf):
    rows = scope.in_region(_stored_atomic(spark, sf), "1714")
    return scope.keys_in(rows, "metric_key", fv.OVERVIEW_MEASURES).drop("region_code")


# --- long table, lookups, union ----------------------------------------------


@query
def union_by_name(spark, sf):
    def party(table: str, p: str, name: str, value: str, dataset_id: int) -> DataFrame:
        return star.read_table(spark, sf, table).select(
            F.lit(dataset_id).alias("dataset_id"), F.col(p).alias("code"), F.col(name).alias("name"),
            F.col(value).alias("value"),
        )

    return enrich.union_sources(
        [
            party("customer", "c_custkey", "c_name", "c_acctbal", 1),
            party("supplier", "s_suppkey", "s_name", "s_acctbal", 2),
            party("part", "p_partkey", "p_name", "p_retailprice", 3).select("value", "name", "code", "dataset_id"),
        ]
    )


@query
def dictionary_enrichment(spark, sf):
    meaning = seeds.packaged(
        spark, "flag,label,settlement_type\nA,accepted,urban\nR,returned,\n",
        "flag string, label string, settlement_type string",
    )
    lines = _lineitem(spark, sf).select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("flag"))
    return enrich.enrich_from_dictionary(
        lines, meaning, "flag", ["label", "settlement_type"], {"settlement_type": "total"}
    )


@query
def int_demography_atomic(spark, sf):
    return star.atomic(spark, sf)


@query
def label_counts(spark, sf):
    """Rows of the atomic table per sex and settlement label, with display order."""
    counted = star.atomic(spark, sf).groupBy("sex", "settlement_type").agg(F.count(F.lit(1)).alias("row_count"))
    sex = seeds.dim_sex(spark).withColumnsRenamed({"sex_id": "sex", "sort_order": "sex_order"})
    place = seeds.dim_settlement_type(spark).withColumnsRenamed(
        {"settlement_type_id": "settlement_type", "sort_order": "settlement_order"}
    )
    return enrich.lookup(enrich.lookup(counted, sex, "sex", "left"), place, "settlement_type", "left")


# --- scope -------------------------------------------------------------------


@query
def prefix_scope(spark, sf):
    return scope.in_prefix(_orders(spark, sf).select("o_orderkey", "o_custkey"), " 14 ", "o_custkey")


@query
def prefix_of_signed_codes(spark, sf):
    """A longer prefix on codes of either sign, some of them null."""
    signed = F.when(F.col("o_orderkey") % 7 == 0, None).when(F.col("o_orderkey") % 2 == 0, -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    rows = _orders(spark, sf).select("o_orderkey", signed.alias("code"))
    return enrich.union_sources(scope.in_prefix(rows, p, "code").withColumn("prefix", F.lit(p)) for p in ("-12", "123", "-", "0", "1x"))


@query
def prefix_blank_default(spark, sf):
    return scope.in_prefix(star.staged_long(spark, sf), "  ")


@query
def total_axes_slice(spark, sf):
    rows = scope.slice_on(star.atomic(spark, sf, fv.OVERVIEW_MEASURES), sex="total", settlement_type="total")
    return scope.keys_in(rows, "metric_key", fv.OVERVIEW_MEASURES).select("geo_code", "year", "metric_key", "value")


@query
def year_range_orders(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey", F.year("o_orderdate").alias("year"))
    return scope.year_range(orders, 1996, 1998)


@query
def existing_columns(spark, sf):
    customer = _customer(spark, sf)
    return customer.select(*scope.existing(customer, ["c_custkey", "c_phone", "c_mktsegment"]))


# --- dimensions --------------------------------------------------------------


@query
def representative_name(spark, sf):
    lines = _lineitem(spark, sf).select("l_suppkey", F.concat("l_returnflag", "l_linestatus").alias("name"))
    return dimension.discover_dimension(lines, "l_suppkey", "name")


@query
def name_override(spark, sf):
    places = star.staged_long(spark, sf).select("geo_code", "geo_name_raw").distinct()
    named = dimension.override_names(
        places, seeds.geo_override(spark), "geo_code", "geo_name_raw", "geo_name_clean", "geo_name"
    )
    return named.select("geo_code", "geo_name")


@query
def level_classes(spark, sf):
    """Pattern classes of document text, to show priority and case-insensitivity on free text."""
    docs = star.read_table(spark, sf, "documents")
    patterns = [("the", "en"), ("der", "de"), ("les", "fr")]
    return dimension.classify(docs, "text", patterns, "unknown", "level").select("doc_id", "level")


@query
def dim_geo(spark, sf):
    return _geo(spark, sf)


@query
def maintained_dim_geo(spark, sf):
    """The dimension from merged name counts: one dataset came with names of its own, one with the smallest names left."""
    own = F.when(F.col("dataset_id") == 227, F.lit("#")).when(F.col("dataset_id") == 228, F.lit("!")).otherwise(F.lit(""))
    rows = star.atomic(spark, sf).withColumn("geo_name_raw", F.concat(own, "geo_name_raw"))

    def counts(where: str) -> DataFrame:
        return dimension.name_counts(rows.where(where), "geo_code", "geo_name_raw")

    names = dimension.merged_names([counts("dataset_id <> 227"), counts("dataset_id = 227")], [counts("dataset_id = 228")], "geo_code", "geo_name_raw")
    return wh.dim_geo_of(dimension.representatives(names, "geo_code", "geo_name_raw"), seeds.geo_override(spark))


@query
def dim_geo_region_code(spark, sf):
    return scope.with_region_code(_geo(spark, sf))


# --- facts and marts ---------------------------------------------------------


@query
def fact_population_yearly(spark, sf):
    return wh.fact_population_yearly(star.atomic(spark, sf, fv.POPULATION_MEASURES))


@query
def fact_demography_flows_yearly(spark, sf):
    return wh.fact_demography_flows_yearly(star.atomic(spark, sf))


@query
def fact_flows_published_groups(spark, sf):
    return wh.fact_demography_flows_yearly(star.atomic(spark, sf), fv.PUBLISHED_FLOW_GROUPS)


@query
def mart_region_overview_yearly(spark, sf):
    return _overview(spark, sf)


@query
def mart_region_overview_true_rates(spark, sf):
    return _overview(spark, sf, None, population_unit=1000)


@query
def mart_scoped_overview_yearly(spark, sf):
    return _overview(spark, sf, "1716")


@query
def mart_population_split_yearly(spark, sf):
    return _split(spark, sf)


@query
def mart_births_by_sex_yearly(spark, sf):
    return _births(spark, sf)


@query
def mart_metric_coverage(spark, sf):
    return wh.mart_metric_coverage(star.atomic(spark, sf))


@query
def coverage_gaps(spark, sf):
    """Coverage over every catalogued metric and every year found, absent ones as 0."""
    rows = star.atomic(spark, sf)
    catalogued = [r["metric_key"] for r in fv.rows(fv.METRIC_DICTIONARY_CSV)]
    expected = rows.select("year").distinct().select("year", F.explode(F.lit(catalogued)).alias("metric_key"))
    return summarise.coverage_gaps(rows, ["metric_key", "year"], expected)


@query
def rolling_average_births(spark, sf):
    births = scope.slice_on(star.atomic(spark, sf, ["birth_total"]), metric_key="birth_total")
    return summarise.rolling_average(births, ["geo_code", "metric_key"], "year", "value", 3, "avg_3y")


# --- reconciliation ----------------------------------------------------------


def _check(name: str, published: bool = False) -> Query:
    using = checks.PUBLISHED_CHECKS if published else checks.CHECKS
    wanted = checks.CHECKS[name].metrics

    def run(spark: SparkSession, sf: str) -> DataFrame:
        report = checks.reconciliation_check(star.atomic(spark, sf, wanted), name, checks=using)
        return report.orderBy(*checks.KEYS)

    return run


for _name in checks.CHECKS:
    QUERIES[f"check_{_name}"] = _check(_name)
for _name in ["births_total_vs_girls_boys", "deaths_total_vs_women_men", "divorces_total_vs_urban_rural"]:
    QUERIES[f"published_check_{_name}"] = _check(_name, published=True)


@query
def reconciliation_report(spark, sf):
    return checks.reconciliation_report(star.atomic(spark, sf))


@query
def duplicate_grain(spark, sf):
    """Grain duplicates after two orders of one customer and year meet in the same cell."""
    orders = _orders(spark, sf).select(
        F.col("o_custkey").alias("geo_code"), F.year("o_orderdate").alias("year"),
        F.col("o_orderstatus").alias("metric_key"), F.lit("total").alias("sex"),
        F.lit("total").alias("settlement_type"),
    )
    return checks.duplicate_grain(orders)


# --- data tests --------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    halves = _rates(spark, sf)
    rules = [Rule("lineitem", c, "not_null") for c in ["l_orderkey", "discount", "tax"]]
    return quality.run_rules({"lineitem": halves}, rules)


@query
def dq_unique(spark, sf):
    tables = {"orders": _orders(spark, sf)}
    return quality.run_rules(tables, [Rule("orders", c, "unique") for c in ["o_orderkey", "o_custkey"]])


@query
def dq_accepted_values(spark, sf):
    tables = {"orders": _orders(spark, sf), "customer": _customer(spark, sf)}
    rules = [
        Rule("orders", "o_orderstatus", "accepted_values", ("F", "O")),
        Rule("orders", "o_orderpriority", "accepted_values",
             ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")),
        Rule("customer", "c_mktsegment", "accepted_values", ("BUILDING",)),
    ]
    return quality.run_rules(tables, rules)


@query
def dq_relationships(spark, sf):
    customer = _customer(spark, sf)
    tables = {
        "orders": _orders(spark, sf),
        "customer": customer,
        "builders": customer.where(F.col("c_mktsegment") == "BUILDING"),
    }
    rules = [
        Rule("orders", "o_custkey", "relationships", parent="builders", parent_column="c_custkey"),
        Rule("customer", "c_custkey", "relationships", parent="orders", parent_column="o_custkey"),
    ]
    return quality.run_rules(tables, rules)


@query
def dq_failing_values(spark, sf):
    return quality.failing_values(_orders(spark, sf), "o_orderpriority", ["1-URGENT", "5-LOW"])


@query
def dq_orphan_keys(spark, sf):
    builders = _customer(spark, sf).where(F.col("c_mktsegment") == "BUILDING")
    return quality.orphan_keys(_orders(spark, sf), builders, "o_custkey", "c_custkey")


def _suite(spark: SparkSession, sf: str, prefix: str | None) -> DataFrame:
    """All declared tests of the warehouse: row tests while the tables are written, the others over the stored tables."""
    root = new_shared_path(spark, "models")
    tests = {row[:3]: row for row in ingest.store_atomic(spark, star.staged_long(spark, sf), seeds.dim_metric(spark), f"{root}/atomic")}
    atomic = wh.read_atomic(spark, f"{root}/atomic")
    tests |= refresh.write_models(spark, root, refresh.EDGES, atomic, prefix, seeds.geo_override(spark))
    models = wh.build_models(spark, atomic, prefix, spark.read.parquet(f"{root}/dim_geo"))
    return checks.finished_report(spark, models, list(tests.values()))


@query
def dq_suite(spark, sf):
    return _suite(spark, sf, fv.DEFAULT_GEO_PREFIX)


@query
def dq_suite_all(spark, sf):
    """The same with the marts of every geography."""
    return _suite(spark, sf, None)


# --- summaries ---------------------------------------------------------------


@query
def year_bounds(spark, sf):
    return summarise.bounds(_orders(spark, sf).select(F.year("o_orderdate").alias("year")), "year")


@query
def latest_per_customer(spark, sf):
    orders = _orders(spark, sf).select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    return summarise.latest_per_key(orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query
def latest_day_orders(spark, sf):
    return summarise.latest_rows(_orders(spark, sf), "o_orderdate")


@query
def any_flag_by_part(spark, sf):
    lines = _lineitem(spark, sf).select("l_partkey", (F.col("l_discount") == 0).cast("int").alias("undiscounted"))
    return summarise.any_flag(lines, ["l_partkey"], "undiscounted", "has_undiscounted")


@query
def distinct_options(spark, sf):
    return summarise.options(_lineitem(spark, sf), ["l_suppkey", "l_returnflag"])


@query
def duplicate_keys(spark, sf):
    return summarise.duplicate_keys(_lineitem(spark, sf), ["l_orderkey", "l_linenumber"])


# --- scalar functions --------------------------------------------------------


@query
def zero_safe_ratio(spark, sf):
    return _lineitem(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        ms.ratio("l_tax", "l_discount", 1000).alias("tax_per_1000"),
        ms.share("l_tax", "l_discount").alias("tax_share"),
    )


@query
def content_fingerprint(spark, sf):
    docs = star.read_table(spark, sf, "documents")
    return docs.select(
        "doc_id", tx.sha256_hex("text").alias("digest"), F.octet_length("text").cast("bigint").alias("bytes")
    )


@query
def clean_cells(spark, sf):
    docs = star.read_table(spark, sf, "documents")
    return docs.select("doc_id", tx.strip_quotes(F.concat(F.lit(' "'), F.col("text"), F.lit('"\t'))).alias("cell"))


@query
def code_labels(spark, sf):
    return _customer(spark, sf).select("c_custkey", tx.code_label("c_name", "c_custkey").alias("label"))


@query
def display_numbers(spark, sf):
    return _customer(spark, sf).select(
        "c_custkey", tx.whole_number("c_acctbal").alias("whole"), tx.two_decimals("c_acctbal").alias("decimals")
    )


# --- reports -----------------------------------------------------------------


@query
def overview_slice(spark, sf):
    return reports.scoped(_overview(spark, sf, None), " 1714 ", 2011, 2014).orderBy("year", "geo_code")


@query
def overview_of_geo(spark, sf):
    return reports.scoped(_overview(spark, sf, None), None, geo=1714207)


@query
def geo_options(spark, sf):
    return reports.geo_options(_overview(spark, sf, None)).orderBy("geo_name", "geo_code")


@query
def latest_cards(spark, sf):
    return reports.latest_cards(_overview(spark, sf, None))


@query
def trend_series(spark, sf):
    return reports.trend_series(_overview(spark, sf, None))


@query
def district_ranking(spark, sf):
    return reports.district_ranking(_overview(spark, sf, None))


@query
def urban_rural_series(spark, sf):
    return reports.segment_series(_split(spark, sf, None), ["population_urban", "population_rural"])


@query
def men_women_series(spark, sf):
    return reports.segment_series(_split(spark, sf, None), ["population_men", "population_women"])


@query
def gap_warnings(spark, sf):
    return reports.gap_warnings(_split(spark, sf, None))


@query
def coverage_listing(spark, sf):
    return reports.coverage_listing(wh.mart_metric_coverage(star.atomic(spark, sf), None))


@query
def births_check(spark, sf):
    return reports.births_check(_births(spark, sf, None), 2011, 2015)


@query
def urban_rural_series_scoped(spark, sf):
    """The same within a prefix, a range of years and one geography."""
    return reports.segment_series(_split(spark, sf, None), ["population_urban", "population_rural"], "1714", 2011, 2014, 1714207)


@query
def births_check_scoped(spark, sf):
    return reports.births_check(_births(spark, sf, None), 2011, 2013, "1714", 1714207)


# --- change and freshness ----------------------------------------------------


@query
def snapshot_changes(spark, sf):
    """Users' event counts of two half months, compared as two audits are."""
    events = star.read_table(spark, sf, "events")
    cut = F.to_timestamp_ntz(F.lit("2024-01-16 00:00:00"))

    def snapshot(rows: DataFrame) -> DataFrame:
        counted = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        return counted.select("user_id", tx.sha256_hex(F.col("n").cast("string")).alias("digest"))

    before, after = snapshot(events.where(F.col("ts") < cut)), snapshot(events.where(F.col("ts") >= cut))
    return fa.compare_snapshots(before, after, "user_id")


@query
def source_freshness(spark, sf):
    events = star.read_table(spark, sf, "events")
    last = events.groupBy("user_id").agg(F.max("ts").alias("last_seen"))
    return fa.freshness(last, "last_seen", F.to_date(F.lit("2024-01-31")), 2).select("user_id", "age_days", "fresh")


@query
def incremental_rebuild(spark, sf):
    """The atomic table after a refresh: one dataset's files have other values, one dataset is gone, the others stay as they were."""
    root, sources = new_shared_path(spark, "refreshed"), _written_extracts(spark, sf)
    refresh.refresh(spark, sources, root, None)
    later = new_shared_path(spark, "extracts")
    wide_csv.write_wide(star.wide_extracts(spark, sf, [224]).withColumns({y: F.col(f"`{y}`") + 1 for y in wh.YEARS}), later)
    sources |= wide_csv.registry(later, [224], wide_csv.WRITTEN_NAMING)
    del sources[227]
    refresh.refresh(spark, sources, root, None)
    return wh.read_atomic(spark, f"{root}/{refresh.ATOMIC}").drop("region_code")


@query
def refreshed_coverage(spark, sf):
    """The coverage mart after a refresh in which one dataset came late."""
    root, sources = new_shared_path(spark, "refreshed"), _written_extracts(spark, sf)
    refresh.refresh(spark, {i: path for i, path in sources.items() if i != 227}, root, None)
    refresh.refresh(spark, sources, root, None)
    return spark.read.parquet(f"{root}/mart_metric_coverage")


@query
def landed_source_changes(spark, sf):
    """Sources between two written audits: one came, one went, one got another file."""
    sources = _written_extracts(spark, sf)

    def audited(gone: int) -> DataFrame:
        path = new_shared_path(spark, "audit")
        fa.write_audit(fa.profile_files(spark, [p for i, p in sources.items() if i != gone]), path)
        return fa.source_digests(spark.read.schema("path string, digest string, profile_error string").json(path))

    before = audited(228)
    star.wide_extracts(spark, sf, [224]).drop("dataset_id").limit(1).write.mode("append").csv(sources[224], header=True)
    return fa.compare_snapshots(before, audited(227), "source").withColumnRenamed("source", "dataset_id")


@query
def landed_source_age(spark, sf):
    """Age of the landed sources 40 days from now, against a limit of 30."""
    path = new_shared_path(spark, "audit")
    fa.write_audit(fa.profile_files(spark, list(_written_extracts(spark, sf).values())), path)
    records = spark.read.schema("path string, modified_at timestamp").json(path)
    source = F.regexp_extract("path", fv.RAW_FILE_ID_PATTERN, 1).cast("int")
    landed = records.groupBy(source.alias("dataset_id")).agg(F.max("modified_at").alias("modified_at"))
    return fa.freshness(landed, "modified_at", F.date_add(F.current_date(), 40), 30).drop("modified_at")


# --- marts and report over every geography ---------------------------------------


@query
def mart_region_overview_yearly_all(spark, sf):
    return _overview(spark, sf, None)


@query
def mart_population_split_yearly_all(spark, sf):
    return _split(spark, sf, None)


@query
def mart_births_by_sex_yearly_all(spark, sf):
    return _births(spark, sf, None)


@query
def mart_metric_coverage_all(spark, sf):
    return wh.mart_metric_coverage(star.atomic(spark, sf), None)


@query
def reconciliation_report_all(spark, sf):
    return checks.reconciliation_report(star.atomic(spark, sf), None)
