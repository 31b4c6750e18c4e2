"""The warehouse's inputs derived from an order star schema.

Regions, nations and customers become three levels of geography; order counts
and values per calendar year become the published datasets. The models then run
on these rows exactly as on the statistical extracts.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan import fixed_values as fv
from tallyspan.operators import reshape
from tallyspan.plans.warehouse import STAGING_COLUMNS, YEARS, datasets_of, demography_atomic
from tallyspan.sources import seeds

YEAR_SHIFT = 15
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}

SEGMENT_SUFFIX = {"BUILDING": " shahri", "HOUSEHOLD": " Tumani", "FURNITURE": " VILOYATI",
                  "MACHINERY": " respublikasi"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A star-schema table; its declared schema spares the reader a footer job."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


# Dataset id to the orders it counts.
COUNT_RULES = {
    223: "true",
    224: "status = 'F'",
    225: "status in ('O', 'P')",
    226: "rank in ('1', '2', '3')",
    227: "rank = '1'",
    228: "rank = '2'",
    230: "status = 'P'",
    232: "status = 'P' and rank in ('1', '2')",
    233: "status = 'P' and rank in ('3', '4', '5')",
    235: "status = 'O' and rank in ('1', '2')",
    242: "status = 'O' and rank in ('3', '4', '5')",
    243: "status = 'O'",
    268: "rank = '4'",
    269: "rank = '5'",
}

# Dataset id to the orders whose value it sums; no such order means no value.
VALUE_RULES = {
    244: f"status = 'O' and year >= {fv.DATASET_FIRST_YEAR[244]}",
    245: "status in ('F', 'P')",
    246: "true",
    247: "rank in ('1', '2')",
    248: "rank in ('3', '4', '5')",
}

DATASETS = sorted([*COUNT_RULES, *VALUE_RULES])


def measures_by_geo(spark: SparkSession, sf_dir: str, ids: Collection[int] = DATASETS) -> DataFrame:
    """One row per geography and year, one column per dataset asked for.

    Orders are combined per customer and year before they meet the customer
    table, so a customer with a third of all orders is a handful of rows there.
    Values are summed as whole cents and are therefore exact.
    """
    orders = read_table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as c_custkey",
        f"year(o_orderdate) + {YEAR_SHIFT} as year",
        "o_orderstatus as status",
        "substring(o_orderpriority, 1, 1) as rank",
        "cast(round(o_totalprice * 100) as bigint) as cents",
    )
    counts = [F.expr(f"count_if({rule}) as `{i}`") for i, rule in COUNT_RULES.items() if i in ids]
    cents = [F.expr(f"sum(if({rule}, cents, null)) as `{i}`") for i, rule in VALUE_RULES.items() if i in ids]
    per_customer = orders.groupBy("c_custkey", "year").agg(*counts, *cents)
    customer = read_table(spark, sf_dir, "customer").drop("c_acctbal")
    placed = per_customer.join(customer, "c_custkey").join(places(spark, sf_dir), "c_nationkey")
    columns = [f"`{i}`" for i in sorted(ids)]
    cases = " ".join(f"when '{segment}' then '{text}'" for segment, text in SEGMENT_SUFFIX.items())
    # A customer's rows are final; only nations and regions are summed again.
    own = placed.selectExpr(
        "nation.geo_code * 1000000000 + c_custkey as geo_code",
        f"concat(c_name, case c_mktsegment {cases} else '' end) as geo_name_raw",
        "year",
        *columns,
    )
    above = (
        placed.selectExpr("inline(array(nation, region))", "year", *columns)
        .groupBy("geo_code", "geo_name_raw", "year")
        .agg(*[F.expr(f"sum({c}) as {c}") for c in columns])
    )
    return own.unionByName(above)


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each nation with the code and name of itself and of its region."""
    nation, region = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "n_nationkey as c_nationkey",
        """named_struct('geo_code', cast(1710 + 2 * n_regionkey as bigint),
            'geo_name_raw', concat(r_name, ' viloyati')) as region""",
        """named_struct('geo_code', (1710 + 2 * cast(n_regionkey as bigint)) * 1000 + 200 + n_nationkey,
            'geo_name_raw', concat(n_name, ' tumani')) as nation""",
    )


def staged_long(spark: SparkSession, sf_dir: str, ids: Collection[int] = DATASETS, together: bool = False) -> DataFrame:
    """The datasets in the staging contract; all rows of a geography in one partition with ``together``."""
    scaled = [f"`{i}` / 100000D as `{i}`" if i in VALUE_RULES else f"`{i}`" for i in sorted(ids)]
    wide = measures_by_geo(spark, sf_dir, ids).selectExpr("geo_code", "geo_name_raw", "year", *scaled)
    if together:
        wide = wide.repartition("geo_code", "geo_name_raw")
    columns = [str(i) for i in sorted(ids)]
    long = reshape.unpivot_long(wide, ["geo_code", "geo_name_raw", "year"], columns, "dataset_id")
    return long.withColumn("dataset_id", F.col("dataset_id").cast("int")).select(*STAGING_COLUMNS)


def atomic(spark: SparkSession, sf_dir: str, keys: Iterable[str] | None = None) -> DataFrame:
    """The conformed table over the derived datasets.

    With ``keys``, only the datasets behind those metrics are derived.
    """
    ids = DATASETS if keys is None else [i for i in datasets_of(keys) if i in DATASETS]
    return demography_atomic(staged_long(spark, sf_dir, ids), seeds.dim_metric(spark))


def wide_extracts(spark: SparkSession, sf_dir: str, ids: Collection[int] = DATASETS) -> DataFrame:
    """The datasets in their published layout: one row per geography, one column per year.

    A geography's years meet while they are one row for all datasets: the tasks
    then pivot them whole, and no year is exchanged as a row of its own.
    """
    wide = reshape.pivot_max(
        staged_long(spark, sf_dir, ids, together=True),
        ["dataset_id", "geo_code", "geo_name_raw"],
        {y: F.col("year") == int(y) for y in YEARS},
    )
    names = ["Klassifikator", "Klassifikator_ru", "Klassifikator_en", "Klassifikator_uzc"]
    return wide.selectExpr(
        "dataset_id", "geo_code as Code", *[f"geo_name_raw as {n}" for n in names], *[f"`{y}`" for y in YEARS]
    )
