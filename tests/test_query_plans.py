"""Physical plans: what is read, moved and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from tallyspan.operators import dimension, quality, reshape, scope, summarise
from tallyspan.plans import star
from tallyspan.plans import warehouse as wh
from tallyspan.plans.star_queries import QUERIES
from tallyspan.sources import seeds

SF = "/root/testdata/sf0.001"
NOT_WRITING = [n for n in QUERIES if n not in {"export_status"}]


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_dictionary_is_broadcast_by_its_size(spark, plan):
    text = plan(star.atomic(spark, SF))
    assert "BroadcastHashJoin [dataset_id" in text and "LocalTableScan [dataset_id" in text


def test_result_does_not_depend_on_broadcast(spark, plan):
    query = QUERIES["mart_region_overview_yearly"]
    want = sorted(map(tuple, query(spark, SF).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = query(spark, SF)
        assert "BroadcastHashJoin" not in plan(df)
        assert sorted(map(tuple, df.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_pivot_is_one_exchange_with_partial_aggregation(spark, plan):
    lines = star.read_table(spark, SF, "lineitem")
    text = plan(reshape.pivot_max(lines, ["l_orderkey"], {"a": "A", "r": "R"}, "l_returnflag", "l_quantity"))
    assert exchanges(text) == 1 and "partial_max" in text
    assert "SortAggregate" not in text


def test_unpivot_reads_only_its_columns_and_does_not_shuffle(spark, plan):
    text = plan(QUERIES["unpivot_drop_nulls"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_discount:double,l_tax:double>" in text
    assert "Exchange" not in text


def test_dimension_hashes_the_facts(spark, plan):
    facts = star.read_table(spark, SF, "lineitem").select("l_suppkey", "l_returnflag")
    text = plan(dimension.discover_dimension(facts, "l_suppkey", "l_returnflag"))
    assert "HashAggregate(keys=[l_suppkey" in text and "partial_count" in text


def test_row_tests_share_one_scan(spark, plan):
    tables = {"orders": star.read_table(spark, SF, "orders")}
    rules = [quality.Rule("orders", c, "not_null") for c in ["o_orderkey", "o_custkey", "o_orderstatus"]]
    assert plan(quality.run_rules(tables, rules)).count("FileScan") == 1


def test_latest_rows_push_the_maximum_into_the_scan(spark, plan):
    text = plan(summarise.latest_rows(star.read_table(spark, SF, "orders"), "o_orderdate"))
    assert "EqualTo(o_orderdate,ScalarSubquery" in text


def test_stored_table_is_pruned_by_metric_and_region(spark, plan, tmp_path):
    path = str(tmp_path / "atomic")
    wh.write_atomic(star.atomic(spark, SF), path)
    stored = wh.read_atomic(spark, path)
    text = plan(wh.mart_population_split_yearly(stored))
    assert "PartitionFilters: [metric_key" in text and "StringStartsWith(region_code,1714)" in text
    assert "geo_name_raw" not in text
    assert exchanges(text) == 1
    assert stored.drop("region_code").count() == star.atomic(spark, SF).count()


def test_year_filter_reaches_the_scan(spark, plan, tmp_path):
    path = str(tmp_path / "atomic")
    wh.write_atomic(star.atomic(spark, SF), path)
    assert "GreaterThanOrEqual(year,2012)" in plan(scope.year_range(wh.read_atomic(spark, path), 2012, 2013))


@pytest.mark.parametrize("name", ["mart_region_overview_yearly", "dq_suite", "reconciliation_report"])
def test_plans_stay_in_the_jvm(spark, plan, name):
    text = plan(QUERIES[name](spark, SF))
    for slow in ["Python", "ArrowEval", "CartesianProduct", "NestedLoop"]:
        assert slow not in text


def test_stateless_operators_accept_streams(spark, tmp_path):
    schema = "dataset_id int, Code long, Klassifikator string, `2010` string, `2011` string"
    source = tmp_path / "in"
    spark.createDataFrame([(223, 1714, "a", "1", None), (999, 1714, "a", "1", "2")], schema).write.parquet(str(source))
    stream = spark.readStream.schema(schema).parquet(str(source))
    atomic = wh.demography_atomic(wh.staging_long(stream, wh.YEARS), seeds.dim_metric(spark))
    assert atomic.isStreaming
    query = (
        atomic.writeStream.format("memory").queryName("streamed_atomic")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    assert spark.table("streamed_atomic").select("metric_key", F.col("value")).collect() == [("birth_total", 1.0)]
