"""Static lookup tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyspan import fixed_values as fv

DIM_METRIC = (
    "dataset_id int, metric_group string, metric_key string, metric_name_uz string, "
    "sex string, settlement_type string, measure_unit string, unit_type string"
)
GEO_OVERRIDE = "geo_code bigint, geo_name_clean string"
DIM_SEX = "sex_id string, sex_label_uz string, sort_order int"
DIM_SETTLEMENT = "settlement_type_id string, settlement_label_uz string, sort_order int"

_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}


def packaged(spark: SparkSession, text: str, schema: str) -> DataFrame:
    """A packaged seed as a local relation, whose exact size the planner knows."""
    rows = fv.rows(text)
    columns = {}
    for name, kind in (field.split() for field in schema.split(", ")):
        cast = str if kind == "string" else int
        columns[name] = pa.array([cast(r[name]) if r[name] != "" else None for r in rows], _ARROW[kind])
    return spark.createDataFrame(pa.table(columns))


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A user's own seed file, typed by the declared schema."""
    return spark.read.schema(schema).csv(path, header=True, escape='"', enforceSchema=False)


def dim_metric(spark: SparkSession) -> DataFrame:
    return packaged(spark, fv.METRIC_DICTIONARY_CSV, DIM_METRIC)


def geo_override(spark: SparkSession) -> DataFrame:
    return packaged(spark, fv.GEO_OVERRIDE_CSV, GEO_OVERRIDE)


def dim_sex(spark: SparkSession) -> DataFrame:
    return packaged(spark, fv.SEX_LABELS_CSV, DIM_SEX)


def dim_settlement_type(spark: SparkSession) -> DataFrame:
    return packaged(spark, fv.SETTLEMENT_LABELS_CSV, DIM_SETTLEMENT)
