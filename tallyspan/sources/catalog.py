"""Names for sources and models in the session catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyspan import fixed_values as fv
from tallyspan.functions.text import is_bad_code
from tallyspan.operators.enrich import union_sources
from tallyspan.sources import wide_csv


def register_sources(
    spark: SparkSession, sources: Mapping[int, str], schema: str = "raw", location: str | None = None
) -> list[str]:
    """Views ``<schema>.sdmx_data_<id>`` that hold what the raw files hold, replacing older ones.

    Each is a view over an external table of text cells, ``<view>_text``, so it
    follows its files, and dropping or replacing a name never touches them.
    Quoted line breaks stay within their cell. ``Code`` is a number where all of
    a source's filled codes are whole numbers, else text as found. A row with
    another number of fields than the header is no row of the view. One job
    finds all headers, one more the codes. ``location`` places the schema's own
    folder, which stays empty. ValueError where one source's files differ in
    their header.
    """
    placed = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{placed}")
    groups = wide_csv.header_groups(spark, sources)
    coded = [wide_csv.scan(spark, g).where(wide_csv.BROKEN + " is null").select("dataset_id", is_bad_code("Code").alias("bad")) for g in groups if "Code" in g.header]
    as_text = {r.dataset_id for r in union_sources(coded).where("bad").select("dataset_id").distinct().collect()} if coded else set()
    names = []
    for dataset_id, path in sources.items():
        mine = [g for g in groups if path in g.roots]
        if not mine:
            continue  # no file with a header
        if len({g.header for g in mine}) > 1:
            raise ValueError(f"the files of source {dataset_id} differ in their header")
        name, columns = f"{schema}.sdmx_data_{dataset_id}", wide_csv.cell_names(mine[0].header)
        _drop(spark, name)
        _drop(spark, f"{name}_text")
        spark.catalog.createTable(
            f"{name}_text",
            path=path,
            source="csv",
            schema=T.StructType([T.StructField(c, T.StringType()) for c in columns]),
            header="true",
            escape='"',
            columnNameOfCorruptRecord=wide_csv.BROKEN,
            columnPruning="false",
            recursiveFileLookup="true",
            multiLine=str(any(g.kind != wide_csv.LINES for g in mine)).lower(),
        )
        cells = [_quoted(c) for c in columns[:-1]]
        cells = [f"try_cast(btrim({c}) AS BIGINT) AS {c}" if c == "`Code`" and dataset_id not in as_text else c for c in cells]
        # a reader of text files must be asked for a cell besides the broken row, even where a query only counts
        whole = f"{wide_csv.BROKEN} IS NULL AND length(coalesce({_quoted(columns[0])}, '')) >= 0"
        spark.sql(f"CREATE VIEW {name} AS SELECT {', '.join(cells)} FROM {name}_text WHERE {whole}")
        names.append(name)
    return names


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _drop(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP {'VIEW' if spark.catalog.getTable(name).tableType == 'VIEW' else 'TABLE'} {name}")


def register_views(models: Mapping[str, DataFrame]) -> list[str]:
    """Models as replaceable session views."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    return list(models)


def register_staging_views(long: DataFrame) -> list[str]:
    """``stg_sdmx_<id>_long`` for every staged dataset, as slices of the long table."""
    return register_views({f"stg_sdmx_{i}_long": long.where(long["dataset_id"] == i) for i in fv.STAGED_DATASETS})


def optional_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The named table, or None when the catalog does not have it."""
    return spark.table(name) if spark.catalog.tableExists(name) else None
