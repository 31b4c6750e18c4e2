"""The manifest of datasets to expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.text import WHITESPACE, strip_quotes

REQUIRED = ["dataset_id", "url", "filename"]
OPTIONAL = ["title_uz", "metric_key", "periodicity", "notes"]


def sniff_delimiter(first_line: str) -> str:
    """Tab if there is one; semicolon if there is no comma; else comma."""
    if "\t" in first_line:
        return "\t"
    return ";" if ";" in first_line and "," not in first_line else ","


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows as text, cleaned; absent optional columns are empty text.

    A quoted cell may hold line breaks: rows are records, not lines.
    Raises ValueError without a header row and KeyError without a required
    column.
    """
    first = spark.read.text(path).first()
    if first is None or not first[0].strip():
        raise ValueError(f"manifest {path} has no header row")
    raw = spark.read.csv(path, header=True, sep=sniff_delimiter(first[0]), escape='"', multiLine=True)
    names = [c.lstrip("\ufeff").strip(WHITESPACE).strip('"') for c in raw.columns]
    missing = sorted(set(REQUIRED) - set(names))
    if missing:
        raise KeyError(f"manifest {path} lacks columns {missing}; found {names}")
    rows = raw.toDF(*names)
    return rows.select(
        *[F.coalesce(strip_quotes(c), F.lit("")).alias(c) for c in REQUIRED],
        *[(F.coalesce(strip_quotes(c), F.lit("")) if c in names else F.lit("")).alias(c) for c in OPTIONAL],
    )
