"""Export of marts to CSV."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyspan.operators.quality import metrics_of
from tallyspan.sources.replace import replaced

EXPORT_STATUS = "table_name string, status string, rows bigint, message string"


def export_tables(spark: SparkSession, names: Iterable[str], out_dir: str) -> DataFrame:
    """Each named table to ``<out_dir>/<name>`` as CSV with a header.

    A table that fails is reported and skipped; an earlier export of it stays as
    it was until a new one is complete. Rows are counted while they are written,
    without a second pass.
    """
    report = []
    for name in names:
        try:
            seen = Observation()
            counted = spark.table(name).observe(seen, F.count(F.lit(1)).alias("rows"))
            replaced(spark, f"{out_dir.rstrip('/')}/{name}", lambda path, df=counted: df.write.csv(path, header=True, escape='"'))
            report.append((name, "ok", metrics_of(seen, spark.table(name))["rows"], None))
        except (PySparkException, Py4JJavaError, OSError) as error:
            reason = error.getCondition() if isinstance(error, PySparkException) else None
            report.append((name, "failed", None, reason or type(error).__name__))
    return spark.createDataFrame(report, EXPORT_STATUS)
