"""What several operators of this subpackage share."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.session import new_shared_path

#: The white space that separates words: blank and the control characters 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: object) -> DataFrame:
    """``mapInArrow`` with batches of about 4 MB, as texts and pages are long; a session's own setting stays."""
    if df.sparkSession.conf.get(BATCH_BYTES, "1") == "1":  # not set
        df.sparkSession.conf.set(BATCH_BYTES, "4m")
    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and any executor can read it again."""
    path = new_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Pieces of at most `rows` rows of the incoming batches."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def not_learned_from(doc_id: str = "doc_id") -> F.Column:
    """Whether a row is held out: crc32 of the id as text leaves no remainder by 5. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def bucket(term: bytes, buckets: int) -> int:
    return zlib.crc32(term) % buckets


def sampled(rows: DataFrame, n: int, *by: str) -> DataFrame:
    """n rows, the first by a hash of `by`; fewer only where `by` repeats heavily.

    A bound on the hash that about 4 n rows pass goes first, so that tasks sort
    and send few rows however many there are.
    """
    share = min(1.0, 4 * n / max(1, rows.count()))
    at = F.xxhash64(*by)
    if share < 1:
        rows = rows.where(at < F.lit(int(share * (1 << 64)) - (1 << 63)))
    return rows.orderBy(at, *by).limit(n)
