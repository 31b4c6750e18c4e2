"""Audit of landed files: digest, size, shape, freshness, change."""

from __future__ import annotations

import csv
import fnmatch
import hashlib
import io
from collections.abc import Iterator
from datetime import datetime
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan import fixed_values as fv
from tallyspan.operators.summarise import status_counts
from tallyspan.session import new_shared_path
from tallyspan.sources.wide_csv import LINES, RECORDS, WHOLE

CHUNK = 1 << 20
#: Names that a listing task holds at once.
NAMES = 1000
_PROFILE = "path string, bytes bigint, modified_at timestamp, digest string, rows bigint, cols int, columns array<string>, kind string, profile_error string"


class _Digested(io.RawIOBase):
    """A stream that hashes what is read from it."""

    def __init__(self, source: pa.NativeFile):
        self.source, self.sha, self.size = source, hashlib.sha256(), 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer: memoryview) -> int:
        part = self.source.read(min(len(buffer), CHUNK))
        buffer[: len(part)] = part
        self.sha.update(part)
        self.size += len(part)
        return len(part)


class _Lines:
    """Lines of a stream; remembers whether one ended with a bare carriage return."""

    def __init__(self, stream: io.TextIOBase):
        self.stream, self.bare = stream, False

    def __iter__(self) -> Iterator[str]:
        for line in self.stream:
            self.bare = self.bare or line.endswith("\r")
            yield line


def _shape(stream: io.TextIOBase) -> tuple[int | None, int | None, list[str] | None, str | None, str | None]:
    """Records, columns, their names, the way to read them and, where it is no table, why. A quoted line break is part of its record."""
    lines, header, n, widest, seen = _Lines(stream), None, 0, 0, 0
    reader = csv.reader(lines, strict=False)
    try:
        for record in reader:
            seen += 1
            if len(record) < 2 and not "".join(record).strip():
                continue
            if header is None:
                header = [name.strip() for name in record]
                continue
            n += 1
            widest = max(widest, len(record))
    except csv.Error as error:
        return None, None, None, None, str(error)
    if header is None:
        return None, None, None, None, "no columns to parse"
    if widest > len(header):
        return None, None, None, None, f"expected {len(header)} fields, found {widest}"
    return n, len(header), header, WHOLE if lines.bare else RECORDS if reader.line_num > seen else LINES, None


def _profiled(path: str) -> tuple:
    """One file in one pass of constant memory: SHA-256 of its bytes, size and shape."""
    where, name = fs.FileSystem.from_uri(path)
    with where.open_input_stream(name, compression=None) as source:
        raw = _Digested(source)
        buffered = io.BufferedReader(raw, CHUNK)
        lines = io.TextIOWrapper(buffered, "utf-8-sig", errors="replace", newline="")
        found = _shape(lines)
        while buffered.read(CHUNK):  # what a broken table left unread
            pass
        lines.detach()
    return raw.size, raw.sha.hexdigest(), *found


def _plain(path: str) -> str:
    """A path as the file systems take it, from one as scans name it."""
    return path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path


def _listed(root: str) -> Iterator[tuple[str, bool, datetime | None]]:
    """path, whether it is a folder, and time of what lies directly in a folder, or of the file itself; nothing where there is neither.

    A folder that vanished after it was listed is empty.
    """
    where, name = fs.FileSystem.from_uri(_plain(root))
    scheme = root.split("://", 1)[0] + "://" + root.split("://", 1)[1].partition("/")[0] if "://" in root else "file:"
    one = where.get_file_info(name)
    found = [one] if one.is_file else where.get_file_info(fs.FileSelector(name, allow_not_found=True))
    for info in found:
        yield f"{scheme}{info.path}", info.type == fs.FileType.Directory, info.mtime


def list_files(spark: SparkSession, roots: list[str], glob: str = "*", tasks: int = 32) -> DataFrame:
    """path, modified_at of every matching file under the roots.

    Level by level: each round lists the folders of one level in many tasks, in
    batches of at most NAMES names, into a table, until a level has no folders.
    The driver holds the roots, no more.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.bool_(), pa.timestamp("us", "UTC")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "folder", "modified_at"])

        for batch in batches:
            for root in batch.column(0).to_pylist():
                held = []
                for row in _listed(root):
                    held.append(row)
                    if len(held) == NAMES:
                        yield batch_of(held)
                        held = []
                if held:
                    yield batch_of(held)

    schema = "path string, folder boolean, modified_at timestamp"
    folders, levels = spark.createDataFrame([(r,) for r in dict.fromkeys(roots)], "path string"), []
    while True:
        out = new_shared_path(spark, "listing")
        folders.repartition(tasks, "path").mapInArrow(listed, schema).write.parquet(out)
        levels.append(spark.read.schema(schema).parquet(out))
        folders = levels[-1].where("folder").select("path").distinct()
        if not folders.take(1):
            break
    found = reduce(DataFrame.union, levels).where("not folder").select("path", "modified_at")
    pattern = "(?s)^" + fnmatch.translate(glob).removeprefix("(?s:").rpartition(")")[0] + "$"
    name = F.element_at(F.split("path", "/"), -1)
    return found.where(name.rlike(pattern) & ~name.rlike("^[_.]")).groupBy("path").agg(F.max("modified_at").alias("modified_at"))


def profile_files(spark: SparkSession, paths: str | list[str], glob: str = "*", tasks: int | None = None) -> DataFrame:
    """Every file's digest and shape: ``path, bytes, modified_at, digest, rows, cols, columns, kind, profile_error``.

    The digest is the SHA-256 of the bytes for every size. Tasks list the roots
    level by level, other tasks stream one file after the other, ``tasks`` of
    them at once; no list of files passes the driver. ``kind`` is how scans must
    read the file. Any fault is the file's own: a file that vanishes after it
    was listed, cannot be read or cannot be a table gets an error text, and the
    others go on. Paths are plain, not percent-encoded.
    """

    def profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(1 << 30)
        for batch in batches:
            for path, modified in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    size, digest, rows, cols, columns, kind, error = _profiled(_plain(path))
                except FileNotFoundError:
                    size, digest, rows, cols, columns, kind, error = *[None] * 6, "vanished"
                except (OSError, pa.ArrowException) as fault:
                    size, digest, rows, cols, columns, kind, error = *[None] * 6, f"not readable: {type(fault).__name__}"
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path]),
                        pa.array([size], pa.int64()),
                        pa.array([modified.as_py()], pa.timestamp("us", "UTC")),
                        pa.array([digest], pa.string()),
                        pa.array([rows], pa.int64()),
                        pa.array([cols], pa.int32()),
                        pa.array([columns], pa.list_(pa.string())),
                        pa.array([kind], pa.string()),
                        pa.array([error], pa.string()),
                    ],
                    ["path", "bytes", "modified_at", "digest", "rows", "cols", "columns", "kind", "profile_error"],
                )

    width = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = list_files(spark, [paths] if isinstance(paths, str) else paths, glob)
    # in turn, not by path: the listing is grouped by path already, so that an exchange by it is left out, and its own few bytes become one task
    return files.repartition(width).mapInArrow(profiled, _PROFILE)


def audit(
    spark: SparkSession,
    manifest: DataFrame,
    paths: str | list[str],
    glob: str = "*",
    filename: Column | None = None,
) -> DataFrame:
    """Manifest items with the state of their file, stamped with the time of the audit.

    ``filename`` derives the manifest's file name from ``path``; by default it
    is the last path segment. ``status`` is ``ok``, ``unreadable`` (landed, but
    no table), ``missing`` or ``vanished`` (listed, but gone when it was read).
    """
    named = F.element_at(F.split("path", "/"), -1) if filename is None else filename
    found = profile_files(spark, paths, glob).withColumn("filename", named)
    status = (
        F.when(F.col("path").isNull(), F.lit("missing"))
        .when(F.col("profile_error") == "vanished", F.lit("vanished"))
        .when(F.col("profile_error").isNotNull(), F.lit("unreadable"))
        .otherwise(F.lit("ok"))
    )
    return manifest.join(found, "filename", "left").withColumns(
        {"status": status, "audited_at": F.current_timestamp()}
    )


def write_audit(records: DataFrame, path: str) -> None:
    """Audit records as one JSON dataset; text is kept as it is."""
    records.write.mode("overwrite").json(path)


def audit_tally(records: DataFrame) -> DataFrame:
    """Items per status."""
    return status_counts(records, "status")


def compare_snapshots(before: DataFrame, after: DataFrame, key: str = "path", digest: str = "digest") -> DataFrame:
    """Each item of two snapshots as ``new``, ``missing``, ``changed`` or ``unchanged``."""
    old = before.select(key, F.col(digest).alias("_old"), F.lit(True).alias("_was"))
    new = after.select(key, F.col(digest).alias("_new"), F.lit(True).alias("_is"))
    status = (
        F.when(F.col("_was").isNull(), F.lit("new"))
        .when(F.col("_is").isNull(), F.lit("missing"))
        .when(F.col("_old").eqNullSafe(F.col("_new")), F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    return old.join(new, key, "full_outer").select(key, status.alias("status"))


def source_digests(records: DataFrame, id_pattern: str = fv.RAW_FILE_ID_PATTERN) -> DataFrame:
    """source, digest, n_files: one digest for all files of a source; names and bytes count, the order of the files does not."""
    source = F.regexp_extract("path", id_pattern, 1).try_cast("int")
    each = records.where("path is not null").select(source.alias("source"), F.xxhash64("path", "digest", "profile_error").alias("h"))
    summed = each.groupBy("source").agg(F.count(F.lit(1)).alias("n_files"), F.sum(F.col("h").cast("decimal(38,0)")).alias("h"))
    return summed.select("source", F.concat_ws("-", "n_files", "h").alias("digest"), "n_files")


def freshness(df: DataFrame, stamp: str, as_of: Column, max_age_days: int) -> DataFrame:
    """Rows with their age in whole days and whether they are within the limit."""
    age = F.datediff(as_of, F.col(stamp))
    return df.withColumn("age_days", age).withColumn("fresh", age <= max_age_days)
