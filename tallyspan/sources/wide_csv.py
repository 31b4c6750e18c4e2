"""Wide CSV extracts, one per dataset, read by header group.

Files are grouped by their header and by how they must be read. ``lines``: every
line is a record, so any CSV scan may split the file. ``records``: quoted cells
hold line breaks; the file is still split, and :func:`records` puts lines that
belong together into one record. ``whole``: a carriage return stands inside a
line, so that only a reader of the whole file can tell where lines end.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan import fixed_values as fv
from tallyspan.session import new_shared_path

#: Raw text of a row whose number of fields is not the header's.
BROKEN = "_broken_row"
LINES, RECORDS, WHOLE = "lines", "records", "whole"


@dataclass(frozen=True)
class Group:
    """Files with one header and one way of reading.

    roots: the sources to scan. files: a table of the paths that belong to the
    group, or None where all files under the roots do.
    """

    header: tuple[str, ...]
    kind: str
    roots: tuple[str, ...]
    files: DataFrame | None = None


def registry(
    root: str, ids: Sequence[int] = fv.CATALOGUED_DATASETS, naming: str = fv.RAW_FILE_NAMING
) -> dict[int, str]:
    """Dataset id to path, by the published file naming."""
    return {i: f"{root.rstrip('/')}/{naming.format(id=i)}" for i in ids}


def source_id(id_pattern: str = fv.RAW_FILE_ID_PATTERN) -> Column:
    """The dataset id in a file's path."""
    return F.regexp_extract(F.col("_metadata.file_path"), id_pattern, 1).try_cast("int")


def header_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one source; a small job that reads its first line."""
    return tuple(c.lstrip("\ufeff").strip() for c in spark.read.csv(path, header=True, escape='"').columns)


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, source, start (of the split), id (ascending within it) and text of every line; a line ends with a line feed, with or without a carriage return."""
    text = spark.read.text(list(paths), recursiveFileLookup=True, lineSep="\n")
    return text.select(
        F.col("_metadata.file_path").alias("path"),
        source_id().alias("source"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
        F.rtrim(F.regexp_replace("value", "^\ufeff", ""), F.lit("\r")).alias("text"),
    )


def _quotes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _ends_inside(text: Column, inside: bool) -> Column:
    """Whether a line ends inside a quoted cell, given whether it begins inside one.

    Goes from comma to comma: outside, a cell that begins with a quote and holds
    an odd number of them opens; inside, an odd number closes. Quotes within an
    unquoted cell are ordinary characters.
    """

    def after(state: Column, piece: Column) -> Column:
        odd = _quotes(piece) % 2 == 1
        return F.when(state, ~odd).otherwise(odd & piece.startswith('"'))

    found = F.aggregate(F.split(text, ","), F.lit(inside), after)
    return F.when(text.contains('"'), found).otherwise(F.lit(inside))


def file_heads(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, source, head (first line that is not blank), kind of every file that is not empty; one job over all files."""
    lines = _lines(spark, paths).where(F.btrim("text", F.lit(" \t")) != "")
    seen = lines.select(
        "path",
        "source",
        F.struct("start", "id").alias("at"),
        F.when(F.col("start") == 0, F.col("text")).alias("text"),
        _ends_inside(F.col("text"), False).alias("opens"),
        F.col("text").contains("\r").alias("bare"),
    )
    found = seen.groupBy("path", "source").agg(F.min_by("text", "at").alias("head"), F.max("opens").alias("opens"), F.max("bare").alias("bare"))
    kind = F.when(F.col("bare"), F.lit(WHOLE)).when(F.col("opens"), F.lit(RECORDS)).otherwise(F.lit(LINES))
    return found.where("head is not null").select("path", "source", "head", kind.alias("kind"))


def records(spark: SparkSession, paths: Sequence[str], files: DataFrame | None = None) -> DataFrame:
    """path, source, record, is_head: the records of files whose quoted cells hold line breaks.

    Files are split like any text. What a split does to the state "inside a
    quoted cell" is an aggregate of its lines with quotes; these aggregates, one
    row per split, give the state at each split's start. Lines then become
    records within their split, in one shuffle by split, and only the pieces at
    the ends of splits are put together across them. A quote that never closes
    makes the rest of its file one record, as for any CSV reader.
    """
    lines = _lines(spark, paths)
    if files is not None:
        lines = lines.join(files.select("path"), "path", "left_semi")
    from_out, from_in = _ends_inside(F.col("text"), False), _ends_inside(F.col("text"), True)
    lines = lines.withColumns({"fixed": F.when(from_out == from_in, from_out), "turns": (from_out & ~from_in).cast("int")})
    split = Window.partitionBy("path", "start").orderBy("id")

    def odd(x: Column) -> Column:
        return x % 2 == 1

    def flipped(state: Column, by: Column) -> Column:
        return state != by

    # a line keeps the state, turns it round, or fixes it: only lines of the last two kinds go into the aggregate of a split
    special = lines.where("fixed is not null or turns = 1").withColumn("upto", F.sum("turns").over(split))
    last = special.withColumn("set_to", F.last(flipped(F.col("fixed"), odd(F.col("upto"))), ignorenulls=True).over(split))
    effect = last.groupBy("path", "start").agg(F.max_by(F.struct("set_to", "upto"), "id").alias("effect"))
    every = lines.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n_lines")).drop("n_lines")
    splits = every.join(effect, ["path", "start"], "left").select(
        "path", "start", F.col("effect.set_to").alias("set_to"), odd(F.coalesce("effect.upto", F.lit(0))).alias("turned")
    )
    of_file = Window.partitionBy("path").orderBy("start")  # one row per split
    before = of_file.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(F.when(F.col("set_to").isNull(), F.col("turned").cast("int"))).over(of_file), F.lit(0))
    splits = splits.withColumn("turned_upto", turned)
    fixed_at = F.last(flipped(flipped(F.col("set_to"), F.col("turned")), odd(F.col("turned_upto"))), ignorenulls=True).over(before)
    begins = flipped(F.coalesce(fixed_at, F.lit(False)), odd(F.coalesce(F.lag("turned_upto").over(of_file), F.lit(0))))
    splits = splits.select(F.col("path").alias("s_path"), F.col("start").alias("s_start"), begins.alias("inside"))

    met = lines.join(splits, (F.col("path") == F.col("s_path")) & (F.col("start") == F.col("s_start")))
    earlier = split.rowsBetween(Window.unboundedPreceding, -1)
    met = met.withColumn("upto", F.sum("turns").over(split))
    set_to = F.last(flipped(F.col("fixed"), odd(F.col("upto"))), ignorenulls=True).over(earlier)
    state = flipped(F.coalesce(set_to, F.col("inside")), odd(F.coalesce(F.lag("upto").over(split), F.lit(0))))
    met = met.withColumn("inside_here", state)
    after = F.when(F.col("fixed").isNotNull(), F.col("fixed")).otherwise(flipped(F.col("inside_here"), F.col("turns") == 1))
    met = met.withColumns({"after": after, "number": F.sum((~F.col("inside_here")).cast("int")).over(split)})
    blank = F.btrim("text", F.lit(" \t")) == ""
    filled = F.sum((~F.col("inside_here") & ~blank).cast("int")).over(split)
    met = met.withColumn("heads", (F.col("start") == 0) & (filled == 1) & ~F.col("inside_here") & ~blank)
    parts = met.groupBy("path", "start", "source", "number").agg(
        F.sort_array(F.collect_list(F.struct("id", "text"))).alias("held"),  # the lines of one record
        F.max("heads").alias("is_head"),
        F.max_by("after", "id").alias("open"),
    )
    parts = parts.withColumn("record", F.array_join(F.transform("held", lambda x: x["text"]), "\n"))
    done = parts.where("number > 0 and not open").select("path", "source", "record", "is_head")
    pieces = parts.where("number = 0 or open").withColumn("begun", F.sum((F.col("number") > 0).cast("int")).over(Window.partitionBy("path").orderBy("start", "number")))
    joined = pieces.groupBy("path", "source", "begun").agg(F.sort_array(F.collect_list(F.struct("start", "number", "record"))).alias("held"), F.max("is_head").alias("is_head"))
    joined = joined.select("path", "source", F.array_join(F.transform("held", lambda x: x["record"]), "\n").alias("record"), "is_head")
    return done.union(joined).where(F.btrim("record") != "")


def _names(head: str) -> tuple[str, ...]:
    return tuple(n.lstrip("\ufeff").strip() for n in next(csv.reader([head])))


def header_groups(spark: SparkSession, sources: Mapping[int, str]) -> list[Group]:
    """The sources by header and way of reading, so that each group is one scan.

    Empty files belong to none. Names are trimmed; scans go by position within
    a group, whose files all have the same names in the same order. The driver
    sees distinct headers with the sources they occur in, never a list of files;
    a source with files of several groups is told apart by a join on the path.
    """
    path = new_shared_path(spark, "file-heads")
    file_heads(spark, list(sources.values())).write.parquet(path)
    return _grouped(spark, spark.read.parquet(path), sources)


def _grouped(spark: SparkSession, heads: DataFrame, sources: Mapping[int, str]) -> list[Group]:
    broken = (_quotes(F.col("head")) % 2 == 1) & (F.col("kind") != LINES)
    if heads.where(broken).take(1):  # the header itself holds a line break: its first record tells
        full = records(spark, list(sources.values()), heads.where(broken)).where("is_head").select("path", F.col("record").alias("full"))
        heads = heads.join(full, "path", "left").withColumn("head", F.coalesce("full", "head")).drop("full")
        path = new_shared_path(spark, "file-heads")
        heads.write.parquet(path)
        heads = spark.read.parquet(path)
    first = F.when(F.col("kind") == WHOLE, F.regexp_extract("head", "^[^\r]*", 0)).otherwise(F.col("head"))
    heads = heads.withColumn("head", first)
    found: dict[tuple[tuple[str, ...], str], list[tuple[str, int | None]]] = {}
    for head, kind, source in heads.select("head", "kind", "source").distinct().collect():
        found.setdefault((_names(head), kind), []).append((head, source))
    uses: dict[int | None, int] = {}
    for members in found.values():
        for source in {s for _, s in members}:
            uses[source] = uses.get(source, 0) + 1
    groups = []
    for (header, kind), members in found.items():
        ids = {s for _, s in members}
        known = ids <= set(sources)
        roots = [sources[i] for i in sorted(ids)] if known else list(sources.values())
        files = None
        if not known or any(uses[i] > 1 for i in ids):
            files = heads.where((F.col("kind") == kind) & F.col("head").isin([h for h, _ in members]))
        groups.append(Group(header, kind, tuple(roots), files))
    return sorted(groups, key=lambda g: (g.header, g.kind))


def audited_groups(spark: SparkSession, records: DataFrame, sources: Mapping[int, str] | None = None) -> list[Group]:
    """Header groups of all readable files in audit records, without a look at the files.

    Without ``sources`` the folders of the audited files are scanned, each group
    by a join on the path.
    """
    readable = records.where("columns is not null and path is not null")
    cells = F.transform("columns", lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')))
    source = F.regexp_extract("path", fv.RAW_FILE_ID_PATTERN, 1).try_cast("int")
    if sources is None:
        folders = readable.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()
        sources, source = dict(enumerate(sorted(r.folder for r in folders.collect()))), F.lit(None).cast("int")
    heads = readable.select(as_scanned(F.col("path")).alias("path"), source.alias("source"), F.array_join(cells, ",").alias("head"), "kind")
    return _grouped(spark, heads, sources)


def as_scanned(path: Column) -> Column:
    """A plain local path as scans name it."""
    for char in '% "<>#?^`{|}\\':
        path = F.replace(path, F.lit(char), F.lit(f"%{ord(char):02X}"))
    return F.regexp_replace(path, "^file:/+", "file:/")


def scan_group(
    spark: SparkSession, header: Sequence[str], paths: Sequence[str], id_pattern: str = fv.RAW_FILE_ID_PATTERN, multi_line: bool = False
) -> DataFrame:
    """One scan over all files with this header, as text, tagged with the id in the path.

    A row with more or fewer fields than the header keeps its raw text in
    ``BROKEN``, else null; only a reader that prunes no columns can tell.
    ``multi_line`` reads each file as a whole.
    """
    names = cell_names(header)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    raw = spark.read.schema(schema).options(**_OPTIONS).option("columnPruning", False)
    raw = raw.csv(list(paths), header=True, recursiveFileLookup=True, multiLine=multi_line)
    return raw.select(source_id(id_pattern).alias("dataset_id"), F.col("_metadata.file_path").alias(_PATH), *names)


_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
_PATH = "_scanned_path"


def cell_names(header: Sequence[str]) -> list[str]:
    """The header's names, unique and filled, and BROKEN."""
    return [*[c if c and c not in header[:i] else f"_column_{i}" for i, c in enumerate(header)], BROKEN]


def scan(spark: SparkSession, group: Group) -> DataFrame:
    """dataset_id, the group's columns as text and ``BROKEN``, for all its files."""
    names = cell_names(group.header)
    if group.kind == RECORDS:
        rows = records(spark, group.roots, group.files).where("not is_head")
        ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
        parsed = F.from_csv("record", F.lit(ddl), {**_OPTIONS, "multiLine": "true"})
        return rows.select(F.col("source").alias("dataset_id"), parsed.alias("cells")).select("dataset_id", "cells.*")
    raw = scan_group(spark, group.header, group.roots, multi_line=group.kind == WHOLE)
    if group.files is not None:
        raw = raw.join(group.files.select(F.col("path").alias(_PATH)), _PATH, "left_semi")
    return raw.drop(_PATH)


WRITTEN_NAMING = "source=sdmx_data_{id}"


def write_wide(df: DataFrame, path: str) -> None:
    """Wide rows with a ``dataset_id`` as one source folder per dataset.

    Rows stay where they are; a dataset is as many part files as there are
    tasks that hold it.
    """
    named = df.withColumn("source", F.format_string("sdmx_data_%d", F.col("dataset_id"))).drop("dataset_id")
    named.write.mode("overwrite").partitionBy("source").csv(path, header=True, escape='"')
