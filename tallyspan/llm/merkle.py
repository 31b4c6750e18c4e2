"""Merkle manifest of a table: one tree per group of rows, one tree over the groups' roots, a proof for every row.

H is the lower-case hexadecimal SHA-256 of its inputs, concatenated; digests go
in as text. A leaf is H over a row's fields, each `-` if null, else its number
of UTF-8 bytes, `:` and the value. Within a group leaves ascend by the order
column; while several nodes remain, every FAN consecutive ones (the last run:
fewer, even one) become their H. The roots of the groups, in the groups' order,
make one more tree in the same way.

An aligned block of FAN^DEPTH nodes is one row and keeps each of its levels as
one string of hexadecimal digits. Parents are hashes of substrings of fixed
width; the siblings on a node's path are what flanks it in its run, two more
substrings. The blocks' roots are the nodes of the next tier, until a group is a
single block. Positions come from a range shuffle and the counts of its
partitions, so no task sees a whole group; a block is bounded.

Defined cases: null groups come first, as do null ids within a group; rows with
equal ids follow by their leaf, and equal leaves by their place in the input;
repeated rows are leaves of their own; an empty table gives no row. Columns that
are not named are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import written

FAN, DEPTH = 8, 3
HEX = 64  # digits of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """H of a row's fields."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def lower_ascii(text: Column) -> Column:
    """The text with only A-Z in lower case."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """The rows with ``pos``, from 0 within their group, and ``size``, the rows of the group."""
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    placed = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("part", F.shiftrightunsigned("at", 33))
    stretches = placed.groupBy(F.col(group).alias("s_group"), F.col("part").alias("s_part")).agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n"))
    same = Window.partitionBy("s_group")  # one row per partition of the range shuffle
    stretches = stretches.select(
        "s_group", "s_part", "first_at", (F.sum("n").over(same.orderBy("s_part")) - F.col("n")).alias("before"), F.sum("n").over(same).alias("size")
    )
    met = placed.join(stretches, F.col(group).eqNullSafe(F.col("s_group")) & (F.col("part") == F.col("s_part")))
    return met.select(*rows.columns, (F.col("before") + F.col("at") - F.col("first_at")).alias("pos"), "size")


def _parents(level: str, fan: int) -> Column:
    width = fan * HEX
    digests = f"transform(sequence(0, (octet_length({level}) - 1) div {width}), i -> sha2(substring({level}, i * {width} + 1, {width}), 256))"
    return F.expr(f"CAST(array_join({digests}, '') AS binary)")


def blocks(nodes: DataFrame, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """grp, block, size, items (their rows in order), level_0 ... and top, for nodes with grp, pos, size, digest and row.

    Levels are binary, so that substrings are cut without reading what stands
    before them. A level above the single node of a small group is null.
    """
    span = fan**depth
    held = nodes.groupBy("grp", "size", F.expr(f"pos div {span}").alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "row"))).alias("items"))  # at most `span`
    out = held.select("grp", "size", "block", F.transform("items", lambda x: x["row"]).alias("items"), F.array_join(F.transform("items", lambda x: x["digest"]), "").cast("binary").alias("level_0"))
    for d in range(depth):
        grows = (F.col("size") > span) | (F.octet_length(f"level_{d}") > HEX)
        out = out.withColumn(f"level_{d + 1}", F.when(grows, _parents(f"level_{d}", fan)))
    top = F.coalesce(*[F.col(f"level_{d}") for d in reversed(range(depth + 1))])
    return out.withColumn("top", top)


def tree(nodes: DataFrame, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """The blocks of all nodes, each with the siblings above it (``above``) and the ``root`` of its group."""
    held = written(blocks(nodes, fan, depth), "merkle-blocks")
    largest = held.agg(F.max("size")).first()[0]
    empty = F.expr("CAST(array() AS array<struct<before: binary, behind: binary>>)")
    if largest is None or largest <= fan**depth:
        return held.select("*", empty.alias("above"), F.col("top").alias("root"))
    tops = held.where(F.col("size") > fan**depth).select(
        "grp", F.col("block").alias("pos"), F.ceil(F.col("size") / F.lit(fan**depth)).alias("size"), F.col("top").cast("string").alias("digest"), F.struct("block").alias("row")
    )
    upper = proofs(tree(tops, fan, depth), fan, depth).select(F.col("grp").alias("u_grp"), F.col("row.block").alias("u_block"), F.col("path").alias("u_path"), F.col("root").alias("u_root"))
    met = held.join(upper, F.col("grp").eqNullSafe(F.col("u_grp")) & (F.col("block") == F.col("u_block")), "left")
    return met.select(*held.columns, F.coalesce("u_path", empty).alias("above"), F.coalesce("u_root", "top").alias("root"))


def proofs(held: DataFrame, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """grp, row, digest, path, root for every node; path lists what flanks the node on each level, from its own up to the root."""
    rows = held.select("*", F.posexplode("items").alias("i", "row"))
    width, steps = fan * HEX, []
    for d in range(depth):
        run = f"substring(level_{d}, (i div {fan ** (d + 1)}) * {width} + 1, {width})"
        at = f"{HEX} * (i div {fan**d} % {fan})"
        steps.append(F.when(F.col(f"level_{d + 1}").isNotNull(), F.expr(f"named_struct('before', substring({run}, 1, {at}), 'behind', substring({run}, {at} + {HEX + 1}, {width}))")))
    path = F.concat(F.filter(F.array(*steps), lambda s: s.isNotNull()), F.col("above"))
    return rows.select("grp", "row", F.expr(f"CAST(substring(level_0, i * {HEX} + 1, {HEX}) AS string)").alias("digest"), path.alias("path"), "root")


def folded(path: Column, digest: Column) -> Column:
    """The root that a leaf's digest and the siblings on its path lead to."""
    up = F.aggregate(path, digest.cast("binary"), lambda node, s: F.sha2(F.concat(s["before"], node, s["behind"]), 256).cast("binary"))
    return up.cast("string")


def siblings_digest(path: Column) -> Column:
    """H of all siblings on the path, level by level, left to right."""
    return F.sha2(F.aggregate(path, F.lit(b""), lambda done, s: F.concat(done, s["before"], s["behind"])), 256)


def manifest(
    docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", found: Mapping[str, Column] | None = None, fan: int = FAN, depth: int = DEPTH
) -> DataFrame:
    """id (the order column), leaf, found_leaf, subroot, root and path for every row.

    found_leaf is the leaf with the fields that `found` replaces, as a later
    reading of the row may find them, where it differs; else null.
    """
    leaf = leaf_digest([F.col(c) for c in fields])
    later = leaf_digest([(found or {}).get(c, F.col(c)) for c in fields]) if found else F.lit(None).cast("string")
    rows = docs.select(F.col(order).alias("id"), F.col(group).alias("grp"), leaf.alias("digest"), later.alias("found_leaf"))
    changed = F.when(F.col("found_leaf") != F.col("digest"), F.col("found_leaf")).alias("found_leaf")
    rows = written(rows.select("id", "grp", "digest", changed, F.monotonically_increasing_id().alias("line")), "merkle-leaves")
    nodes = numbered(rows, "grp", ["id", "digest", "line"]).select("grp", "pos", "size", "digest", F.struct("id", "found_leaf").alias("row"))
    held = tree(nodes, fan, depth)
    tops = held.where("block = 0").select("grp", F.col("root").cast("string").alias("digest"))
    tops = numbered(tops.withColumn("all", F.lit(0)), "all", ["grp"])
    tops = proofs(tree(tops.select(F.col("all").alias("grp"), "pos", "size", "digest", F.struct("grp").alias("row")), fan, depth), fan, depth)
    tops = tops.select(F.col("row.grp").alias("t_grp"), F.col("path").alias("t_path"), F.col("root").alias("t_root"))
    whole = held.join(tops, F.col("grp").eqNullSafe(F.col("t_grp"))).withColumn("above", F.concat("above", "t_path"))
    whole = whole.withColumn("root", F.struct(F.col("root").cast("string").alias("subroot"), F.col("t_root").cast("string").alias("root")))
    return proofs(whole, fan, depth).select(
        F.col("row.id").alias("id"), F.col("digest").alias("leaf"), F.col("row.found_leaf").alias("found_leaf"), F.col("root.subroot").alias("subroot"), F.col("root.root").alias("root"), "path"
    )


def verified(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every row held against a later reading.

    That reading is made here: where 3 divides the CRC-32 of the decimal id, A-Z
    in its text have become lower case.
    """
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(tampered, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    made = manifest(docs, found={"text": text})
    return made.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        siblings_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("path"), F.coalesce("found_leaf", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
