"""SimHash fingerprints of documents and the search for near ones in permuted block tables.

A term is a distinct word (run without blanks and control characters 9 to 13).
It weighs 1 to 3 by its length and as much again from its 2nd, 4th and 8th
occurrence on. Each of the 128 bits of its hash votes with that weight; a bit of
the fingerprint is set where more than half of all weight votes for it. Equal
texts have equal fingerprints; a text without words has no bit set.

Votes are sums over exploded words: 64 columns count two bits each, in the upper
and the lower half of a long, so that Spark adds them up in generated code and
before any shuffle.

The search finds all fingerprints within a Hamming radius: of `blocks` equal
blocks, at least blocks - radius are the same in two such fingerprints. Each
table brings another choice of so many blocks to the front and meets
fingerprints with equal fronts; a pair counts in the first table it agrees in,
and only if its distance is within the radius. Pairs are joined between distinct
fingerprints, each with its number of rows, and only summed up.

Everything is DataFrame functions. Defined cases: a null text counts as the empty
one; documents follow each other by descending id, null ids last, different
texts of one id by a hash, of repeated rows the next one is a copy; the first
document follows the last; a lone document follows itself; an empty table gives
no row. Extra columns are ignored. A text may hold up to 2^31 / 12 words.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import written

RADIUS, BLOCKS = 6, 8
WIDTH = 128
_LOW = (1 << 32) - 1
_LANES = (1 << 32) | 1  # bits j and j + 32 of a shifted hash
#: Of equal words in a row, these add their weight once more.
_COUNTED = (1, 2, 4, 8)


def word_hashes(text: Column) -> Column:
    """Sorted hashes of all words; the two lowest bits hold the weight of the word's length, 0 for no word."""

    def hashed(word: Column) -> Column:
        size = F.when(F.length(word) > 6, 3).when(F.length(word) > 3, 2).when(F.length(word) > 0, 1).otherwise(0)
        return F.xxhash64(word).bitwiseAND(F.lit(-4).cast("long")).bitwiseOR(size.cast("long"))

    return F.sort_array(F.transform(F.split(text, r"[\x20\x09-\x0D]+"), hashed))


def votes(texts: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """keys, hi, lo: the fingerprint of each text. Rows with equal keys must hold equal texts."""
    terms = texts.select(*keys, word_hashes(text).alias("terms")).select(*keys, "terms", F.posexplode("terms").alias("place", "term"))

    def same(back: int) -> Column:
        return F.get("terms", F.col("place") - back).eqNullSafe(F.col("term"))

    counted = reduce(Column.__or__, [(same(n - 1) & ~same(n)) if n > 1 else ~same(1) for n in _COUNTED])
    weight = F.when(counted, F.col("term").bitwiseAND(F.lit(3).cast("long"))).otherwise(F.lit(0).cast("long"))
    counted_terms = terms.select(*keys, "place", "term", weight.alias("weight")).where("weight > 0 or place = 0")
    hashed = counted_terms.select(*keys, "weight", F.xxhash64("term").alias("h0"), F.xxhash64("term", F.lit(1)).alias("h1"))
    lanes = {f"v{half}_{j}": f"sum((shiftrightunsigned(h{half}, {j}) & {_LANES}L) * weight)" for half in (0, 1) for j in range(32)}
    summed = hashed.groupBy(*keys).agg(F.sum("weight").alias("total"), *[F.expr(v).alias(k) for k, v in lanes.items()])
    return summed.select(*keys, _majority(0).alias("hi"), _majority(1).alias("lo"))


def _majority(half: int) -> Column:
    """The 64 bits that more than half of the weight votes for."""
    bits = []
    for j in range(32):
        for at, n in ((j, f"(v{half}_{j} & {_LOW}L)"), (j + 32, f"shiftrightunsigned(v{half}_{j}, 32)")):
            bits.append(f"shiftleft(CAST(2 * {n} > total AS long), {at})")
    return F.expr(" | ".join(bits))


def as_text(hi: str = "hi", lo: str = "lo") -> Column:
    """A fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(hi), 16, "0"), F.lpad(F.hex(lo), 16, "0")))


def distance(a_hi: str, a_lo: str, b_hi: str, b_lo: str) -> Column:
    """Number of different bits."""
    return F.bit_count(F.col(a_hi).bitwiseXOR(F.col(b_hi))) + F.bit_count(F.col(a_lo).bitwiseXOR(F.col(b_lo)))


def likeness(a_hi: str, a_lo: str, b_hi: str, b_lo: str) -> Column:
    """Share of equal bits."""
    return 1 - distance(a_hi, a_lo, b_hi, b_lo) / F.lit(float(WIDTH))


def _block(hi: str, lo: str, i: int, blocks: int) -> str:
    width = WIDTH // blocks
    half, at = (hi, i) if i < blocks // 2 else (lo, i - blocks // 2)
    return f"(shiftrightunsigned({half}, {64 - width * (at + 1)}) & {(1 << width) - 1}L)"


def block_tables(df: DataFrame, hi: str = "hi", lo: str = "lo", radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Each row once per table, with ``entry``: the number of the table, above the blocks that it brings to the front."""
    front, width = blocks - radius, WIDTH // blocks
    tables = list(combinations(range(blocks), front))
    if WIDTH % (2 * blocks) or front < 1 or front * width > 56 or len(tables) > 128:
        raise ValueError(f"no tables of {blocks} blocks for a radius of {radius}")
    entries = []
    for number, chosen in enumerate(tables):
        entries.append(" | ".join([f"{number << 56}L", *[f"shiftleft({_block(hi, lo, i, blocks)}, {width * rank})" for rank, i in enumerate(chosen)]]))
    return df.select("*", F.explode(F.expr(f"array({', '.join(entries)})")).alias("entry"))


def within(queries: DataFrame, index: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """q_hi, q_lo, n_within: how many rows of the index lie within the radius of each query, itself included.

    queries: distinct hi, lo. index: distinct hi, lo and ``n``, its number of rows. Exact.
    """
    tables = list(combinations(range(blocks), blocks - radius))
    asked = block_tables(queries.select(F.col("hi").alias("q_hi"), F.col("lo").alias("q_lo")), "q_hi", "q_lo", radius, blocks)
    held = block_tables(index.select("hi", "lo", "n"), "hi", "lo", radius, blocks).withColumnRenamed("entry", "i_entry")
    near = distance("q_hi", "q_lo", "hi", "lo") <= radius
    equal = F.expr(" | ".join(f"shiftleft(CAST({_block('q_hi', 'q_lo', i, blocks)} = {_block('hi', 'lo', i, blocks)} AS int), {i})" for i in range(blocks)))
    number = (F.shiftrightunsigned("entry", 56) + 1).cast("int")
    upto = F.element_at(F.array(*[F.lit((2 << max(t)) - 1) for t in tables]), number)
    chosen = F.element_at(F.array(*[F.lit(sum(1 << i for i in t)) for t in tables]), number)
    first = equal.bitwiseAND(upto) == chosen  # no earlier table brings equal blocks to the front
    return (
        asked.join(held, (F.col("entry") == F.col("i_entry")) & near & first)
        .groupBy("q_hi", "q_lo")
        .agg(F.sum("n").alias("n_within"))
    )


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, body and key, which is the same for repeated rows only."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), F.col("body"))
    return rows.select("doc_id", "body", F.unhex(F.sha2(named, 256)).alias("key"))


def in_order(rows: DataFrame) -> DataFrame:
    """doc_id, key, n_chars, n, key_after: distinct rows and the next one by descending id, the first after the last; written.

    A range shuffle of ids sorts them; only the ends of its partitions meet in one task.
    """
    ids = rows.groupBy("key", "doc_id", F.length("body").cast("long").alias("n_chars")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    placed = written(ids.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "id-order")
    ends = placed.groupBy(F.shiftrightunsigned("at", 33).alias("part")).agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    all_ends = Window.orderBy("part")  # one row per partition
    whole = all_ends.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    jumps = ends.select("last_at", F.coalesce(F.lead("first_at").over(all_ends), F.first("first_at").over(whole)).alias("jump"))
    after = placed.select(F.col("at").alias("a_at"), F.col("key").alias("key_after"))
    return (
        placed.join(jumps, F.col("at") == F.col("last_at"), "left")
        .withColumn("next_at", F.coalesce("jump", F.col("at") + 1))
        .join(after, F.col("next_at") == F.col("a_at"))
        .select("doc_id", "key", "n_chars", "n", "key_after")
    )


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, queries_of: int = 100) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near for every row.

    The edited text has its last third replaced by the beginning of the next
    document. n_near is the number of other rows whose fingerprint lies within
    the radius, for ids divisible by `queries_of`, else null.
    """
    rows = _rows(docs, id_col, text_col)
    ids = written(in_order(rows), "id-edges")
    # repeated rows meet before the shuffle; the three uses below share it
    texts = rows.groupBy("key").agg(F.first("body").alias("body"))
    copies = F.array(F.struct(F.col("key_after"), F.lit(1).cast("long").alias("n_rows")), F.struct(F.col("key").alias("key_after"), (F.col("n") - 1).alias("n_rows")))
    edges = ids.select("doc_id", "key", "n_chars", F.inline(copies)).where("n_rows > 0")
    own = written(votes(texts, ["key"], F.col("body")), "fingerprints")
    heads = texts.withColumnRenamed("key", "h_key").join(
        edges.select(F.col("key").alias("e_key"), "key_after", F.expr("n_chars div 3").cast("int").alias("cut")), F.col("h_key") == F.col("key_after")
    ).select("e_key", "key_after", "cut", F.substring("body", F.lit(1), F.col("cut")).alias("head"))
    edited = texts.join(heads, F.col("key") == F.col("e_key")).select(
        "key", "key_after", F.concat(F.substring("body", F.lit(1), F.length("body") - F.col("cut")), F.col("head")).alias("text")
    )
    edited = edited.select("key", "key_after", "text", F.unhex(F.sha2("text", 256)).alias("sha"))
    changed = votes(edited, ["key", "key_after", "sha"], F.col("text")).select(
        F.col("key").alias("c_key"), F.col("key_after").alias("c_after"), "sha", F.col("hi").alias("e_hi"), F.col("lo").alias("e_lo")
    )
    index = own.join(ids.select(F.col("key").alias("i_key"), "n", F.col("doc_id").alias("i_id")), F.col("key") == F.col("i_key"))
    asked = index.where(F.col("i_id") % queries_of == 0).select("hi", "lo").distinct()
    near = within(asked, index.groupBy("hi", "lo").agg(F.sum("n").alias("n")), radius)
    after = own.select(F.col("key").alias("n_key"), F.col("hi").alias("n_hi"), F.col("lo").alias("n_lo"))
    joined = (
        edges.join(own.withColumnRenamed("key", "o_key"), F.col("key") == F.col("o_key"))
        .join(after, F.col("key_after") == F.col("n_key"))
        .join(changed, (F.col("key") == F.col("c_key")) & (F.col("key_after") == F.col("c_after")))
        .join(near, (F.col("doc_id") % queries_of == 0) & (F.col("hi") == F.col("q_hi")) & (F.col("lo") == F.col("q_lo")), "left")
    )
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))))
    return each.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        as_text().alias("fingerprint"),
        as_text("e_hi", "e_lo").alias("edited_fingerprint"),
        likeness("hi", "lo", "e_hi", "e_lo").alias("near_edited"),
        likeness("hi", "lo", "n_hi", "n_lo").alias("near_next"),
        (F.col("n_within") - 1).alias("n_near"),
    )
