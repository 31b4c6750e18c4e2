"""Similarity self-join of documents by the Jaccard index of their word n-grams, with Bayesian candidate pruning.

1. Every text becomes a set of hashed n-grams and a MinHash signature. Texts
   with equal sets are one class from here on.
2. Signatures are cut into bands; classes that agree in a band are candidates.
   A pair at the threshold misses all bands with probability
   (1 - t^ROWS)^BANDS, below 1e-6 here.
3. Buckets of candidates are cut into cells of at most 2 * BLOCK classes, so a
   huge bucket is many cells, and no pair is ever a row: each cell settles its
   pairs in memory. A pair belongs to the first band it agrees in, hence to one
   cell.
4. In a cell, signatures are compared a few hashes at a time. After n hashes
   with m equal, the posterior probability (uniform prior) that the Jaccard
   index reaches t is P(Binomial(n + 1, t) <= m); pairs below EPSILON go. What
   is left is verified exactly on the n-gram sets.
5. A cell returns, per class, its number of links, and links that span its
   groups; components of these are the duplicate groups.

Counting the links of a group of g different near copies compares its pairs,
g * g / 2 of them, spread over cells. Exact copies cost nothing.

Words are runs without blanks and control characters 9 to 13. Hashes have 64
bits. Rows are told apart by id and text, so null and repeated ids meet only their own
text. Defined cases: a text of fewer words than n has one n-gram, all of them; null and
empty texts have none, link to nothing and are groups of their own; rows with
equal texts link to each other; a null id stays null and never names a group
unless all its ids are null; an empty table gives no row. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import in_batches, slices, utf8, written
from tallyspan.llm.components import components

N = 5
THRESHOLD = 0.8
ROWS, BANDS = 5, 36
HASHES = ROWS * BANDS
EPSILON = 1e-7
STEP = 30  # hashes compared at a time
BLOCK = 512

_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_MUL = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_BAND_MUL = _rng.integers(0, 1 << 62, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def grams(text: str | None, n: int = N) -> np.ndarray:
    """The sorted distinct hashes of a text's n-grams."""
    words = utf8(text).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    w = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    last = len(w) - n + 1
    h = w[:last]
    for k in range(1, n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[k : last + k]
    return np.unique(_mixed(h))


def signature(found: np.ndarray) -> np.ndarray:
    """The MinHash values of a set, HASHES of 32 bits."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(out, ((x[i : i + 512, None] ^ _XOR) * _MUL).min(axis=0), out=out)
    return out


def bands(signatures: np.ndarray) -> np.ndarray:
    """One key per band, from signatures of shape (rows, HASHES)."""
    cut = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    return _mixed((cut * _BAND_MUL).sum(axis=2, dtype=np.uint64)).view(np.int64)


def set_key(found: np.ndarray) -> int:
    """One hash of a whole set."""
    return int(xxhash.xxh3_64_intdigest(found.tobytes())) - (1 << 63)


@cache
def least_equal(step: int = STEP, hashes: int = HASHES, t: float = THRESHOLD, epsilon: float = EPSILON) -> tuple[int, ...]:
    """After step, 2 step, ... hashes: the fewest equal ones with which a pair may still reach t."""
    out = []
    for n in range(step, hashes + 1, step):
        total, m = 0.0, 0
        while m <= n:
            total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= epsilon:
                break
            m += 1
        out.append(m)
    return tuple(out)


def links_in(band: int, left: list[int], right: list[int] | None, signatures: np.ndarray, keys: np.ndarray, sets: list[np.ndarray], t: float = THRESHOLD) -> list[tuple[int, int]]:
    """Linked pairs of a cell that belong to its band: within `left`, or between `left` and `right`. All are row numbers."""
    a = np.array(left)
    b = a if right is None else np.array(right)
    open_ = np.ones((len(a), len(b)), bool) if right is not None else np.triu(np.ones((len(a), len(a)), bool), 1)
    for k in range(band):
        open_ &= keys[a, k][:, None] != keys[b, k][None, :]
    open_ &= keys[a, band][:, None] == keys[b, band][None, :]
    i, j = np.nonzero(open_)
    equal = np.zeros(len(i), np.int64)
    for step, least in enumerate(least_equal(t=t)):
        at = slice(step * STEP, (step + 1) * STEP)
        equal += (signatures[a[i], at] == signatures[b[j], at]).sum(axis=1)
        stays = equal >= least
        i, j, equal = i[stays], j[stays], equal[stays]
    if not len(i):
        return []
    size = np.array([len(s) for s in sets])
    common = shared(sets, a[i], b[j])
    hit = common >= t * (size[a[i]] + size[b[j]] - common) - 1e-9
    return list(zip(a[i[hit]].tolist(), b[j[hit]].tolist(), strict=True))


def shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, columns: int = 2048) -> np.ndarray:
    """How many n-grams the sets of each pair share, exactly."""
    if len(a) <= 24:
        return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b, strict=True)])
    used = np.unique(np.concatenate([a, b]))
    flat = np.concatenate([sets[x] for x in used])
    row = np.repeat(np.arange(len(used)), [len(sets[x]) for x in used])
    _, gram, n = np.unique(flat, return_inverse=True, return_counts=True)
    twice = n[gram] > 1  # an n-gram of one set is shared by none
    number = np.cumsum(n > 1) - 1
    row, gram = row[twice], number[gram[twice]]
    order = np.argsort(gram, kind="stable")
    row, gram = row[order], gram[order]
    both = np.zeros((len(used), len(used)), np.float32)
    for start in range(0, int(gram[-1]) + 1 if len(gram) else 0, columns):
        lo, hi = np.searchsorted(gram, [start, start + columns])
        has = np.zeros((len(used), columns), np.float32)
        has[row[lo:hi], gram[lo:hi] - start] = 1
        both += has @ has.T
    place = np.searchsorted(used, np.stack([a, b]))
    return both[place[0], place[1]].astype(np.int64)


def _groups(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """As few links as connect what the pairs connect."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in pairs:
        p, q = find(x), find(y)
        if p != q:
            root[q] = p
            out.append((x, y))
    return out


# --- Spark ---------------------------------------------------------------------


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text), set_key (null without n-grams) and the band keys of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            found = [grams(t.as_py()) for t in batch.column(2)]
            keys = bands(np.stack([signature(g) for g in found]))
            held = pa.array([set_key(g) if len(g) else None for g in found], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), held, lists], ["doc_id", "text_key", "set_key", "bands"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("body"))
    return in_batches(rows, run, "doc_id long, text_key long, set_key long, bands array<long>")


def _memberships(classes: DataFrame) -> DataFrame:
    """band, bucket, node, n_nodes for buckets of at least two classes; of buckets with the same classes the first band's."""
    keys = classes.select(F.col("c_key").alias("node"), F.posexplode("c_bands").alias("band", "bucket"))
    buckets = (
        keys.groupBy("band", "bucket")
        .agg(F.count(F.lit(1)).alias("n_nodes"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who"), F.min("node").alias("least"))
        .where("n_nodes > 1")
    )
    first = buckets.groupBy("n_nodes", "who", "least").agg(F.min(F.struct("band", "bucket")).alias("at"))
    first = first.select(F.col("at.band").alias("f_band"), F.col("at.bucket").alias("f_bucket"), "n_nodes")
    return keys.join(first, (F.col("band") == F.col("f_band")) & (F.col("bucket") == F.col("f_bucket"))).select("band", "bucket", "node", "n_nodes")


def _cells(members: DataFrame) -> DataFrame:
    """band, bucket, i, j, block, node: each member in every cell of its block; cell (i, j) holds blocks i and j of a bucket."""
    blocks = F.ceil(F.col("n_nodes") / F.lit(BLOCK)).cast("int")
    block = F.pmod(F.xxhash64("node"), blocks).cast("int")
    spread = members.select("band", "bucket", "node", block.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return spread.select("band", "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node")


def _sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node, n_docs and packed n-grams of the named classes, from one of their documents each, found by id and text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("body"))
    met = rows.join(nodes, (F.col("text_key") == F.col("c_text")) & F.col("doc_id").eqNullSafe(F.col("c_first"))).select("c_key", "n_docs", "body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 512):
            out = []
            for node, n_docs, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = grams(body)
                if len(found) and set_key(found) == node:  # hashes of texts may collide
                    out.append((node, n_docs, found.tobytes()))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.binary()], strict=True)], ["node", "n_docs", "grams"])

    return in_batches(met, run, "node long, n_docs long, grams binary").dropDuplicates(["node"])


def _settle(cells: DataFrame, t: float) -> DataFrame:
    """node, n_links, n_text_links, other: what each cell finds. `other` is a link that spans a group, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                if row[:4] != at:
                    if len(held) > 1:
                        yield from settled(at, held)
                    at, held = row[:4], []
                held.append(row[4:])
        if len(held) > 1:
            yield from settled(at, held)

    def settled(at: tuple, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        band, _, i, j = at
        sets = [np.frombuffer(h[3], np.uint64) for h in held]
        signatures = np.stack([signature(s) for s in sets])
        left = [k for k, h in enumerate(held) if h[0] == i]
        right = None if i == j else [k for k, h in enumerate(held) if h[0] == j]
        if not left or right == []:
            return
        pairs = links_in(band, left, right, signatures, bands(signatures), sets, t)
        if not pairs:
            return
        rows: dict[int, list[int]] = {}
        for x, y in pairs:
            for p, q in ((x, y), (y, x)):
                row = rows.setdefault(p, [0, 0])
                row[0] += held[q][2]
                row[1] += 1
        out = [(held[k][1], n, m, None) for k, (n, m) in rows.items()]
        out += [(held[x][1], 0, 0, held[y][1]) for x, y in _groups(pairs)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["node", "n_links", "n_text_links", "other"])

    return in_batches(cells, run, "node long, n_links long, n_text_links long, other long")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", t: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links, n_text_links for every row.

    class_id is the smallest id of the documents that links connect. n_links
    counts the other rows with a Jaccard index of t or more, n_text_links the
    other n-gram sets among them. t is 0.8 or more; lower thresholds need other bands.
    """
    if t < THRESHOLD:
        raise ValueError(f"the bands are laid out for {THRESHOLD} and more")
    rows = written(features(docs, id_col, text_col), "grams")
    by_set = rows.where("set_key is not null").groupBy(F.col("set_key").alias("c_key"))
    found = by_set.agg(
        F.min("doc_id").alias("c_doc"), F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("doc_id", "text_key")).alias("at"), F.first("bands").alias("c_bands")
    )  # equal sets have equal bands
    held = written(found.select("c_key", "c_doc", "n_docs", F.col("at.doc_id").alias("c_first"), F.col("at.text_key").alias("c_text"), "c_bands"), "classes")
    classes = held.drop("c_bands")
    cells = written(_cells(_memberships(held)), "cells")
    wanted = classes.join(cells.select("node").distinct(), F.col("c_key") == F.col("node"), "left_semi")
    sets = _sets(docs, wanted, id_col, text_col)
    met = cells.join(sets, "node").select("band", "bucket", "i", "j", "block", "node", "n_docs", "grams")
    met = met.repartition("band", "bucket", "i", "j").sortWithinPartitions("band", "bucket", "i", "j")
    found = written(_settle(met, t), "found")
    counts = found.groupBy(F.col("node").alias("l_key")).agg(F.sum("n_links").alias("linked"), F.sum("n_text_links").alias("texts"))
    groups = components(found.where("other is not null"), "node", "other").withColumnRenamed("node", "g_key")
    known = (
        classes.join(counts, F.col("c_key") == F.col("l_key"), "left")
        .join(groups, F.col("c_key") == F.col("g_key"), "left")
        .select("c_key", "c_doc", "n_docs", "linked", "texts", F.coalesce("root", "c_key").alias("root"))
    )
    named = known.groupBy(F.col("root").alias("n_root")).agg(F.min("c_doc").alias("class_doc"))
    known = known.join(named, F.col("root") == F.col("n_root"))
    return rows.join(known, F.col("set_key") == F.col("c_key"), "left").select(
        "doc_id",
        F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_doc")).alias("class_id"),
        F.coalesce(F.col("linked") + F.col("n_docs") - 1, F.col("n_docs") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each group, with its columns; of repeated rows one.

    Documents go by their ids, so texts move only where the ids to go are many.
    An id that names different texts is judged as a whole: it stays if one of
    its texts does.
    """
    found = written(similar(docs), "similar")
    ids = written(
        found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("stays")).where("n > 1 or not stays"), "judged"
    )
    special = ids.select(F.col("doc_id").alias("s_id"))
    repeated = ids.where("n > 1 and stays").select(F.col("doc_id").alias("r_id"))
    plain = docs.join(special, F.col("doc_id").eqNullSafe(F.col("s_id")), "left_anti")
    again = docs.join(repeated, F.col("doc_id").eqNullSafe(F.col("r_id")), "left_semi").dropDuplicates(["doc_id", "text"])
    return plain.unionByName(again)
