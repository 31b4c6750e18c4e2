"""Shards of near equal size from ordered atomic groups: the smallest feasible capacity, then the cuts.

Groups are equal texts; their order is that of the text's SHA-256. The capacity
is found by binary search: a capacity is feasible when filling shards greedily,
group after group, needs no more than the given number. The greedy check only
asks "which is the last group end up to x", so the driver holds group ends only
around the answers: first the ends of 16,384 hash ranges, then finer ends where
a check could still fall either way, until both readings agree. What it holds
is bounded by a parameter, however many groups there are.

Law: ``bytes``. The largest shard is as small as any contiguous cut allows.

Defined cases: a null text counts as the empty one; rows with a null id come
first within their group; repeated rows get slots of their own; an empty table
gives no row. Extra columns are ignored. A group larger than an even share sets
the capacity, as groups are never torn.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.llm.common import written

ROW_BYTES = 16
HASH_RANGES = 1 << 14
#: Rows of one text are counted and numbered in so many parts, so that no task holds a hot text.
SALTS = 1024


@dataclass
class Ends:
    """Known group ends in ascending order, each with the number of group ends up to it; 0 and the total are among them."""

    at: list[int]
    rank: list[int]

    def last(self, x: int) -> tuple[int, int]:
        """The last group end up to x lies between these two; they are equal where that is settled."""
        i = bisect.bisect_right(self.at, x) - 1
        if i == len(self.at) - 1:
            return self.at[-1], self.at[-1]
        settled = self.at[i] == x or self.rank[i + 1] - self.rank[i] <= 1
        return self.at[i], self.at[i] if settled else x

    def fill(self, capacity: int, shards: int, high: bool) -> list[int]:
        """Where greedy filling cuts; `high` reads unsettled ends as far as they could reach, else as short."""
        cuts, x = [], 0
        for _ in range(shards):
            x = self.last(x + capacity)[high]
            cuts.append(x)
        return cuts

    def smallest(self, lo: int, hi: int, shards: int, high: bool) -> int:
        while lo < hi:
            mid = (lo + hi) // 2
            if self.fill(mid, shards, high)[-1] >= self.at[-1]:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def unsettled(self, lo: int, hi: int, shards: int) -> list[tuple[int, int]]:
        """Stretches between known ends that decide between the capacities lo and hi, at most one for each shard."""
        found, a, b = [], 0, 0
        for _ in range(shards):
            first = bisect.bisect_right(self.at, a + lo) - 1
            last = min(bisect.bisect_right(self.at, b + hi), len(self.at) - 1)
            open_ = [i for i in range(first, last) if self.rank[i + 1] - self.rank[i] > 1]
            if open_:
                found.append((self.at[open_[0]], self.at[open_[-1] + 1]))
            a, b = self.last(a + lo)[0], self.last(b + hi)[1]
        merged: list[tuple[int, int]] = []
        for start, stop in sorted(found):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
            else:
                merged.append((start, stop))
        return merged

    def add(self, ends: list[tuple[int, int]]) -> None:
        both = dict(zip(self.at, self.rank, strict=True)) | dict(ends)
        self.at = sorted(both)
        self.rank = [both[x] for x in self.at]


def minimax_cuts(groups: DataFrame, ends: Ends, largest: int, shards: int, held: int = 1 << 14) -> tuple[int, list[int]]:
    """The smallest feasible capacity and its greedy cuts.

    groups: one row per group with ``group_end`` (bytes up to and with it) and
    ``group_rank`` (groups up to and with it). ends: some of these, known
    beforehand. held: the most ends that one round brings to the driver.
    """
    total = ends.at[-1]
    bottom, top = max(largest, -(-total // shards)), -(-total // shards) + largest
    while True:
        lo, hi = ends.smallest(bottom, top, shards, True), ends.smallest(bottom, top, shards, False)
        if lo == hi and (cuts := ends.fill(lo, shards, False)) == ends.fill(lo, shards, True):
            return lo, cuts
        gaps = ends.unsettled(lo, hi, shards)
        bins = max(2, held // len(gaps))
        near, at = F.lit(False), F.lit(None).cast("long")
        for i, (a, b) in enumerate(gaps):
            inside = (F.col("group_end") > a) & (F.col("group_end") <= b)
            width = -(-(b - a) // bins)
            near = near | inside
            at = F.when(inside, i * bins + F.expr(f"(group_end - {a} - 1) div {width}")).otherwise(at)
        found = groups.where(near).groupBy(at.alias("bin")).agg(F.min(F.struct("group_end", "group_rank")), F.max(F.struct("group_end", "group_rank")))
        # both ends of a bin, so that every round settles something, however the ends crowd
        ends.add([tuple(end) for row in found.collect() for end in row[1:]])  # at most 2 * held


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int").alias("salt"),
    )
    parts = (
        rows.groupBy("sha", "salt")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
        .withColumn("range", F.expr(f"conv(substring(hex(sha), 1, 4), 16, 10) div {(1 << 16) // HASH_RANGES}").cast("int"))
    )
    parts = written(parts, "shard-parts")
    sums = parts.groupBy("range").agg(F.sum("n"), F.sum("bytes"), F.count_distinct("sha")).orderBy("range").collect()  # at most HASH_RANGES
    if not sums:
        return rows.select(*_result(F.lit(0), F.lit(0).cast("long")))
    counts = np.array([list(r) for r in sums], dtype=np.int64)
    upto = np.cumsum(counts[:, 1:], axis=0)
    before = upto - counts[:, 1:]
    spark = docs.sparkSession
    offsets = spark.createDataFrame([(int(r), *map(int, b)) for r, b in zip(counts[:, 0], before, strict=True)], "range int, rows0 long, bytes0 long, groups0 long")
    in_order = Window.partitionBy("range").orderBy("sha", "salt")
    by_group = Window.partitionBy("range").orderBy("sha")
    units = parts.join(F.broadcast(offsets), "range").select(  # at most HASH_RANGES rows
        "range",
        "sha",
        "salt",
        (F.col("rows0") + F.sum("n").over(in_order) - F.col("n")).alias("rows_before"),
        (F.col("bytes0") + F.sum("bytes").over(by_group)).alias("group_end"),
        (F.col("groups0") + F.dense_rank().over(by_group)).alias("group_rank"),
        F.sum("bytes").over(Window.partitionBy("range", "sha")).alias("group_bytes"),
    )
    units = written(units, "shard-units")
    known = Ends([0, *map(int, upto[:, 1])], [0, *map(int, upto[:, 2])])
    largest = units.agg(F.max("group_bytes")).first()[0]
    _, cuts = minimax_cuts(units, known, largest, shards)
    shard = F.size(F.filter(F.array(*map(F.lit, cuts[:-1])), lambda c: c < F.col("group_end")))
    placed = units.withColumn("shard", shard)
    starts = {r.shard: r.at for r in placed.groupBy("shard").agg(F.min("rows_before").alias("at")).collect()}  # at most `shards`
    first = F.element_at(F.array(*[F.lit(starts.get(i, 0)).cast("long") for i in range(shards)]), F.col("shard") + 1)
    placed = placed.select(F.col("sha").alias("u_sha"), F.col("salt").alias("u_salt"), "shard", (F.col("rows_before") - first).alias("slot0"))
    number = F.row_number().over(Window.partitionBy("sha", "salt").orderBy("doc_id"))
    return (
        rows.join(placed, (F.col("sha") == F.col("u_sha")) & (F.col("salt") == F.col("u_salt")))
        .withColumn("slot", (F.col("slot0") + number - 1).cast("long"))
        .select(*_result(F.col("shard"), F.col("slot")))
    )


def _result(shard: F.Column, slot: F.Column) -> list[F.Column]:
    return [
        F.col("doc_id"),
        F.col("size"),
        F.col("text_crc32"),
        F.lit("bytes").alias("law"),
        shard.cast("int").alias("shard"),
        slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    ]
