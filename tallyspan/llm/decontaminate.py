"""Benchmark passages within documents, up to an edit budget: pieces by pigeonhole, proof by bit-parallel distance.

An item of n letters may differ in k = n * share edits. Cut into k + 1 pieces,
one of them must stand in the document unchanged, if the item does within k
edits. One automaton finds the pieces of all items in one run over the whole
text; around each hit, Myers' bit-parallel algorithm finds the smallest distance
of the item to any stretch of text.

Texts are compared by their words: lower-case letters and digits, one blank
between words.

The automaton is built from `block_chars` letters of items at a time, so what a
task holds is bounded; more items mean more passes over the documents.

Defined cases: null and empty texts match nothing, as do items under `least`
letters (too short to tell; listed by ``short_items``); null ids are kept as
ids; items with the same text are all reported; repeated documents are reported
once for each row; empty tables give no row. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import in_batches, slices, written

SHARE = 0.06
LEAST = 40
BLOCK_CHARS = 4_000_000
_OTHER = re.compile(r"[\W_]+")


def words_of(text: str | None) -> str:
    """Lower-case words with one blank between them."""
    return _OTHER.sub(" ", (text or "").lower()).strip()


def budget(item: str, share: float = SHARE) -> int:
    return int(len(item) * share)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 consecutive pieces of nearly equal length, each with its place."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def masks(item: str) -> dict[str, int]:
    """For Myers' algorithm: the places of each letter as bits."""
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def distance(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """The smallest edit distance of an item of m letters to any stretch of the text, and the first end of such a stretch."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full
        pv = mh << 1 & full | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """The pieces of some items in one automaton. items: number and normalised text."""

    def __init__(self, items: list[tuple[int, str]], share: float = SHARE):
        self.items = [(text, budget(text, share)) for _, text in items]
        self.numbers = [number for number, _ in items]
        self.masks = [masks(text) for text, _ in self.items]
        where: dict[str, list[tuple[int, int]]] = {}
        for i, (text, edits) in enumerate(self.items):
            for at, piece in pieces(text, edits):
                where.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """number, distance, end of the best match of each item that stands in the normalised text within its budget."""
        if not text or not len(self.automaton):
            return []
        windows: dict[int, list[list[int]]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for i, at in places:
                item, edits = self.items[i]
                start = end + 1 - length - at
                lo, hi = max(0, start - edits), min(len(text), start + len(item) + edits)
                spans = windows.setdefault(i, [])
                if spans and lo <= spans[-1][0] + edits:  # the same stretch, shifted by its edits
                    spans[-1][0] = min(spans[-1][0], lo)
                    spans[-1][1] = max(spans[-1][1], hi)
                else:
                    spans.append([lo, hi])
        out = []
        for i, spans in windows.items():
            item, edits = self.items[i]
            best: tuple[int, int] | None = None
            for lo, hi in spans:
                if hi - lo < len(item) - edits:
                    continue
                found, end = distance(self.masks[i], len(item), text[lo:hi])
                if found <= edits and (best is None or found < best[0]):
                    best = found, lo + end
                    if not found:
                        break
            if best:
                out.append((self.numbers[i], *best))
        return out


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
    share: float = SHARE, least: int = LEAST, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """doc_id, item_id, distance, end: each document and each item it holds, with the smallest distance."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("body")).where("body is not null")
    chars = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body"))
    schema = "doc_id long, item_id long, distance long, end long"

    def against(block: list[tuple[int, str]]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = None
            for batch in slices(batches):
                matcher = matcher or Matcher(block, share)
                out = [(d.as_py(), *m) for d, t in zip(batch.column(0), batch.column(1), strict=True) for m in matcher.matches(words_of(t.as_py()))]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(4)], ["doc_id", "item_id", "distance", "end"])

        return in_batches(rows, run, schema)

    found = []
    for b in range(blocks):  # a block's letters are bounded
        part = items.where(F.pmod(F.xxhash64("item_id", "body"), F.lit(blocks)) == b)
        block = [(r.item_id, text) for r in part.toLocalIterator() if len(text := words_of(r.body)) >= least]
        hits = against(block)
        # of several blocks each is done before the next is fetched, so the driver and a task hold one
        found.append(hits if blocks == 1 else written(hits, "contaminated"))
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, found)


def short_items(benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", least: int = LEAST) -> DataFrame:
    """The items that are too short to be searched, with their normalised length."""
    letters = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(item_text), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return benchmark.select(F.col(item_id).alias("item_id"), F.length(letters).alias("n_chars")).where(F.col("n_chars") < least)


def clean(docs: DataFrame, benchmark: DataFrame, **how: object) -> DataFrame:
    """The documents that hold no item, with their columns. Rows with a null id are judged together."""
    hit = contaminated(docs, benchmark, **how).select(F.col("doc_id").alias("hit_id")).distinct()
    return docs.join(hit, F.col(how.get("id_col", "doc_id")).eqNullSafe(F.col("hit_id")), "left_anti")
