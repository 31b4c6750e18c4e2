"""Substring dedup by sliding sentence spans.

A sentence here is a stretch of text up to and with a run of marks (. ! ? , ; :
or a line break), so that a passage pasted into the middle of other text has
sentences of its own. A span is a run of several consecutive sentences: from
each sentence on the shortest run of at least two with at least WORDS words.
Spans are equal when their words are. The first occurrence of a span, by
document id, then text (its MD5), then place, stays; sentences covered by any
other occurrence go.

A passage with few or no marks may hold no two whole sentences. With `passages`,
a stretch of REACH or more words without marks is cut further, behind the word
with the smallest hash among each REACH words in a row. Whether a word is one
depends on the REACH - 1 words to either side, so any 49 words hold the same run
of several whole pieces wherever they are pasted. Pieces then stand for
sentences, a span begins at a piece that has words, and the shortest run that
ends at each piece is a span, too, so that a passage's last pieces go as well.

Spans travel as 64-bit hashes with id and place, never as text. The hash table
is a plain aggregate, combined before the shuffle; a passage in a third of all
documents then meets its own rows in a join that adaptive execution can split.
Texts travel once, to meet the places to remove.

Defined cases: a null text stays null, an empty one empty, with no sentences;
rows with a null id come first in the order; different texts under one id, or
under none, are told apart by their MD5; rows with equal id and text keep or lose
the same sentences, since both hold the first occurrence; an empty table gives
no row. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import in_batches, slices, utf8, written

MARKS = ".!?,;:\n"
WORDS = 16
LEAST = 2
REACH = 9
PATTERN = f"[^{MARKS}]*[{MARKS}]+|[^{MARKS}]+"
_SENTENCE = re.compile(PATTERN)


def sentences(text: str | None) -> list[str]:
    """All of the text, cut behind marks."""
    return _SENTENCE.findall(text or "")


def lowest(ranks: list[int], reach: int = REACH) -> list[int]:
    """The places of the smallest of each `reach` ranks in a row, the last of equal ones."""
    out, at = [], -1
    for end in range(reach, len(ranks) + 1):
        start = end - reach
        if at < start:
            window = ranks[start:end]
            at = end - 1 - window[::-1].index(min(window))
        elif ranks[end - 1] <= ranks[at]:
            at = end - 1
        else:
            continue
        out.append(at)
    return out


def pieces(text: str | None) -> list[str]:
    """All of the text, cut behind marks and, in stretches of REACH or more words without any, behind words chosen by their hash."""
    out = []
    for part in sentences(text):
        rest = utf8(part) if len(part) >= 2 * REACH - 1 else b""
        found, done = rest.split(), 0
        if len(found) < REACH:
            out.append(part)
            continue
        for i in lowest(list(map(xxhash.xxh3_64_intdigest, found))):
            if i + 1 < len(found):
                after = rest.split(None, i + 1 - done)[-1]  # blanks stay with the piece before
                out.append(rest[: len(rest) - len(after)].decode())
                rest, done = after, i + 1
        out.append(rest.decode())
    return out


def spans(parts: list[str], words: int = WORDS, passages: bool = False) -> list[tuple[int, int, int]]:
    """start, end and hash of the span from each sentence on, where enough words follow; of `passages` also to each piece."""
    split = [utf8(p).split() for p in parts]
    lengths, joined = list(map(len, split)), list(map(b" ".join, split))

    def span(start: int, end: int) -> tuple[int, int, int]:
        key = xxhash.xxh3_64_intdigest(b" ".join(j for j in joined[start:end] if j))
        return start, end, key - (1 << 64) if key >> 63 else key

    out, end, held = [], 0, 0
    for start, n in enumerate(lengths):
        while end < len(parts) and (held < words or end - start < LEAST):
            held += lengths[end]
            end += 1
        if held < words or end - start < LEAST:
            break
        if n or not passages:
            out.append(span(start, end))
        held -= n
    if passages:
        known, start, held = {(a, b) for a, b, _ in out}, 0, 0
        for end, n in enumerate(lengths, 1):
            held += n
            while end - start > LEAST and held - lengths[start] >= words:
                held -= lengths[start]
                start += 1
            if n and lengths[start] and held >= words and end - start >= LEAST and (start, end) not in known:
                out.append(span(start, end))
    return out


def text_order(text_col: str) -> F.Column:
    """The first 60 bits of the text's MD5: tells rows with one id apart, in an order that does not depend on the run."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(text_col), F.lit(""))), 1, 15), 16, 10).cast("long")


def span_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, passages: bool = False) -> DataFrame:
    """span, doc_id, text_key, place: one row per span."""
    cut = pieces if passages else sentences

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            keys, places, lengths = [], [], []
            for text in batch.column(2).to_pylist():
                found = spans(cut(text), words, passages)
                keys += [k for _, _, k in found]
                places += [a for a, _, _ in found]
                lengths.append(len(found))
            rows = pa.array(np.repeat(np.arange(len(lengths)), lengths))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(places, pa.int32())], ["span", "doc_id", "text_key", "place"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_order(text_col).alias("text_key"), F.col(text_col).alias("body"))
    return in_batches(rows, run, "span long, doc_id long, text_key long, place int")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, passages: bool = False) -> DataFrame:
    """span, doc_id, text_key, place of every occurrence but the first."""
    table = span_table(docs, id_col, text_col, words, passages)
    firsts = written(
        table.groupBy(F.col("span").alias("f_span"))
        .agg(F.min(F.struct("doc_id", "text_key", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("f_span", "first"),
        "first-spans",  # written, so that the join stands alone in its stage and a hot span can be split
    )
    here = F.struct("doc_id", "text_key", "place")
    return table.join(firsts, F.col("span") == F.col("f_span")).where(~here.eqNullSafe(F.col("first"))).select("span", "doc_id", "text_key", "place")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, passages: bool = False) -> DataFrame:
    """row (all other columns of `docs`), doc_id, n_sentences, n_removed, text (what is left) for every row."""
    cut = pieces if passages else sentences
    gone = (
        repeats(docs, id_col, text_col, words, passages)
        .groupBy(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_text"))
        .agg(F.collect_set(F.struct("place", "span")).alias("gone"))  # at most one text's own spans, however often the row is repeated
    )
    others = [F.col(c) for c in docs.columns if c != text_col] or [F.lit(None).cast("string").alias("none")]
    rows = docs.select(F.struct(*others).alias("row"), F.col(id_col).cast("long").alias("doc_id"), text_order(text_col).alias("text_key"), F.col(text_col).alias("body"))
    met = rows.join(gone, (F.col("text_key") == F.col("gone_text")) & F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").select("row", "doc_id", "body", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            n_all, n_gone, left = [], [], []
            for text, removed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                parts = cut(text)
                n_all.append(len(parts))
                if not removed:
                    n_gone.append(0)
                    left.append(text)
                    continue
                listed, covered = {(r["place"], r["span"]) for r in removed}, set()
                for start, end, key in spans(parts, words, passages):
                    if (start, key) in listed:
                        covered.update(range(start, end))
                n_gone.append(len(covered))
                left.append("".join(p for i, p in enumerate(parts) if i not in covered))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n_all, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(left, pa.string())],
                ["row", "doc_id", "n_sentences", "n_removed", "text"],
            )

    schema = met.select("row").schema.add("doc_id", "long").add("n_sentences", "long").add("n_removed", "long").add("text", "string")
    return in_batches(met, run, schema)


def rewritten(docs: DataFrame) -> DataFrame:
    """Every document with what is left of its text, and its other columns; ``n_chars``, where there is one, is counted anew."""
    left = without_repeats(docs)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*[new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])


def deduped(docs: DataFrame, passages: bool = False) -> DataFrame:
    return without_repeats(docs.select("doc_id", "text"), passages=passages).select("doc_id", "n_sentences", "n_removed", "text")
