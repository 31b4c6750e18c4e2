"""Edit-aware token counts: a segment tree of pre-tokens per document; edits re-encode only what they touch.

A leaf is a pre-token with its characters and tokens; inner nodes hold sums.
An edit finds its leaves by descending the character sums, re-splits the text
from a leaf that the edit cannot reach until a new boundary meets an old one
behind the edit, encodes these pre-tokens alone and updates the sums on the way
to the root. New pre-tokens share the slot of the first leaf they replace, so
the tree keeps its shape.

The split pattern looks ahead but never back, and at most LOOKAHEAD characters
past a pre-token's end. Hence splitting may restart at any old boundary, and
a pre-token that ends LOOKAHEAD characters before the edit stays as it is.

``build`` stores a tree per document as compact columns; ``apply_edits`` turns
trees and edits into new trees. Texts and trees stay in one row, so neither
shuffles unless edits come as a table of their own.

Defined cases: a null text is an empty one; a null edit list is none, as is a
null entry; places and lengths outside the text are clipped; edits apply in
their order, each to the text that the one before left; repeated rows are
counted alike; empty tables give no row. Extra columns are ignored. The
vocabulary file is a parameter.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import in_batches, slices

LOOKAHEAD = 3
REMEMBERED = 500_000
LONG = 64
TREE = "doc_id long, body string, chars binary, tokens binary"
EDITS = "array<struct<at: long, n_removed: long, added: string>>"


class Counter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, pattern: str, encoding: tiktoken.Encoding):
        self.split = regex.compile(pattern)
        self.encoding = encoding
        self.known: dict[str, int] = {}

    def count(self, pretoken: str) -> int:
        n = self.known.get(pretoken)
        if n is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            n = len(self.encoding.encode_ordinary(pretoken))
            if len(pretoken) <= LONG:
                self.known[pretoken] = n
        return n


@functools.cache
def counter(ranks_file: str, pattern: str) -> Counter:
    with open(ranks_file, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return Counter(pattern, tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))


class Tree:
    """Sums of characters and tokens over the slots of pre-tokens; ``slots`` has the lengths within a slot."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray):
        self.text = text
        self.size = max(1, len(chars))
        self.chars = self._sums(chars)
        self.tokens = self._sums(tokens)
        self.slots: dict[int, tuple[list[int], list[int]]] = {}  # only slots that hold other than one pre-token
        self.encoded = 0  # characters re-encoded so far

    def _sums(self, leaves: np.ndarray) -> list[int]:
        """Node i has the children 2 i and 2 i + 1; leaves stand from `size` rounded up to a power of two."""
        self.base = 1 << (self.size - 1).bit_length()
        level = np.zeros(self.base, np.int64)
        level[: len(leaves)] = leaves
        levels = [level]
        while len(level) > 1:
            level = level[::2] + level[1::2]
            levels.append(level)
        return [0, *np.concatenate(levels[::-1]).tolist()]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def slot(self, place: int) -> tuple[int, int]:
        """The slot that holds the character at `place`, or the last one, and where it starts."""
        node, start = 1, 0
        while node < self.base:
            node *= 2
            if place - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        last = self.base + self.size - 1
        if node > last:
            node, start = last, self.chars[1] - self.chars[last]
        return node - self.base, start

    def within(self, slot: int) -> tuple[list[int], list[int]]:
        if slot in self.slots:
            return self.slots[slot]
        n = self.chars[self.base + slot]
        return ([n], [self.tokens[self.base + slot]]) if n else ([], [])

    def put(self, slot: int, chars: list[int], tokens: list[int]) -> None:
        self.slots[slot] = chars, tokens
        node = self.base + slot
        more, most = sum(chars) - self.chars[node], sum(tokens) - self.tokens[node]
        while node:
            self.chars[node] += more
            self.tokens[node] += most
            node //= 2

    def edit(self, at: int, n_removed: int, added: str, words: Counter) -> None:
        n = len(self.text)
        at = min(max(at, 0), n)
        stop = min(at + max(n_removed, 0), n)
        if stop == at and not added:
            return
        first, start = self.slot(max(at - LOOKAHEAD, 0))
        self.text = text = self.text[:at] + added + self.text[stop:]
        grown, edge = len(added) - (stop - at), at + len(added)
        # old pre-tokens from the first slot on, with their ends in the new text
        last = first
        old_chars, old_tokens = self.within(first)
        ends = self._ends(start, old_chars, grown)
        chars, tokens, place = [], [], start
        rest: tuple[list[int], list[int]] = ([], [])
        while place < len(text):
            piece = words.split.match(text, place).group()
            place += len(piece)
            chars.append(len(piece))
            tokens.append(words.count(piece))
            self.encoded += len(piece)
            if place < edge:
                continue
            while ends[-1] < place and last + 1 < self.size:
                last += 1
                more_chars, more_tokens = self.within(last)
                ends += self._ends(ends[-1] - grown, more_chars, grown)[1:]
                old_chars, old_tokens = old_chars + more_chars, old_tokens + more_tokens
            k = np.searchsorted(ends, place)
            if k < len(ends) and ends[k] == place:
                rest = old_chars[k:], old_tokens[k:]
                break
        else:
            last = self.size - 1
        self.put(first, chars + rest[0], tokens + rest[1])
        for slot in range(first + 1, last + 1):
            if self.chars[self.base + slot]:
                self.put(slot, [], [])

    @staticmethod
    def _ends(start: int, lengths: list[int], grown: int) -> list[int]:
        out = [start + grown]
        for n in lengths:
            out.append(out[-1] + n)
        return out

    def leaves(self) -> tuple[np.ndarray, np.ndarray]:
        chars, tokens = [], []
        for i in range(self.size):
            c, t = self.within(i)
            chars += c
            tokens += t
        return np.array(chars, np.int64), np.array(tokens, np.int64)


def pretokens(text: str, words: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of each pre-token."""
    found = words.split.findall(text)
    counts = list(map(words.known.get, found))
    if None in counts:
        counts = [words.count(p) if n is None else n for p, n in zip(found, counts, strict=True)]
    return np.fromiter(map(len, found), np.int64, len(found)), np.array(counts, np.int64)


def grow(text: str, words: Counter) -> Tree:
    return Tree(text, *pretokens(text, words))


def pack(values: np.ndarray) -> bytes:
    """One byte for the width, then the values in the narrowest unsigned width that holds them."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def build(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A tree for each document: its text and, packed, the characters and tokens of its pre-tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(ranks_file, pattern)
        for batch in slices(batches, 256):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            trees = [tuple(map(pack, pretokens(t, words))) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), *(pa.array(c, pa.binary()) for c in zip(*trees, strict=True))], ["doc_id", "body", "chars", "tokens"]
            )

    return in_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body")), run, TREE)


def apply_edits(trees: DataFrame, ranks_file: str, pattern: str, edits: str = "edits", keep_trees: bool = True) -> DataFrame:
    """Trees after the edits of the column `edits` (type EDITS), with n_before, n_after, n_edits and n_encoded (characters).

    keep_trees: False leaves the new trees out and returns the counts alone.
    """
    schema = "doc_id long, n_before long, n_after long, n_edits long, n_encoded long, n_chars long"
    names = ["doc_id", "n_before", "n_after", "n_edits", "n_encoded", "n_chars"]
    if keep_trees:
        schema, names = schema + TREE.removeprefix("doc_id long"), [*names, "body", "chars", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(ranks_file, pattern)
        for batch in slices(batches, 256):
            out = []
            for doc_id, body, chars, tokens, changes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tree = Tree(body, unpack(chars), unpack(tokens))
                before, changes = tree.n_tokens, [e for e in changes or [] if e]
                for e in changes:
                    tree.edit(e["at"] or 0, e["n_removed"] or 0, e["added"] or "", words)
                row = (doc_id, before, tree.n_tokens, len(changes), tree.encoded, len(tree.text))
                out.append((*row, tree.text, *map(pack, tree.leaves())) if keep_trees else row)
            types = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=False)], names)

    return in_batches(trees.select("doc_id", "body", "chars", "tokens", F.col(edits).cast(EDITS)), run, schema)


def revision(text: str = "body", at: str = "doc_id") -> F.Column:
    """An edit list that follows from the row alone: a removal, a copied stretch and a replacement, at hashed places."""
    n = F.greatest(F.length(text), F.lit(1))

    def place(k: int) -> F.Column:
        return F.pmod(F.xxhash64(F.col(at), F.length(text), F.lit(k)), n)

    def edit(where: F.Column, removed: F.Column, added: F.Column) -> F.Column:
        return F.struct(where.cast("long").alias("at"), removed.cast("long").alias("n_removed"), added.alias("added"))

    copied = F.substr(F.col(text), (place(2) + 1).cast("int"), F.lit(40))
    return F.array(
        edit(place(1), place(4) % 30, F.lit("")),
        edit(place(3), F.lit(0), copied),
        edit(place(5), F.lit(5), F.lit(" [removed] ")),
    )


def counts_after_revision(docs: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """doc_id, n_edits, n_before, n_after, n_encoded, n_chars: each document's tokens before and after ``revision``."""
    trees = build(docs, ranks_file, pattern).withColumn("edits", revision())
    return apply_edits(trees, ranks_file, pattern, keep_trees=False).select("doc_id", "n_edits", "n_before", "n_after", "n_encoded", "n_chars")
