"""Toxicity by a factorization machine over hashed terms.

    score = sigmoid(w0 + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2))

over the distinct terms i of a document, so that pairs such as an insult beside
a group's name weigh more than the sum of the two. A term is a lower-case run of
characters other than ASCII punctuation and white space, or the first bytes of
a longer one, which stand for words made from it; its hash has 32 bits.

The model is fitted on the driver, on a bounded sample: the terms (not the
texts) of `sample` labelled rows, the first by a hash of their id, equal term
sets once. It keeps at most `features` terms. Everything else covers all rows:
scoring is one pass without a shuffle.

Defined cases: null and empty texts have no terms and get the score of w0; null
ids and null labels are not learned from; of contradicting labels the higher
counts; without labels of both kinds every score is the share of toxic rows
(0 without rows). Extra columns are ignored; labels, lang, source and ids are
never inputs of a score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import in_batches, not_learned_from, sampled, slices, utf8

STEM = 5
#: ASCII other than letters and digits separates terms.
_SEPARATE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def hashed(text: str | None) -> set[int]:
    """The hashes of the distinct terms: words, and the stems (first STEM bytes) of longer words."""
    words = set(utf8((text or "").lower()).translate(_SEPARATE).split())
    words.update([w[:STEM] for w in words if len(w) > STEM])
    return set(map(zlib.crc32, words))


@dataclass
class Machine:
    """bias, one weight and one vector for each known term; ``at`` is the sorted hashes of these terms."""

    bias: float
    at: np.ndarray
    weight: np.ndarray
    vector: np.ndarray

    def scores(self, docs: list) -> np.ndarray:
        rows, cols = self.known(docs)
        z = np.full(len(docs), self.bias)
        z += np.bincount(rows, self.weight[cols], len(docs))
        for f in range(self.vector.shape[1]):
            v = self.vector[cols, f]
            z += (np.bincount(rows, v, len(docs)) ** 2 - np.bincount(rows, v * v, len(docs))) / 2
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def known(self, docs: list) -> tuple[np.ndarray, np.ndarray]:
        """Document number and term number of every known term. docs: the hashed terms of each."""
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        flat = np.concatenate([np.asarray(d, np.uint32) for d in docs]) if len(docs) else np.zeros(0, np.uint32)
        rows = np.repeat(np.arange(len(docs), dtype=np.int32), lengths)
        if not len(self.at):
            return rows[:0], rows[:0]
        cols = np.minimum(np.searchsorted(self.at, flat), len(self.at) - 1).astype(np.int32)
        hit = self.at[cols] == flat
        return rows[hit], cols[hit]


def fit(
    docs: list[np.ndarray], labels: np.ndarray, *, factors: int = 4, features: int = 1 << 15, least_docs: int = 4, least_tie: float = 3.0,
    paired: int = 2048, least_pair: float = 6.0, epochs: int = 10, batch: int = 128,
    rate: float = 0.25, pair_rate: float = 0.05, sparse: float = 2e-4, shrink: float = 1e-3, seed: int = 7,
) -> Machine:
    """Mini-batch AdaGrad on the logistic loss; weights are pulled to exactly 0 (`sparse`), vectors shrunk.

    Equal term sets count once, with their mean label; the rarer toxic ones weigh
    the root of the ratio. Terms in fewer than `least_docs` sets are left out. A
    term is taken if its own tie to the label is `least_tie` standard deviations
    or more, or if it is one of a pair whose joint tie is `least_pair` or more
    beyond what the two say alone (:func:`in_pairs`), so that a term that tells
    nothing alone is there for the pairs in which it tells.
    """
    sets: dict[bytes, list[float]] = {}
    for d, label in zip(docs, labels, strict=True):
        sets.setdefault(np.sort(d).tobytes(), []).append(float(label))
    docs = [np.frombuffer(d, np.uint32) for d in sets]
    y = np.array([sum(v) / len(v) for v in sets.values()])
    prior = y.sum() / (len(y) + 1)
    if not len(y) or y.max() < 0.5 or y.min() > 0.5:
        return Machine(float(np.log(max(prior, 1e-9) / (1 - prior))), np.zeros(0, np.uint32), np.zeros(0), np.zeros((0, factors)))
    lengths = np.fromiter(map(len, docs), np.int64, len(docs))
    flat = np.concatenate(docs)
    seen, n = np.unique(flat, return_counts=True)
    toxic = np.bincount(np.searchsorted(seen, flat), np.repeat(y, lengths), len(seen))
    del flat
    tied = np.abs(toxic - n * prior) / np.sqrt(n * prior * (1 - prior))
    frequent = np.argsort(-n, kind="stable")[:paired]
    frequent = np.sort(frequent[n[frequent] >= least_docs])
    paired_up = np.zeros(len(seen), bool)
    paired_up[frequent[in_pairs(docs, y, seen[frequent], prior, least_pair)]] = True
    often = np.flatnonzero((n >= least_docs) & ((tied >= least_tie) | paired_up))
    often = np.sort(often[np.argsort(np.where(paired_up[often], -np.inf, -tied[often]), kind="stable")[:features]])
    rng = np.random.default_rng(seed)
    weigh = np.sqrt((1 - prior) / prior)
    m = Machine(float(np.log(weigh * prior / (1 - prior))), seen[often], np.zeros(len(often)), rng.normal(0, 0.01, (len(often), factors)))
    rows, cols = m.known(docs)
    start = np.searchsorted(rows, np.arange(len(docs) + 1))
    g_w, g_v, g_b = np.full(len(often), 1e-6), np.full((len(often), factors), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            at = np.concatenate([cols[start[i] : start[i + 1]] for i in pick])
            doc = np.repeat(np.arange(len(pick)), start[pick + 1] - start[pick])
            v = m.vector[at]
            total = _sums(doc, v, len(pick))
            squares = np.bincount(doc, (v * v).sum(1), len(pick))
            z = m.bias + np.bincount(doc, m.weight[at], len(pick)) + ((total**2).sum(1) - squares) / 2
            slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) * np.where(y[pick] >= 0.5, weigh, 1) / len(pick)
            used, local = np.unique(at, return_inverse=True)
            d_w = np.bincount(local, slope[doc], len(used))
            d_v = _sums(local, slope[doc, None] * (total[doc] - v), len(used)) + shrink * m.vector[used]
            g_w[used] += d_w**2
            g_v[used] += d_v**2
            step = rate / np.sqrt(g_w[used])
            w = m.weight[used] - step * d_w
            m.weight[used] = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0)
            m.vector[used] -= pair_rate / np.sqrt(g_v[used]) * d_v
            g_b += slope.sum() ** 2
            m.bias -= rate / np.sqrt(g_b) * slope.sum()
    return m


def in_pairs(docs: list[np.ndarray], y: np.ndarray, terms: np.ndarray, prior: float, least: float, block: int = 1024) -> np.ndarray:
    """Which of these terms belong to a pair that is toxic more or less often than the two terms say alone.

    Alone they say: the log odds of either, added. What a pair departs from that
    counts in standard deviations. Two matrices of terms by terms are all that
    is held, however many sets there are.
    """
    known = Machine(0.0, terms, np.zeros(len(terms)), np.zeros((len(terms), 0)))
    both, toxic = np.zeros((2, len(terms), len(terms)), np.float32)
    for lo in range(0, len(docs), block):
        rows, cols = known.known(docs[lo : lo + block])
        has = np.zeros((len(docs[lo : lo + block]), len(terms)), np.float32)
        has[rows, cols] = 1
        both += has.T @ has
        toxic += has.T @ (has * y[lo : lo + block, None].astype(np.float32))
    rate = (np.diag(toxic) + prior) / (np.diag(both) + 1)
    odds = np.log(rate / (1 - rate)) - np.log(prior / (1 - prior)) / 2
    want = 1 / (1 + np.exp(-np.clip(odds[:, None] + odds[None, :], -30, 30)))
    apart = np.abs(toxic - both * want) / np.sqrt(both * want * (1 - want) + 1)
    np.fill_diagonal(apart, 0)
    return apart.max(axis=1, initial=0) >= least


def _sums(group: np.ndarray, rows: np.ndarray, groups: int) -> np.ndarray:
    return np.stack([np.bincount(group, rows[:, f], groups) for f in range(rows.shape[1])], axis=1)


def learned(docs: DataFrame, labels: DataFrame, sample: int = 12_000) -> Machine:
    """The machine fitted on `sample` labelled rows; the held-out fifth is never among them."""
    usable = labels.where(~not_learned_from() & F.col("toxic").isNotNull())
    picked = sampled(usable.groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").alias("label")), sample, "l_id")
    rows = docs.select("doc_id", F.col("text").alias("body")).join(F.broadcast(picked), F.col("doc_id") == F.col("l_id"))  # `sample` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [np.fromiter(hashed(t.as_py()), np.uint32).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["doc_id", "label", "terms"])

    got = in_batches(rows.select("doc_id", F.col("label").cast("int"), "body"), run, "doc_id long, label int, terms binary").toArrow()
    order = np.lexsort([got["label"].to_numpy(), got["doc_id"].to_numpy()])  # as tasks may finish in any order
    found = [np.frombuffer(t.as_buffer() or b"", np.uint32) for t in got["terms"]]
    return fit([found[i] for i in order], got["label"].to_numpy()[order].astype(float))


def scored(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """row (all columns of `docs`) and score, for every row's whole text."""
    table = dict(zip(machine.at.tolist(), range(len(machine.at)), strict=True))
    known = Machine(machine.bias, np.arange(len(machine.at), dtype=np.uint32), machine.weight, machine.vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [[table[h] for h in hashed(t.as_py()) & table.keys()] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(known.scores(found))], ["row", "score"])

    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("body"))
    return in_batches(rows, run, rows.select("row").schema.add("score", "double"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    rows = scored(docs.select("doc_id", "text"), learned(docs, labels)).select(F.col("row.doc_id").alias("doc_id"), "score")
    return rows.select(
        "doc_id", not_learned_from().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the machine does not reject, with their columns."""
    return scored(docs, learned(docs, labels)).where("score < 0.5").select("row.*")
