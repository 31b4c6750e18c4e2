"""Quality rules as a ledger: every rule runs once, its measurement and its failure bit are stored, policies come later.

A policy is a version, a mask of the rules it applies: a document passes when
no bit of the mask is set. Policies and ablations read the ledger only. An
ablation (what a policy would keep without one of its rules) is counted over
the distinct bit patterns, of which there are at most 2 ** len(RULES), so it
shuffles that many rows per task.

Words are runs of characters other than blank and the control characters 9 to 13.

Defined cases: a null text has no words, as an empty one; a null id is kept as
it is; repeated rows are judged alike; an empty table gives an empty ledger.
Extra columns are ignored.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import BLANKS, in_batches, slices, utf8

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_echo_words"]


@dataclass(frozen=True)
class Rule:
    """A document fails when the expression over the measurements is true."""

    name: str
    fails: str


#: Bit i of a ledger is rule i; rules are only ever added at the end.
RULES = [
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("echoed_words", "10 * n_echo_words > 3 * n_words"),
]
BASE = ("few_words", "repeated_words")
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "symbols"),
    "v2": tuple(r.name for r in RULES),
}


def mask(rules: tuple[str, ...]) -> int:
    bits = {r.name: 1 << i for i, r in enumerate(RULES)}
    return sum(bits[name] for name in set(rules))


def repeated_words(words: list[bytes]) -> int:
    """Words within windows of WINDOW words that occur twice or more, the first included.

    Windows get their number by doubling: equal numbers of the two halves, equal
    window. So the count is exact.
    """
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    width = 1
    while width < WINDOW:
        pair = ids[:-width] * (ids.max() + 1) + ids[width:]
        width *= 2
        distinct, ids = np.unique(pair, return_inverse=True)
        if len(distinct) == len(pair):
            return 0
    twice = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    if not text:
        return (0,) * len(MEASURES)
    words = utf8(text).split()
    seen: set[str] = set()
    lines = n_dup = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            if line in seen:
                n_dup += 1
            else:
                seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        n_dup,
        repeated_words(words),
        lines,
        sum(map(operator.eq, words, words[1:])),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the measurements and ``failed``, the bits of the rules that the document fails."""
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    names = ["doc_id", *MEASURES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([measure(t.as_py()) for t in batch.column(1)], dtype=np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found.T.copy())], names)

    measured = in_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("body")), run, schema)
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)) for i, r in enumerate(RULES)]
    return measured.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long"))


def verdict(policy: str) -> F.Column:
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(rows: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """policy, rule, n_docs, n_kept, n_failed_rule, n_kept_without: what each rule of each policy decides alone."""
    patterns = rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = [(p, name, mask(names), mask((name,))) for p, names in policies.items() for name in names]
    grid = rows.sparkSession.createDataFrame(cases, "policy string, rule string, all_bits long, bit long")
    hit = F.col("failed").bitwiseAND(F.col("all_bits"))
    rest = F.col("all_bits") - F.col("bit")

    def total(when: F.Column) -> F.Column:
        return F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("long")

    return (
        patterns.join(F.broadcast(grid))  # patterns and policies: both bounded by the rules
        .groupBy("policy", "rule")
        .agg(
            F.sum("n").alias("n_docs"),
            total(hit == 0).alias("n_kept"),
            total(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("n_failed_rule"),
            total(F.col("failed").bitwiseAND(rest) == 0).alias("n_kept_without"),
        )
    )


def judged(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The ledger under one policy: doc_id, the measurements, failed, base_failed, kept."""
    rows = ledger(docs)
    return rows.select("doc_id", *MEASURES, "failed", (~verdict("base")).alias("base_failed"), (verdict("base") & verdict(policy)).alias("kept"))
