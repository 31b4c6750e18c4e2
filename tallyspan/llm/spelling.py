"""Spelling variants: each word's far more frequent near word, by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point makes one of
the other. A word of L code points contributes two disjoint chunks, its halves;
an edit preserves one of them, where it stands or shifted by one. Halves alone
would let frequent beginnings and endings meet ever more words, so the rule is
applied once more to the half with the edit: of its two chunks one is preserved,
too. A word thus contributes four entries, the chunks before and behind each of
its four quarters. The other word, as long or longer by one, contributes its
positional grams of the same lengths: those at the same places or, behind the
edit, shifted by one; grams at other places can meet no chunk and are not made.
Entries join as 64-bit hashes with the length; the edit distance then verifies
each pair, in the join, and it counts at the first quarter that it agrees in.

A word's form is its near word with the largest count, the first one in
code-point order among equals, if that count is at least `ratio` times its own.
Its root is where following forms ends. Counts grow at least `ratio` times with
each step, so the number of steps is bounded by a logarithm of the largest.

Everything is DataFrame functions; counts and pairs are combined before each
shuffle. Defined cases: a null text has no words; a null id counts as an empty
one; a text of any length is cut into its runs as rows; repeated rows are
occurrences of their own; an empty table gives no row. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import written
from tallyspan.llm.merkle import lower_ascii

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: What separates runs of letters.
SEPARATORS = r"[^A-Za-zÀ-ÿ]+"
TYPO_EVERY = 31


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """doc_id, word: every run of at least `least` letters, A-Z in lower case."""
    found = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.split(F.col(text_col), SEPARATORS)).alias("run"))
    return found.where(F.length("run") >= least).select("doc_id", lower_ascii(F.col("run")).alias("word"))


def with_typos(words: DataFrame, every: int = TYPO_EVERY) -> DataFrame:
    """doc_id, word: where `every` divides the CRC-32 h of `<doc_id>:<word>`, code point h % length is left out."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    cut = F.concat(F.expr("substring(word, 1, CAST(h % length(word) AS int))"), F.expr("substring(word, CAST(h % length(word) AS int) + 2)"))
    return words.withColumn("h", h).select("doc_id", F.when(F.col("h") % every == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n for every distinct word that is long and frequent enough."""
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def _bounds(length: str) -> list[str]:
    """Where the quarters of a word of this length begin and end."""
    half = f"({length} div 2)"
    return ["0", f"({half} div 2)", half, f"({half} + ({length} - {half}) div 2)", length]


def _around(word: str, length: str, quarter: int, shift: int | str) -> tuple[str, str]:
    """The chunks before and behind a quarter, the second one shifted."""
    bounds = [f"CAST({b} AS int)" for b in _bounds(length)]
    return f"substring({word}, 1, {bounds[quarter]})", f"substring({word}, {bounds[quarter + 1]} + 1 + {shift})"


def _entries(words: DataFrame, length: str, shift: int) -> DataFrame:
    keys = [f"named_struct('quarter', {q}, 'entry', xxhash64({length}, {q}, {', '.join(_around('word', length, q, shift))}))" for q in range(4)]
    return words.select("word", "n", F.expr(f"inline(array({', '.join(keys)}))"))


def chunks(words: DataFrame) -> DataFrame:
    """word, n, quarter, entry: the four entries of each word."""
    return _entries(words, "length(word)", 0)


def grams(words: DataFrame) -> DataFrame:
    """word, n, quarter, entry: what an equally long or a shorter word's chunks may meet."""
    return chunks(words).union(_entries(words, "(length(word) - 1)", 1))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n: every two words that differ by one edit, once; b is longer or, if as long, greater."""
    left = chunks(words).select(F.col("word").alias("a"), F.col("n").alias("a_n"), "quarter", "entry")
    right = grams(words).select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("quarter").alias("b_quarter"), F.col("entry").alias("b_entry"))
    alike, first = [], []
    for q in range(4):
        mine, other = _around("a", "length(a)", q, 0), _around("b", "length(a)", q, "(length(b) - length(a))")
        alike.append(f"({mine[0]} = {other[0]} AND {mine[1]} = {other[1]})")
        first.append(" AND ".join([f"quarter = {q}", alike[q], *[f"NOT {x}" for x in alike[:q]]]))
    near = F.expr("(length(b) > length(a) OR a < b) AND levenshtein(a, b, 1) = 1")
    return left.join(right, (F.col("entry") == F.col("b_entry")) & near & F.expr(" OR ".join(f"({f})" for f in first))).select("a", "a_n", "b", "b_n")


def forms(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n for every word."""
    both = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y"), F.col("b_n").alias("y_n")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"), F.col("a_n").alias("y_n")))
    best = near_pairs(words).select(F.inline(both)).groupBy("x").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("y_n")).alias("less"), "y")).alias("best"))
    met = words.join(best, F.col("word") == F.col("x"), "left")
    taken = -F.col("best.less") >= ratio * F.col("n")
    return met.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best.y")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n")
    )


def with_roots(found: DataFrame, ratio: int = RATIO) -> DataFrame:
    """The rows of :func:`forms` with ``root``; each round doubles the steps that a word has gone."""
    linked = found.where("form is not null")
    largest = linked.agg(F.max("form_n")).first()[0] or 1
    jumps = linked.select(F.col("word").alias("at"), F.col("form").alias("to"))
    for _ in range(math.ceil(math.log2(max(1.0, math.log(largest, ratio) + 1)))):
        on = jumps.select(F.col("at").alias("on_at"), F.col("to").alias("on_to"))
        jumps = written(jumps.join(on, F.col("to") == F.col("on_at"), "left").select("at", F.coalesce("on_to", "to").alias("to")), "roots")
    return found.join(jumps, F.col("word") == F.col("at"), "left").select(*found.columns, F.coalesce("to", "word").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of all documents, typos made as said above."""
    words = written(vocabulary(with_typos(runs(docs))), "vocabulary")
    return with_roots(written(forms(words), "forms")).select("word", "form", "root", "n", "n_near", "form_n")
