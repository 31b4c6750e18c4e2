"""From raw documents to token ids in five stages, each written as a table before the next one reads it.

1. toxicity: documents that the factorization machine rejects go.
2. ngram_join: of each group of near copies the document with the smallest id stays.
3. sentence_spans: sentences of repeated spans go, but for their first occurrence; documents stay, even when nothing is left.
4. decontamination: documents that hold a benchmark item go.
5. sentencepiece: what is left becomes token ids.

Each stage handles null ids and texts, repeated rows, empty tables and extra
columns as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.llm import decontaminate, ngram_join, pieces, sentence_spans, toxicity
from tallyspan.llm.common import table, written
from tallyspan.llm.queries import PIECE_MODEL


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def drop_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentence_spans.rewritten(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids."""
    return pieces.encode_texts(docs, PIECE_MODEL).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("sentence_spans", drop_repeated_spans),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: The machine, the edit distance and the agenda cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
