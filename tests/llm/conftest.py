import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Columns whose names the operators use within.
CLASHING = ["row", "body", "score", "span", "place", "node", "band", "bucket", "size", "salt", "sha", "range", "n", "u", "v", "failed", "ids", "uri", "payload", "c_key", "edits", "doc"]
EXTRA = [f"'x' AS `{c}`" for c in CLASHING]


@pytest.fixture(autouse=True)
def package_on_workers(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with clashing extra columns."""

    def make(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        return frame.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS bigint) AS n_chars", *EXTRA)

    return make


@pytest.fixture
def pages_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", *EXTRA)

    return make
