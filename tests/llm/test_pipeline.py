"""The pipeline's stages, each held against a plain version on its own input."""

import duckdb
import pytest
import sentencepiece

import corpus_pipeline
from tallyspan.llm import decontaminate, queries, toxicity
from tallyspan.llm.common import table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        out.append((name, docs, corpus_pipeline.written(after, "test-" + name)))
        docs = out[-1][2]
    return {name: (before, after) for name, before, after in out}


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "sentence_spans", "decontamination", "sentencepiece"]
    for name, (_, after) in stages.items():
        assert after.columns == (COLUMNS if name != "sentencepiece" else ["doc_id", "n_tokens", "ids"])


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    bad = {r.doc_id for r in toxicity.toxicity(before, table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert texts(after) == {d: t for d, t in texts(before).items() if d not in bad}


def test_one_near_copy_stays(stages):
    before, after = stages["ngram_join"]
    con = duckdb.connect()
    con.register("docs", before.toPandas())
    want = con.execute(queries.GROUPS.format(docs="docs") + "SELECT DISTINCT doc_id FROM grouped WHERE doc_id = class_id").fetchall()
    assert sorted(texts(after)) == sorted(d for (d,) in want)
    assert before.count() > after.count()


def test_repeated_spans_go(stages):
    before, after = stages["sentence_spans"]
    con = duckdb.connect()
    con.register("docs", before.toPandas())
    want = dict(con.execute(queries.SPANS.format(docs="docs") + "SELECT doc_id, text FROM left_over").fetchall())
    assert texts(after) == want
    assert all(r.n_chars == len(r.text) for r in after.collect())
    assert texts(before) != want


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    items = [t for r in table(spark, SF, "benchmark").collect() if len(t := decontaminate.words_of(r.text)) >= decontaminate.LEAST]
    exact = {d for d, t in texts(before).items() if any(i in decontaminate.words_of(t) for i in items)}
    kept = texts(after)
    assert not exact & set(kept)
    for d in set(texts(before)) - set(kept) - exact:
        text = decontaminate.words_of(texts(before)[d])
        assert any(decontaminate.distance(decontaminate.masks(i), len(i), text)[0] <= decontaminate.budget(i) for i in items)


def test_what_is_left_is_encoded(stages):
    before, after = stages["sentencepiece"]
    judge = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    assert {r.doc_id: (r.n_tokens, list(r.ids)) for r in after.collect()} == {d: (len(ids := judge.encode(t or "")), ids) for d, t in texts(before).items()}


def test_run_and_rough_input(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "word " * 30), (3, "word " * 30), (None, "some words of a text that nobody has labelled"), (4, "two\nlines")]
    for frame in (docs_of(rows), docs_of([])):
        docs = frame
        for name, stage in corpus_pipeline.STAGES[1:]:  # the first one learns from labels of other documents
            docs = corpus_pipeline.written(stage(spark, docs, SF), "rough-" + name)
        assert docs.columns == ["doc_id", "n_tokens", "ids"]
        assert docs.count() == (5 if frame.take(1) else 0)
    toxic = corpus_pipeline.drop_toxic(spark, docs_of(rows), SF)
    assert toxic.columns == docs_of(rows).columns and toxic.count() == len(rows)
