"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns, hot groups."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyspan.llm import components, decontaminate, main_text, ngram_join, pieces, rules, sentence_spans, sharding, token_counts, toxicity, warc
from tallyspan.llm.queries import PIECE_MODEL, RANKS
from tallyspan.session import new_shared_path


def words(seed, n):
    rng = random.Random(seed)
    return [rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(500)) for _ in range(n)]


def text(seed, n=60):
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words(seed, n)))


LONG = text(99, 40_000)
ROWS = [(1, None), (2, ""), (3, "one"), (4, text(4)), (4, text(4)), (5, text(4)), (None, text(6)), (None, None), (7, LONG), (8, " \n\t "), (9, "two\nlines 漢 😀")]
#: Every operator on documents: (its rows by id, the columns it returns).
OPERATORS = {
    "rules": lambda d: rules.judged(d),
    "pieces": lambda d: pieces.encoded_digests(d, PIECE_MODEL),
    "toxicity": lambda d: toxicity.toxicity(d, d.selectExpr("doc_id", "1 AS quality", "cast(doc_id % 2 AS int) AS toxic")),
    "shards": lambda d: sharding.shard_by_bytes(d),
    "counts": lambda d: token_counts.counts_after_revision(d, RANKS, public_tokenizers.PATTERN),
    "spans": lambda d: sentence_spans.deduped(d),
    "join": lambda d: ngram_join.similar(d),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_every_row_is_answered(docs_of, name):
    got = OPERATORS[name](docs_of(ROWS)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ROWS)


@pytest.mark.parametrize("name", list(OPERATORS))
def test_empty_table(docs_of, name):
    assert OPERATORS[name](docs_of([])).collect() == []


@pytest.mark.parametrize("name", list(OPERATORS))
def test_repeated_rows_are_answered_alike(docs_of, name):
    twice = [r.asDict() for r in OPERATORS[name](docs_of(ROWS)).collect() if r.doc_id == 4]
    for r in twice:
        r.pop("slot", None)
    assert len(twice) == 2 and twice[0] == twice[1]


# --- archives ---


def test_archives(pages_of):
    rows = [(5, "u", "same"), (3, None, "same"), (9, "u\r\nv", "same"), (1, "u", None), (2, "u", ""), (None, "u", "x"), (6, "u", "y" * 3_000_000), (3, None, "same")]
    got = {(r.page_id, r.payload_bytes): (r.record_type, r.refers_to) for r in warc.page_archives(pages_of(rows)).collect()}
    assert got == {
        (5, 4): ("revisit", 3),
        (3, 4): ("response", None),  # both rows of page 3
        (9, 4): ("revisit", 3),
        (1, 0): ("response", None),
        (2, 0): ("revisit", 1),
        (None, 1): ("response", None),
        (6, 3_000_000): ("response", None),
    }
    assert warc.page_archives(pages_of(rows)).count() == len(rows)
    assert warc.page_archives(pages_of([])).collect() == []


def test_archives_hold_payloads_and_split_files(spark, pages_of):
    rows = [(i, f"http://x/{i}", f"<p>{text(i)}</p>") for i in range(300)]
    out = new_shared_path(spark, "warc")
    manifest = warc.write_archives(pages_of(rows), out, id_col="page_id", uri_col="url", payload_col="html", file_bytes=4000)
    files = manifest.collect()
    assert sum(f.n_records for f in files) == 300 and len(files) > 20
    with open(files[0].path.removeprefix("file:"), "rb") as file:
        assert file.read(4) == warc.struct.pack("<I", warc.DICTIONARY_FRAME)
    back = warc.read_archives(manifest).collect()
    assert {(r.target_uri, r.payload.decode()) for r in back} == {(u, h) for _, u, h in rows}


def test_broken_archive(spark, pages_of):
    out = new_shared_path(spark, "warc")
    manifest = warc.write_archives(pages_of([(i, "u", text(i)) for i in range(40)]), out, id_col="page_id", uri_col="url", payload_col="html")
    path = manifest.orderBy(F.desc("n_records")).first().path
    with open(path.removeprefix("file:"), "r+b") as file:
        file.truncate(file.seek(0, 2) - 7)
    one = spark.createDataFrame([(path,)], "path string")
    read = warc.read_archives(one, strict=False).collect()
    assert read[-1].problem and all(r.problem is None for r in read[:-1]) and len(read) > 1
    with pytest.raises(Exception, match="ends within a frame"):
        warc.read_archives(one).collect()


# --- rules ---


def test_ablations(spark, docs_of):
    rows = [(i, t) for i, t in enumerate([text(1, 40), "short", "a " * 60, text(2, 40) + " ### ### ### ### ### ###", None])]
    ledger = rules.ledger(docs_of(rows))
    bits = {r.doc_id: r.failed for r in ledger.collect()}
    got = {(r.policy, r.rule): (r.n_docs, r.n_kept, r.n_failed_rule, r.n_kept_without) for r in rules.ablations(ledger).collect()}
    for policy, names in rules.POLICIES.items():
        for name in names:
            all_bits, bit = rules.mask(names), rules.mask((name,))
            want = (5, sum(b & all_bits == 0 for b in bits.values()), sum(b & bit != 0 for b in bits.values()), sum(b & (all_bits - bit) == 0 for b in bits.values()))
            assert got[policy, name] == want
    assert rules.ablations(rules.ledger(docs_of([]))).count() == 0


# --- shards ---


def test_more_shards_than_groups_and_a_hot_text(docs_of):
    rows = [(i, "hot" * 50) for i in range(400)] + [(1000 + i, text(i, 5)) for i in range(30)]
    got = sharding.shard_by_bytes(docs_of(rows), shards=8).collect()
    hot = {r.shard for r in got if r.doc_id < 400}
    assert len(hot) == 1 and len(got) == 430
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


# --- decontamination ---


def test_decontamination_edges(spark, docs_of):
    item = text(50, 30)
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (5, item), (None, text(51, 30))], "item_id long, text string")
    near = item.replace("alpha", "alphq", 2)
    rows = [(1, f"{LONG} {item.upper()}!"), (2, "x\n" + item.replace(" ", "\n  ")), (3, near), (4, text(52)), (5, None), (6, ""), (None, item), (2, item)]
    got = sorted((str(r.doc_id), str(r.item_id)) for r in decontaminate.contaminated(docs_of(rows), bench).collect())
    want = [(d, i) for d in ("1", "2", "2", "3", "None") for i in ("1", "5")]
    assert got == sorted(want)
    blocks = decontaminate.contaminated(docs_of(rows), bench, block_chars=200)
    assert sorted((str(r.doc_id), str(r.item_id)) for r in blocks.collect()) == got
    assert [r.doc_id for r in decontaminate.clean(docs_of(rows), bench).orderBy("doc_id").collect()] == [4, 5, 6]
    assert decontaminate.contaminated(docs_of([]), bench).count() == 0
    assert decontaminate.contaminated(docs_of(rows), bench.limit(0)).count() == 0
    assert {r.item_id for r in decontaminate.short_items(bench).collect()} == {2, 3, 4}


# --- token counts ---


def test_trees_take_edits_again_and_again(spark, docs_of):
    trees = token_counts.build(docs_of([(1, text(1)), (2, None)]), RANKS, public_tokenizers.PATTERN)
    edits = F.expr("array(named_struct('at', 3L, 'n_removed', 2L, 'added', ' new '), NULL, named_struct('at', -5L, 'n_removed', NULL, 'added', 'x'), named_struct('at', 9999L, 'n_removed', 5L, 'added', '!'))")
    once = token_counts.apply_edits(trees.withColumn("edits", edits), RANKS, public_tokenizers.PATTERN)
    again = token_counts.apply_edits(once.withColumn("edits", edits), RANKS, public_tokenizers.PATTERN).collect()
    fresh = token_counts.counter(RANKS, public_tokenizers.PATTERN)
    for r in again:
        assert r.n_after == len(fresh.encoding.encode_ordinary(r.body)) == token_counts.unpack(r.tokens).sum()
        assert r.n_edits == 3
    none = token_counts.apply_edits(trees.withColumn("edits", F.lit(None).cast(token_counts.EDITS)), RANKS, public_tokenizers.PATTERN).collect()
    assert all(r.n_before == r.n_after and r.n_encoded == 0 for r in none)


# --- spans ---


def test_a_passage_in_many_documents_stays_once(docs_of):
    passage = text(70, 60)
    rows = [(i, f"{text(100 + i, 20)}. {passage} {text(500 + i, 20)}.") for i in range(300)]
    got = {r.doc_id: r for r in sentence_spans.deduped(docs_of(rows)).collect()}
    middle = " ".join(passage.split()[9:54])
    assert got[0].n_removed == 0 and got[0].text == rows[0][1]
    for i in range(1, 300):
        assert got[i].n_removed > 0 and middle not in got[i].text
        assert got[i].text.startswith(text(100 + i, 20)) and text(500 + i, 20)[60:] in got[i].text


def test_spans_within_one_document_and_across_copies(docs_of):
    one = text(80, 40) + ". "
    got = {r.doc_id: r for r in sentence_spans.deduped(docs_of([(1, one + one), (2, one), (3, text(81, 40))])).collect()}
    assert got[1].text.strip().startswith(one.strip()) and got[1].n_removed > 0
    assert got[2].text.strip() == "" or got[2].n_removed > 0
    assert got[3].n_removed == 0


def plain(seed, n):
    """n words without marks."""
    rng = random.Random(f"plain {seed}")
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.mark.parametrize("marks", [(), (20,), (20, 40), (15, 30, 45)])
def test_passages_with_few_marks_go_wherever_they_are_pasted(docs_of, marks):
    passage = plain(1, 60).split()
    for at in marks:
        passage[at - 1] += "."
    passage = " ".join(passage)
    rows = [(i, f"{plain(10 + i, 7 + i)} {passage} {plain(50 + i, 30 - i)}") for i in range(20)]
    got = {r.doc_id: r for r in sentence_spans.deduped(docs_of(rows), passages=True).collect()}
    assert got[0].n_removed == 0 and got[0].text == rows[0][1]
    for i in range(1, 20):
        assert got[i].text.startswith(plain(10 + i, 7 + i)) and got[i].text.endswith(plain(50 + i, 30 - i))
        assert len(rows[i][1].split()) - len(got[i].text.split()) >= 60 - 34


def test_every_49_words_hold_a_span(docs_of):
    rng = random.Random(12)
    for _ in range(300):
        passage = [w + rng.choice(["", "", "", "", "", "."]) for w in plain(rng.random(), 49).split()]
        if rng.random() < 0.3:
            passage = [rng.choice(passage[:3]) for _ in passage]
        one, two = ({k for _, _, k in sentence_spans.spans(sentence_spans.pieces(f"{plain(rng.random(), rng.randrange(20))} {' '.join(passage)} {plain(rng.random(), 9)}"), passages=True)} for _ in range(2))
        assert one & two


def test_passages_keep_all_text_and_the_first_occurrence(docs_of):
    alone, copied = plain(2, 30), plain(3, 30)
    rows = [(1, " \n" + alone), (2, copied), (3, copied), (4, None), (5, ""), (6, alone[:40] + "  ")]
    got = {r.doc_id: r.text for r in sentence_spans.deduped(docs_of(rows), passages=True).collect()}
    assert got.pop(3) in copied and got == {k: t for k, t in rows if k != 3}
    for text in (alone, f" {alone}\t\n {copied} .", "..", f"{copied}   "):
        assert "".join(sentence_spans.pieces(text)) == text


def test_the_last_short_sentences_of_a_passage_go(docs_of):
    passage = f"{plain(4, 20)}. {plain(5, 3)}. {plain(6, 3)}."
    rows = [(1, passage), (2, f"{plain(7, 5)}. {passage} {plain(8, 5)}."), (3, passage)]
    got = {r.doc_id: r.text for r in sentence_spans.deduped(docs_of(rows), passages=True).collect()}
    assert got[1] == passage and got[3] == ""
    assert got[2].split() == f"{plain(7, 5)}. {plain(8, 5)}.".split()


# --- n-gram join ---


def near(seed, k, n=120):
    """A copy with one of its words changed, another one for each k."""
    base = words(seed, n)
    base[k % n] = f"changed{k}"
    return " ".join(base)


def jaccard(a, b):
    x, y = ({tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("block", [512, 16])
def test_hot_group_of_near_copies(docs_of, monkeypatch, block):
    """Every link of a large group is counted, also where it is cut into many cells."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = [(i, near(1, i)) for i in range(90)] + [(200 + i, near(1, 3)) for i in range(20)] + [(300 + i, text(300 + i)) for i in range(50)]
    got = {r.doc_id: r for r in ngram_join.similar(docs_of(rows)).collect()}
    texts = dict(rows)
    for i in (0, 3, 45, 89, 205, 310):
        linked = [j for j in texts if j != i and jaccard(texts[i], texts[j]) >= 0.8]
        assert got[i].n_links == len(linked)
        assert got[i].n_text_links == len({texts[j] for j in linked} - {texts[i]})
    assert {got[i].class_id for i in range(90)} == {0}
    assert all(got[300 + i].class_id == 300 + i for i in range(50))


def test_one_of_each_group_stays(docs_of):
    rows = [(9, near(2, 1)), (3, near(2, 2)), (3, near(2, 2)), (5, near(2, 2)), (7, text(7)), (None, text(8)), (None, text(8)), (11, text(8)), (12, None), (13, ""), (13, "")]
    kept = ngram_join.one_of_each(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["11", "12", "13", "3", "7"]


def test_lower_thresholds_are_refused(docs_of):
    with pytest.raises(ValueError, match="bands"):
        ngram_join.similar(docs_of([]), t=0.5)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7), (None, 3)] + [(1000, 1000 + i) for i in range(1, 200)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100} | {1000 + i: 1000 for i in range(1, 200)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pages ---


@pytest.fixture(scope="module")
def extractor(spark):
    return main_text.learned(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_page_edges(pages_of, extractor):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<article><p>a</p></article>"), (4, "u", "<div" * 50), (4, "u", "<div" * 50), (5, "u", "plain text alone, without any markup at all, but some words."), (6, "u", "<article>" + f"<p>{text(1)}</p>" * 3000 + "</article>")]
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in main_text.extracted(pages_of(rows), extractor).collect()]
    assert len(got) == len(rows) and all(n == len(t) for _, _, t, n in got)
    by_id = {i: t for i, _, t, _ in got}
    assert by_id[1] == by_id[2] == ""
    assert by_id[6] == " ".join([text(1)] * 3000)
    assert main_text.extracted(pages_of([]), extractor).count() == 0


def test_pages_that_teach_nothing():
    own = main_text.teach(["<div>no explicit article</div>", "", "<"])
    assert len(own.texts([None, "<p>x</p>"])) == 2


def test_given_pages(spark, extractor):
    """On pages with an explicit article, the text is the article's."""
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    same = 0
    for r, got in zip(rows, extractor.texts([r.html for r in rows]), strict=True):
        inner = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inner))
        same += got == " ".join(html.unescape(inner).split())
    assert same >= 0.97 * len(rows)


PARAGRAPHS = [f"{text(900 + i, 45)} And so on, as one would expect of a text; it goes on." for i in range(4)]
CONTAINERS = ["<article>{}</article>", "<main>{}</main>", '<div class="post-content">{}</div>', '<div id="content">{}</div>', '<section class="entry-content">{}</section>']
AROUND = {
    "menu": '<nav class="menu"><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li><li><a href="/c">Contact</a></li></ul></nav>',
    "header": '<header class="site-header"><h2>The Daily Site</h2><p>News and views</p></header>',
    "sidebar": '<aside class="sidebar"><h3>Related</h3><ul><li><a href="#">Another story</a></li><li><a href="#">One more</a></li></ul></aside>',
    "notice": '<div class="cookie-notice"><p>We use cookies to improve this site. Accept them?</p></div>',
    "advert": '<div class="advertisement">Buy two and get one, only today!</div>',
    "form": '<form action="/s"><label>Search this site</label><input name="q"><button>Go</button></form>',
    "comments": '<section id="comments"><h3>Comments</h3><div class="comment"><p>Jo says</p><p>Great read, I liked the second part most, thanks.</p></div><div class="comment"><p>I disagree with nearly all of it, sorry.</p></div></section>',
    "footer": '<footer><p>&copy; 2024 The Daily Site. All rights reserved.</p></footer>',
    "script": "<script>var a = '<p>not text</p>';</script><style>p{color:red}</style><!-- a note -->",
}


@pytest.mark.parametrize("container", CONTAINERS)
@pytest.mark.parametrize("part", list(AROUND))
def test_parts_around_the_article_go(extractor, container, part):
    body = "<h1>A title of some words</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    before = part in ("menu", "header", "notice", "form", "script")
    main = container.format(body)
    page = f"<html><head><title>T</title></head><body>{AROUND[part] + main if before else main + AROUND[part]}</body></html>"
    assert extractor.texts([page])[0] == " ".join(["A title of some words", *PARAGRAPHS])


# --- rows without an id of their own ---


def passage_rows(ids):
    """Six documents that share a passage, each with text of its own around it."""
    shared = text(1000, 60)
    return [(i, f"{text(2000 + k, 40)}. {shared}. {text(3000 + k, 40)}.") for k, i in enumerate(ids)]


@pytest.mark.parametrize("passages", [False, True])
@pytest.mark.parametrize("ids", [range(6), [None] * 6, [7] * 6, [None, None, 3, 3, 4, 5]])
def test_a_passage_stays_once_whatever_the_ids(docs_of, ids, passages):
    got = sentence_spans.deduped(docs_of(passage_rows(ids)), passages=passages).collect()
    assert sorted(r.n_removed > 0 for r in got) == [False] + [True] * 5
    repeated = sentence_spans.deduped(docs_of(passage_rows(ids) * 3), passages=passages).collect()
    assert sorted(r.n_removed > 0 for r in repeated) == [False] * 3 + [True] * 15


def test_spans_to_remove_are_bounded_by_the_text(docs_of):
    rows = [(None, text(5, 90)) for _ in range(40)] + [(1, text(5, 90) + " and more words. " + text(6, 50))]
    gone = sentence_spans.without_repeats(docs_of(rows)).collect()
    assert {r.n_removed for r in gone if r.doc_id is None} == {0} and len(gone) == 41


def test_near_copies_without_ids_meet_their_own_text_only(spark, docs_of):
    base = words(77, 200)
    near = [" ".join([*base[:k], f"other{k}", *base[k + 1 :]]) for k in range(0, 40)]
    rows = [(None, t) for t in near] + [(i, t) for i, t in enumerate(near[:5])] + [(9, near[0]), (9, near[1])]
    docs = docs_of(rows)
    feats = ngram_join.features(docs)
    assert feats.select("doc_id", "text_key").distinct().count() == len(rows)
    found = ngram_join.similar(docs).collect()
    assert {r.class_id for r in found} == {0} and {r.n_links for r in found} == {len(rows) - 1}


# --- pairs of terms ---


def test_terms_that_tell_only_in_pairs_are_learned(docs_of):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        body = words(i, 20)
        one, other = rng.random() < 0.5, rng.random() < 0.5
        body += ["firstterm"] * one + ["secondterm"] * other
        rng.shuffle(body)
        rows.append((i, " ".join(body)))
        labels.append((i, 1, int(one != other)))
    docs = docs_of(rows)
    got = {r.doc_id: r for r in toxicity.toxicity(docs, docs.sparkSession.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [(got[i].predicted, y) for i, _, y in labels if got[i].held_out]
    assert sum(p == y for p, y in held) > 0.9 * len(held)


def test_scores_are_the_formula():
    rng = random.Random(5)
    docs = [np.array(sorted(rng.sample(range(50), 8)), np.uint32) for _ in range(400)]
    labels = np.array([float((3 in d) and (7 in d) or (11 in d)) for d in docs])
    machine = toxicity.fit(docs, labels)
    at = {int(t): k for k, t in enumerate(machine.at)}
    for d, score in zip(docs[:50], machine.scores(docs[:50]), strict=True):
        own = [at[int(t)] for t in d if int(t) in at]
        z = machine.bias + sum(machine.weight[k] for k in own)
        z += sum(float(machine.vector[a] @ machine.vector[b]) for i, a in enumerate(own) for b in own[:i])
        assert score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))))
