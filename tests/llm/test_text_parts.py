"""The helpers without Spark, against slow and plain versions."""

import hashlib
import io
import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard

from tallyspan.llm import boosting, decontaminate, dom, main_text, ngram_join, pieces, rules, sentence_spans, sharding, token_counts, toxicity, warc
from tallyspan.llm.queries import PIECE_MODEL, RANKS

DATE = "2000-01-01T00:00:00Z"


# --- archives ---


def record(payload=b"abc", kind="response", refers_to=None):
    return warc.record_bytes(kind, "urn:record:1", "http://a/\r\nX: y", payload, len(payload), warc.digest(payload), refers_to, DATE)


def archive(records, dictionary=b""):
    learned = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(dict_data=learned) if learned else zstandard.ZstdCompressor()
    return (warc.dictionary_frame(dictionary) if dictionary else b"") + b"".join(map(packer.compress, records))


def test_digest_of_nothing():
    assert warc.digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


@pytest.mark.parametrize("chunk", [1, 7, 1 << 18])
@pytest.mark.parametrize("trained", [False, True])
def test_frames_round_trip(chunk, trained):
    records = [record(bytes(f"<p>page {i} of many, with some text in it</p>" * 20, "ascii")) for i in range(60)]
    dictionary = zstandard.train_dictionary(4096, records).as_bytes() if trained else b""
    data = archive(records, dictionary)
    assert list(warc.frames(io.BytesIO(data).read, chunk)) == records
    raw = archive(records, dictionary)
    if trained:  # a dictionary may also stand uncompressed in its frame
        raw = warc.struct.pack("<II", warc.DICTIONARY_FRAME, len(dictionary)) + dictionary + raw[len(warc.dictionary_frame(dictionary)) :]
        assert list(warc.frames(io.BytesIO(raw).read, chunk)) == records


def test_record_fields():
    rec = warc.parse_record(record())
    assert rec == ("urn:record:1", "response", None, "http://a/%0D%0AX: y", 3, warc.digest(b"abc"), b"abc")
    rec = warc.parse_record(record(b"abc", "revisit", "urn:record:0"))
    assert rec[1:3] + rec[4:] == ("revisit", "urn:record:0", 3, warc.digest(b"abc"), None)


@pytest.mark.parametrize(
    ("old", "new", "said"),
    [
        (b"WARC/1.1", b"WARC/9.9", "no record header"),
        (b"WARC-Date: ", b"X-Date: ", "WARC-Date is missing"),
        (b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: 1", "the frame holds"),
        (b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: x", "Content-Length is"),
        (b"\r\n\r\nabc", b"\r\n\r\nabd", "block digest differs"),
        (b"WARC-Type: ", b"WARC-Type ", "bad header line"),
    ],
)
def test_broken_records_are_told(old, new, said):
    data = record()
    assert data.count(old) == 1
    with pytest.raises(warc.BadArchive, match=re.escape(said)):
        warc.parse_record(data.replace(old, new))


def test_cut_and_foreign_files_are_told():
    data = archive([record()] * 3)
    for bad in (data[:-5], b"not an archive at all", warc.dictionary_frame(b"x" * 500)[:20]):
        with pytest.raises(warc.BadArchive):
            list(warc.frames(io.BytesIO(bad).read))
    assert list(warc.frames(io.BytesIO(b"").read)) == []


# --- rules ---


def slow_repeats(words):
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    return len({i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)})


def test_repeated_words():
    rng = random.Random(1)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"][: rng.randrange(1, 4)]) for _ in range(rng.randrange(0, 40))]
        assert rules.repeated_words(words) == slow_repeats(words)


def test_measures():
    assert rules.measure(None) == rules.measure("") == (0,) * len(rules.MEASURES)
    got = dict(zip(rules.MEASURES, rules.measure("a b\n\n a b\na b\n#*\xa0|\x0b\x1fc c"), strict=True))
    assert got == {"n_words": 9, "word_chars": 13, "n_symbols": 3, "n_dup_lines": 1, "n_repeat_words": 0, "n_lines": 4, "n_echo_words": 0}


# --- pieces ---


def test_agenda_against_library():
    own, judge = pieces.vocabulary(PIECE_MODEL), sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rng = random.Random(4)
    letters = [*"aé▁ \n\t.x9,%\u0000�漢", "😀", "  ", "the", "\r\n", "​", "\xa0", "ing "]
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 30)))
        ids = own.encode(text)
        assert ids == judge.encode(text), text
        assert own.decode(ids) == judge.decode(ids)
    for _ in range(2000):
        ids = [rng.randrange(0, 500) for _ in range(rng.randrange(0, 12))]
        assert own.decode(ids) == judge.decode(ids)
    long = "".join(rng.choice("aethinor") for _ in range(20_000))
    assert own.encode(long) == judge.encode(long)


def test_both_agendas_agree():
    own = pieces.vocabulary(PIECE_MODEL)
    rng = random.Random(5)
    for _ in range(3000):
        chunk = "".join(rng.choice("aethinor▁.") for _ in range(rng.randrange(1, pieces.SHORT)))
        assert own.merge(chunk) == own.merge_long(chunk)


def test_a_difference_is_told():
    own = pieces.Vocabulary(open(PIECE_MODEL, "rb").read())
    own.encode("hello")
    own.fresh["▁hello"] = (5,)
    with pytest.raises(ValueError, match="differ"):
        pieces.check_parts(own, pieces.library(PIECE_MODEL))


# --- toxicity ---


def test_pairs_are_learned():
    """Two terms that are harmless alone and toxic together: a sum of weights cannot say that, the machine can."""
    rng = np.random.default_rng(2)
    docs, labels = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.4
        rest = rng.integers(100, 400, 6)
        docs.append(np.unique(np.concatenate([rest, [1] * int(a), [2] * int(b)])).astype(np.uint32))
        labels.append(int(a and b))
    m = toxicity.fit(docs, np.array(labels, float), epochs=40)
    scores = m.scores([[1, 2], [1], [2], [150]])
    assert scores[0] > 0.5 > scores[1:].max()


def test_no_labels_no_machine():
    none = toxicity.fit([], np.zeros(0))
    assert none.scores([[], [1]]).max() < 1e-6
    one = toxicity.fit([np.array([1], np.uint32)] * 3, np.ones(3))
    assert len(one.at) == 0 and 0 < one.scores([[1]])[0] < 1


# --- shards ---


def smallest(sizes, shards):
    def needs(c):
        n, held = 1, 0
        for s in sizes:
            if held + s > c:
                n, held = n + 1, 0
            held += s
        return n

    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if needs(mid) <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("held", [20, 90])
def test_capacity_with_few_ends_on_the_driver(spark, held):
    rng = random.Random(held)
    for case in range(2):
        sizes = [rng.choice([16, 17, 40, 900 if case else 50, 5000 if rng.random() < 0.01 else 30]) for _ in range(500)]
        ends = np.cumsum(sizes).tolist()
        groups = spark.createDataFrame([(e, i + 1) for i, e in enumerate(ends)], "group_end long, group_rank long")
        known = sharding.Ends([0, ends[-1]], [0, len(ends)])
        capacity, cuts = sharding.minimax_cuts(groups, known, max(sizes), 7, held)
        assert capacity == smallest(sizes, 7)
        assert cuts[-1] == ends[-1] and set(cuts) <= set(ends)
        assert max(b - a for a, b in zip([0, *cuts], cuts, strict=False)) == capacity


# --- decontamination ---


def slow_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        now = [i]
        for j, d in enumerate(text, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (c != d)))
        row = now
    return min(row)


def test_distance():
    rng = random.Random(3)
    for _ in range(300):
        item, text = ("".join(rng.choice("abc ") for _ in range(rng.randrange(a, b))) for a, b in ((1, 40), (0, 60)))
        assert decontaminate.distance(decontaminate.masks(item), len(item), text)[0] == slow_distance(item, text)


def test_matcher_finds_all_within_budget():
    rng = random.Random(6)
    items = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(60, 140)))) for i in range(6)]
    matcher = decontaminate.Matcher(items)
    for _ in range(150):
        number, item = rng.choice(items)
        changed = list(item)
        for _ in range(rng.randrange(0, decontaminate.budget(item) + 3)):
            at = rng.randrange(len(changed))
            changed[at : at + rng.randrange(0, 2)] = rng.choice(["", "x", "yz"])
        text = "".join(rng.choice("abcdefgh ") for _ in range(50)) + "".join(changed) + "tail of the text"
        want = {(n, slow_distance(t, text)) for n, t in items}
        assert {(n, d) for n, d, _ in matcher.matches(text)} == {(n, d) for n, d in want if d <= decontaminate.budget(items[n][1])}


# --- token counts ---


def test_edits_against_full_split():
    words = token_counts.counter(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(7)
    letters = ["a", "é", " ", "  ", "\n", "'", "s", "re", "l", "1", ".", "$", "漢", "\t", "don't", " the", "\xa0"]
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 40)))
        tree = token_counts.grow(text, words)
        for _ in range(rng.randrange(1, 6)):
            at, gone, added = rng.randrange(0, len(text) + 3), rng.randrange(0, 12), "".join(rng.choice(letters) for _ in range(rng.randrange(0, 5)))
            tree.edit(at, gone, added, words)
            at = min(at, len(text))
            text = text[:at] + added + text[at + gone :]
            chars, tokens = tree.leaves()
            assert tree.text == text
            assert chars.tolist() == [len(p) for p in words.split.findall(text)]
            assert tree.n_tokens == tokens.sum() == len(words.encoding.encode_ordinary(text))


def test_packing():
    for values in ([], [1, 255], [256, 0], [1 << 20]):
        assert token_counts.unpack(token_counts.pack(np.array(values, np.int64))).tolist() == values


# --- spans ---


def test_sentences_keep_all_text():
    for text in ("", "a. b", "..", "one, two;\n\nthree: four", "no marks"):
        assert "".join(sentence_spans.sentences(text)) == text


def test_span_is_the_shortest_run():
    parts = sentence_spans.sentences("a b. c d. e f g. h.")
    assert [(a, b) for a, b, _ in sentence_spans.spans(parts, 4)] == [(0, 2), (1, 3), (2, 4)]
    assert [(a, b) for a, b, _ in sentence_spans.spans(parts, 1)] == [(0, 2), (1, 3), (2, 4)]
    one = {k for _, _, k in sentence_spans.spans(sentence_spans.sentences("x y.  a b,"), 1)}
    two = {k for _, _, k in sentence_spans.spans(sentence_spans.sentences("x y. a\tb,"), 1)}
    assert one == two


# --- n-gram join ---


def test_pruning_follows_the_posterior():
    """The bound is the first m whose posterior of reaching the threshold is no longer negligible."""
    t, e = 0.8, 1e-7
    for step, m in enumerate(ngram_join.least_equal(), 1):
        n = step * ngram_join.STEP

        def posterior(k, n=n):  # of Beta(k + 1, n - k + 1) above t
            x = np.linspace(t, 1, 20001)
            logs = k * np.log(x) + (n - k) * np.log(np.maximum(1 - x, 1e-300))
            return float(np.trapezoid(np.exp(logs - math.lgamma(k + 1) - math.lgamma(n - k + 1) + math.lgamma(n + 2)), x))

        assert posterior(m) >= e * 0.99
        assert m == 0 or posterior(m - 1) < e * 1.01


def test_shared_counts():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 3000, rng.integers(1, 2500), dtype=np.uint64)) for _ in range(30)]
    a, b = np.triu_indices(30, 1)
    want = [len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b, strict=True)]
    assert ngram_join.shared(sets, a, b).tolist() == want
    assert ngram_join.shared(sets, a[:5], b[:5]).tolist() == want[:5]


# --- pages ---


def test_parser_reads_broken_markup():
    page = dom.parse('<DIV CLASS=a>x<p>one<p>two &amp; <b>t</b>hree<!-- c --><br>end</DIV><script>if (a<b) "</p>"</script><li>1<li>2 <')
    assert page.tag == ["#root", "div", "p", "p", "li", "li"]
    assert page.text() == "x one two & three end 1 2 <"
    assert dom.parse("<p title='a>b'>q").text() == "q"
    assert dom.parse('<p title="unclosed>q').text() in ("q", "")
    assert dom.parse("<script>never closed").text() == ""
    assert dom.parse("<!-- never closed").text() == ""
    assert dom.parse("<div>" * 20_000 + "deep").text() == "deep"


def test_decoding_is_consistent():
    rng = np.random.default_rng(9)
    for _ in range(200):
        n = int(rng.integers(2, 9))
        page = dom.Page(tag=["#root"] + ["div"] * (n - 1), parent=[-1, *(int(rng.integers(0, i)) for i in range(1, n))])
        scores = rng.normal(0, 2, n)
        keep = main_text.decode(page, scores)
        assert keep[0] and all(keep[page.parent[i]] for i in range(1, n) if keep[i])

        def worth(labels, scores=scores, n=n):
            return sum(np.clip(scores[i], -6, 6) * (1 if labels[i] else -1) for i in range(1, n))

        options = [[True, *(bool(k >> i & 1) for i in range(n - 1))] for k in range(1 << (n - 1))]
        best = max(worth(o) for o in options if all(o[page.parent[i]] for i in range(1, n) if o[i]))
        assert worth(keep) == pytest.approx(best)


def test_boosting_learns_what_one_split_cannot():
    rng = np.random.default_rng(10)
    x = rng.normal(size=(3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = boosting.boost(x[:2000], y[:2000])
    assert ((model.logits(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.93
    assert len(boosting.boost(x[:0], y[:0]).trees) == 0


# --- archives of other writers ---


def foreign(block, *fields, kind="response"):
    head = [b"WARC/1.0", b"WARC-Type: " + kind.encode(), b"WARC-Record-ID: <urn:x:1>", b"WARC-Date: 2020-01-01T00:00:00Z", *fields]
    return b"\r\n".join([*head, b"Content-Length: " + str(len(block)).encode()]) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_records_of_other_writers():
    plain = b"HTTP/1.1 200 OK\r\nServer: s\r\n\r\nbody"
    sha = hashlib.sha256(b"body").hexdigest().encode()
    rec = warc.parse_record(foreign(plain, b"WARC-Target-URI: http://a/\xe9", b"X-Folded: one\r\n two", b"WARC-Payload-Digest: sha256:" + sha))
    assert rec[3:] == ("http://a/é", 4, warc.digest(b"body"), b"body")
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=y\r\nabc\r\n2\r\nde\r\n0\r\n\r\n"
    assert warc.parse_record(foreign(chunked, b"WARC-Payload-Digest: sha1:" + warc.digest(b"abcde").encode()))[4:] == (5, warc.digest(b"abcde"), b"abcde")
    assert warc.parse_record(foreign(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nnot chunks"))[6] == b"not chunks"
    assert warc.parse_record(foreign(b"HTTP/1.1 304 Not Modified\r\n\r\n", kind="revisit"))[2:6] == (None, None, None, None)
    assert warc.parse_record(foreign(b"gopher text", b"WARC-Payload-Digest: blake3:xyz"))[4] == 11
    for bad in (b"sha256:" + hashlib.sha256(b"other").hexdigest().encode(), b"sha1:" + warc.digest(b"other").encode(), b"md5:" + b"0" * 32):
        with pytest.raises(warc.BadArchive, match="payload digest"):
            warc.parse_record(foreign(plain, b"WARC-Payload-Digest: " + bad))


def test_broken_dictionaries_are_told():
    body = b"".join([(0xFD2FB528).to_bytes(4, "little"), b"\x00garbage"])
    for held in (body, warc.dictionary_frame(b"x" * 5000)[8:-3]):
        raw = warc.struct.pack("<II", warc.DICTIONARY_FRAME, len(held)) + held
        with pytest.raises(warc.BadArchive):
            list(warc.frames(io.BytesIO(raw + b"more").read))


# --- foreign pages ---


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<html><head><title>t</title><meta x><div>a</div><p>b", "a b"),
        ("<head><script>s</script>text <b>bold</b>", "text bold"),
        ("<div>a<svg/>b</div><p>c", "ab c"),
        ("<p>a <svg><path d='x'/><text>no</text></svg> b</p>", "a b"),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math> holds</p>", "so x=2 holds"),
        ("<object><p>fallback</p></object>", "fallback"),
        ("<ul><li>a<div><div>b<li>c</ul>d", "a b c d"),
    ],
)
def test_foreign_markup_keeps_its_text(source, want):
    page = dom.parse(source)
    assert page.text(main_text.decode(page, np.full(len(page.tag), 5.0))) == want


@pytest.mark.parametrize("unit", ["<div class='some-name other{}'>", "<div></x></y>", "<li><div></li>", "<ul><li></li>", "<body><p>", "</div>", "<p>a<svg/>"])
def test_a_page_of_a_megabyte_is_read_at_once(unit):
    source = "".join(unit.format(i) for i in range(1_000_000 // len(unit)))
    start = time.process_time()
    page = dom.parse(source)
    extractor = main_text.Extractor(boosting.Boosted(0.5, []), {"some": 0, "name": 1})
    spent = time.process_time() - start
    rows = sum(len(m) for m in extractor.matrices(main_text.shape(page)))
    assert rows == len(page.tag) and spent < 5
