"""Spelling variants against all pairs, and rough input."""

import random
import re
import zlib
from collections import Counter

import pytest

from tallyspan.llm import spelling


def near(a, b):
    """Whether one edit makes one of the other."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def expected(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    found = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in found.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 10 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(found[w]), counts.get(form[w])) for w, n in counts.items())


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def mutated(rng, word):
    i, letters = rng.randrange(len(word)), "abcdeéÿß"
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i:], word[:i] + rng.choice(letters) + word[i + 1 :]])


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(docs_of, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(6, 14))) for _ in range(25)]
    for _ in range(250):
        words.append(mutated(rng, rng.choice(words)))
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=150))) for i in range(30)]
    want = expected(docs)
    assert result(spelling.variants(docs_of(docs))) == want
    assert sum(w[1] is not None for w in want) > 5 and max(w[4] for w in want) > 3


def test_chains_lead_to_the_last_form(docs_of):
    counts = {"abcdefghi": 4000, "abcdefghij": 300, "abcdefghijk": 25, "abcdefghijkl": 2}
    docs = [(1, " ".join(w for w, n in counts.items() for _ in range(n)))]
    want = expected(docs)
    assert result(spelling.variants(docs_of(docs))) == want
    assert [w[2] for w in want] == ["abcdefghi"] * 4


def test_ties_take_the_first_form(docs_of):
    docs = [(1, "abcdefgh abcdefgh " + "abcdefghz " * 40 + "abcdefghé " * 40 + "abcdefgha " * 40)]
    assert result(spelling.variants(docs_of(docs))) == expected(docs)


def test_rough_input(docs_of):
    long = "wordsandwords " * 30_000 + "x" * 5000
    docs = [(1, None), (2, ""), (None, "Wörterbuch wörterbuch WÖRTERBUCH"), (None, "Wörterbuch"), (3, long), (3, long), (4, "ÀÉÎÕÜÿß×÷ ÀÉÎÕÜÿß×÷ short"), (5, "漢字abcdefgh1abcdefgh")]
    assert result(spelling.variants(docs_of(docs))) == expected(docs)
    assert spelling.variants(docs_of([])).collect() == []


def test_each_pair_once(spark):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))) for _ in range(300)})
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [(r.a, r.b) for r in spelling.near_pairs(frame).collect()]
    assert len(got) == len(set(got))
    assert {frozenset(p) for p in got} == {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
