"""Fingerprints against a plain version, the search against all pairs, and rough input."""

import hashlib
import random
import re

import duckdb
import pytest
import xxhash

from tallyspan.llm import fingerprints
from tallyspan.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MASK = (1 << 64) - 1


def fingerprint(text):
    """The definition, one word at a time."""
    weights = {}
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        size = 3 if len(word) > 6 else 2 if len(word) > 3 else 1
        term = xxhash.xxh64_intdigest(word.encode(), 42) & ~3 & MASK | size
        weights.setdefault(term, []).append(size)
    votes, total = [0] * 128, 0
    for term, found in weights.items():
        weight = found[0] * sum(len(found) >= n for n in (1, 2, 4, 8))
        total += weight
        first = xxhash.xxh64_intdigest(term.to_bytes(8, "little"), 42)
        second = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), first)
        for bit in range(64):
            votes[64 + bit] += weight * (first >> bit & 1)
            votes[bit] += weight * (second >> bit & 1)
    return sum(1 << i for i, n in enumerate(votes) if 2 * n > total)


def expected(rows):
    """Every result column by (doc_id, place in the order), rows being (doc_id, text) in the operator's order."""
    texts = [t or "" for _, t in rows]
    prints = [fingerprint(t) for t in texts]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        after = (i + 1) % len(rows)
        cut = len(texts[i]) // 3
        edited = texts[i][: len(texts[i]) - cut] + texts[after][:cut]
        changed = fingerprint(edited)
        like = [1 - (prints[i] ^ p).bit_count() / 128 for p in (changed, prints[after])]
        near = sum((prints[i] ^ p).bit_count() <= fingerprints.RADIUS for p in prints) - 1
        asked = doc_id is not None and doc_id % 100 == 0
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc_id, len(texts[i]), sha, f"{prints[i]:032x}", f"{changed:032x}", *like, near if asked else None))
    return out


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id DESC").fetchall()
    got = {tuple(r) for r in QUERIES["op13_fingerprints"](spark, SF).collect()}
    assert got == set(expected(rows))
    assert len(got) == len(rows)


def test_an_edit_stays_closer_than_another_document(spark):
    got = QUERIES["op13_fingerprints"](spark, "/root/testdata/sf0.01").collect()
    assert sum(r.near_edited > r.near_next for r in got) > 0.98 * len(got)


def test_every_row_in_order(docs_of):
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    # by descending id, the null id last; ids are unique, so the order is known
    rows = [(400, "one two three four"), (300, None), (200, ""), (100, long), (7, "tab\tand\nline 漢字 😀 ends"), (3, " \n "), (None, "x")]
    got = [tuple(r) for r in fingerprints.fingerprinted(docs_of(rows[::-1])).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)
    assert {r[3] for r in got if r[0] in (300, 200, 3)} == {"0" * 32}


def test_repeated_rows_follow_each_other(docs_of):
    rows = [(5, "a b c d e f"), (4, "g h i j k l")] + [(4, "g h i j k l")] * 40 + [(1, "m n")]
    got = [tuple(r) for r in fingerprints.fingerprinted(docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_a_lone_and_no_document(docs_of):
    assert fingerprints.fingerprinted(docs_of([])).collect() == []
    one = fingerprints.fingerprinted(docs_of([(100, "alone with itself")])).collect()[0]
    assert (one.near_next, one.n_near) == (1.0, 0)


def test_an_id_with_different_texts_has_all_rows(docs_of):
    got = fingerprints.fingerprinted(docs_of([(9, "a b c"), (9, "d e f"), (None, "g"), (None, None)])).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == [("9", 5), ("9", 5), ("None", 0), ("None", 1)]


def test_ids_in_many_partitions(spark, docs_of):
    rows = [(i, f"text number {i} with {i * 7} words") for i in range(500, 0, -1)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        got = fingerprints.fingerprinted(docs_of(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {tuple(r) for r in got} == set(expected(rows))


@pytest.mark.parametrize("radius, blocks", [(6, 8), (7, 8), (3, 4), (14, 16)])
def test_tables_find_all_within_the_radius(spark, radius, blocks):
    rng = random.Random(radius)
    held = {rng.getrandbits(128) for _ in range(30)}
    for base in list(held)[:10]:
        for _ in range(12):
            near = base
            for bit in rng.sample(range(128), rng.randrange(radius + 3)):
                near ^= 1 << bit
            held.add(near)
    held = sorted(held)

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    pairs = [(signed(x >> 64), signed(x & MASK)) for x in held]
    index = spark.createDataFrame([(*p, i % 5 + 1) for i, p in enumerate(pairs)], "hi long, lo long, n long")
    got = {(r.q_hi, r.q_lo): r.n_within for r in fingerprints.within(index.select("hi", "lo"), index, radius, blocks).collect()}
    assert got == {p: sum(j % 5 + 1 for j, y in enumerate(held) if (x ^ y).bit_count() <= radius) for p, x in zip(pairs, held, strict=True)}


def test_no_tables_for_some_radius(spark):
    frame = spark.createDataFrame([(1, 2)], "hi long, lo long")
    for radius, blocks in ((8, 8), (3, 5), (2, 8)):
        with pytest.raises(ValueError):
            fingerprints.block_tables(frame, radius=radius, blocks=blocks)


def test_no_python_on_the_main_path(spark, plan, docs_of):
    found = plan(fingerprints.fingerprinted(docs_of([(1, "a b"), (2, "c d")])))
    assert "Python" not in found and "Arrow" not in found and "CartesianProduct" not in found
