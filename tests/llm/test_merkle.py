"""The Merkle manifest against a plain version, with small blocks so that tiers recur."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tallyspan.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes, fan=8):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def siblings(tree, at, fan=8):
    for nodes in tree[:-1]:
        start = at // fan * fan
        yield nodes[start:at], nodes[at + 1 : start + fan]
        at //= fan


def expected(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row; rows in the order of SCHEMA."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted([r for r in rows if r[2] == g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs}
    trees = {g: levels([leaf(r) for r in rs]) for g, rs in groups.items()}
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            path = [*siblings(trees[g], i), *siblings(top, k)]
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf((*r[:4], text))
            for before, behind in path:
                node = h(*before, node, *behind)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[g][-1][0], root, h(*[d for a, b in path for d in a + b]), node, node == root))
    return out


def some(n, langs=("en", "de", None, "ümlaut")):
    return [(i, "s" if i % 5 else None, langs[i * i % len(langs)], i % 7 or None, None if i % 11 == 0 else f"Text ÄB {i}" * (i % 4)) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 700])
def test_against_a_plain_version(spark, n):
    rows = some(n, ("en",)) if n < 100 else some(n)
    got = [tuple(r) for r in merkle.verified(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got) == sorted(expected(rows))


def test_a_group_of_several_blocks(spark):
    rows = some(1200, ("en", "en", "en", "de"))
    got = [tuple(r) for r in merkle.verified(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got) == sorted(expected(rows))
    assert not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_tiers_recur_with_small_blocks(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(77)]
    made = merkle.manifest(spark.createDataFrame(rows, SCHEMA), fan=2, depth=2)
    got = {r.id: (r.leaf, r.root, [(bytes(s.before).decode(), bytes(s.behind).decode()) for s in r.path]) for r in made.collect()}
    tree = levels([leaf(r) for r in rows], 2)
    assert got == {i: (leaf(r), tree[-1][0], [("".join(a), "".join(b)) for a, b in siblings(tree, i, 2)]) for i, r in enumerate(rows)}


def test_many_groups_and_repeated_rows(spark):
    rows = [(i % 9, "s", f"g{i % 90}", 3, "Same") for i in range(300)] + [(None, None, None, None, None)] * 3 + [(4, "s", None, 1, "x" * 200_000)]
    got = [tuple(r) for r in merkle.verified(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)


def test_extra_columns_and_no_rows(spark):
    frame = spark.createDataFrame(some(20), SCHEMA)
    wide = frame.select("*", *[F.lit("x").alias(c) for c in ("grp", "pos", "size", "row", "at", "part", "block", "top", "digest", "path", "root", "leaf", "items")])
    assert sorted(map(tuple, merkle.verified(wide).collect()), key=str) == sorted(expected(some(20)), key=str)
    assert merkle.verified(frame.limit(0)).collect() == []


def test_a_changed_row_is_found(spark):
    frame = spark.createDataFrame([(i, "s", "en", 1, f"t{i}") for i in range(40)], SCHEMA)
    later = {"text": F.when(F.col("doc_id") == 7, F.lit("other")).otherwise(F.col("text"))}
    made = merkle.manifest(frame, found=later)
    bad = made.where(merkle.folded(F.col("path"), F.coalesce("found_leaf", "leaf")) != F.col("root"))
    assert [r.id for r in bad.collect()] == [7]
