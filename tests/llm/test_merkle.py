"""Merkle manifests against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from llm_cases import documents
from pyspark.sql import functions as F

from cartwright.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % 8
        out.append((i - first, level[first:i] + level[i + 1:first + 8]))
        i //= 8
    return out


def brute(rows, tamper):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"], H(*[field(r[c]) for c in merkle.FIELDS]), H(*[field(x) for x in tamper(r)])))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [tree([leaf for _, leaf, _ in groups[n]]) for n in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for j, n in enumerate(names):
        for i, (key, leaf, found) in enumerate(groups[n]):
            steps = path(trees[j], i) + path(top, j)
            for child, others in steps:
                found = H(*others[:child], found, *others[child:])
            out.append((key, n, leaf, trees[j][-1][0], top[-1][0], H(*[o for _, others in steps for o in others]), found, found == top[-1][0]))
    return sorted(map(str, out))


def tampered(r):
    text = r["text"]
    if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]


def manifest(df, **more):
    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(third, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return sorted(str(tuple(r)) for r in merkle.manifest(df, tampered={"text": text}, **more).collect())


def test_awkward_rows(spark):
    """Null ids, groups and texts, repeated rows, an empty group name, clashing columns."""
    docs = documents(spark, clashes=True)
    docs = docs.unionByName(docs.limit(2).withColumn("lang", F.lit("")))
    assert manifest(docs) == brute(docs.collect(), tampered)


@pytest.mark.parametrize("sizes", [[1], [64, 65, 1], [600, 586, 4, 3, 2, 1, 1, 1, 1, 73]])
def test_exchange(spark, sizes):
    """Blocks of eight leaves, so that several rounds and ragged last runs occur in and above the groups."""
    rows = [(10 * i + g, f"Text {i} OF {g}", f"g{g}") for g, n in enumerate(sizes) for i in range(n)]
    docs = documents(spark, rows)
    assert manifest(docs, height=1) == brute(docs.collect(), tampered)


def test_many_groups_and_equal_rows(spark):
    """More groups than one run holds; a third of all rows are one row."""
    rows = [(i, "A text", f"{i:03d}") for i in range(80)] + [(5, "Same ROW", "hot")] * 40
    docs = documents(spark, rows)
    assert manifest(docs, height=1) == brute(docs.collect(), tampered)


def test_untampered_and_empty(spark):
    docs = documents(spark)
    assert all(r.verified for r in merkle.manifest(docs).collect())
    assert merkle.manifest(docs.limit(0)).collect() == []


def test_long_path_of_a_block(spark):
    """A path folds to the root from any leaf, and not from another one."""
    leaves = [H(str(i)) for i in range(100)]
    levels = tree(leaves)
    steps = [(c, "".join(o)) for c, o in path(levels, 77)]
    assert merkle.folded(leaves[77], steps) == levels[-1][0]
    assert merkle.folded(leaves[76], steps) != levels[-1][0]
