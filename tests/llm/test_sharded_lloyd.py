"""Dimension-sharded Lloyd against whole-matrix rounds in exact integers."""

import hashlib

import numpy as np
import pytest

from cartwright.llm import sharded_lloyd as L


def brute(rows, k, rounds, size):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    x = [[int(np.floor(256 * np.float64(c))) for c in v] for _, v in kept]
    mark = lambda i: (kept[i][0] is None, hashlib.sha256(f"2:{kept[i][0]}".encode()).hexdigest(), kept[i][1])
    centers = [x[i] for i in sorted(range(len(x)), key=mark)[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centers))
    for _ in range(rounds):
        found = [near(v)[1] for v in x]
        centers = [[sum(x[i][d] for i in range(len(x)) if found[i] == j) // found.count(j) for d in range(size)] if j in found else c
                   for j, c in enumerate(centers)]
    last = [near(v) for v in x]
    sums = {j: sum(d for d, c in last if c == j) for j in range(len(centers))}
    return sorted(map(str, ((i, c, d, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, centers[c])).encode()).hexdigest())
                            for (i, _), (d, c) in zip(kept, last))))


def rows_of(spark, data):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in data], "vec_id long, embedding array<double>, id string, v string")


def found(df, **more):
    return sorted(str(tuple(r)) for r in L.cluster(df, **more).collect())


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_rounds(spark, shards):
    """Unusable vectors, repeated rows, equal ids, negative sums; names that clash with the operator's own."""
    rng = np.random.default_rng(4)
    data = [(i, rng.normal(size=8).tolist()) for i in range(150)] + [(3, [0.0] * 8)] * 5 + [(150, [9.0] * 8), (None, [1.0] * 8)]
    data += [(200, None), (201, []), (202, [1.0] * 7), (203, [None] + [1.0] * 7), (204, [float("nan")] * 8), (205, [float("-inf")] + [0.0] * 7)]
    got = found(rows_of(spark, data).repartition(5), k=12, rounds=4, size=8, shards=shards)
    assert got == brute(data, 12, 4, 8)


def test_ties_and_few_vectors(spark):
    """All vectors alike: the smallest number takes all and the other centroids stay; fewer vectors than centroids."""
    data = [(i, [0.5, -0.5]) for i in range(30)]
    assert found(rows_of(spark, data), k=4, rounds=2, size=2, shards=2) == brute(data, 4, 2, 2)
    data = [(i, [float(i), 1.0]) for i in range(3)]
    assert found(rows_of(spark, data), k=40, rounds=2, size=2, shards=2) == brute(data, 3, 2, 2)


def test_hot_group_over_many_chunks(spark):
    """A third of all rows are one vector."""
    rng = np.random.default_rng(8)
    data = [(i, rng.normal(size=4).tolist()) for i in range(1500)] + [(7, [0.25] * 4)] * 800
    assert found(rows_of(spark, data), k=6, rounds=3, size=4, shards=2) == brute(data, 6, 3, 4)


def test_large_components_are_exact(spark):
    """Products beyond 2**53 are computed in 64 bits; beyond the stated reach it is an error."""
    a = np.array([[L.WIDEST, -L.WIDEST], [L.WIDEST - 1, 3]])
    b = np.array([[-L.WIDEST, L.WIDEST], [5, 7]])
    want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(v, c)) for c in b] for v in a]
    assert L.partial_distances(a, b).tolist() == want
    with pytest.raises(ValueError):
        L.integers(np.array([2.0 ** 28]))


def test_empty_table(spark):
    df = rows_of(spark, [(1, [1.0])])
    assert L.cluster(df.limit(0)).collect() == [] and L.cluster(df).collect() == []
    assert L.cluster(df).dtypes == [tuple(c.split(" ")) if " " in c else c for c in
                                    [x.replace("long", "bigint") for x in L.RESULT.split(", ")]]
