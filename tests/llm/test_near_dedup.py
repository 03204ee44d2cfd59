"""The near-dedup stage and its components against brute force over fingerprints."""

import numpy as np
import pytest
from llm_cases import TEXTS, documents
from test_groups import slow_components, slow_fingerprint

import corpus_pipeline
from cartwright.llm import simhash


def survivors(rows):
    """One (id, text) of each component: known ids first, then the smallest."""
    labels = slow_components([slow_fingerprint(t) for _, t, _ in rows])
    groups = {}
    for (i, t, _), x in zip(rows, labels):
        groups.setdefault(x, set()).add((i, t))
    return groups.values()


def stay(spark, rows):
    out = corpus_pipeline.near_dedup(spark, documents(spark, rows, clashes=True), "")
    assert out.columns == documents(spark, rows, clashes=True).columns
    return [(r.doc_id, r.text) for r in out.collect()]


@pytest.mark.parametrize("rows", [
    TEXTS, [(None, t, lang) for _, t, lang in TEXTS],
    TEXTS + [(99, t, lang) for _, t, lang in TEXTS],  # one id for unlike texts
])
def test_awkward_rows(spark, rows):
    got, want = stay(spark, rows), survivors(rows)
    assert len(got) == len(want)
    for group in want:
        kept = [x for x in got if x in group]
        least = min((i for i, _ in group if i is not None), default=None)
        assert len(kept) == 1 and kept[0][0] == least


def test_near_copies_and_empty_table(spark):
    """Long texts with a word changed in some, in groups of one to forty."""
    rng = np.random.default_rng(6)
    rows = []
    for base in range(8):
        words = [f"w{int(x)}" for x in rng.integers(3000, size=400)]
        for copy in range(40 if base == 0 else base):
            own = list(words)
            if copy % 2:
                own[int(rng.integers(400))] = "other"
            rows.append((len(rows), " ".join(own), "en"))
    assert {i for i, _ in stay(spark, rows)} == {min(i for i, _ in g) for g in survivors(rows)}
    assert stay(spark, rows[:0]) == []


def test_components_of_hubs_and_chains(spark):
    """Two hubs that share a leaf, a chain in random order, and single edges given both ways."""
    rng = np.random.default_rng(2)
    names = rng.permutation(6000)
    edges = [(0, i) for i in range(1, 3000)] + [(3000, i) for i in range(2999, 4000)] + [(i, i + 1) for i in range(4001, 4100)]
    edges += [(5000, 5001), (5001, 5000), (5002, 5002)]
    edges = [(int(names[a]), int(names[b])) for a, b in edges]
    root = list(range(6000))
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(root[a], root[b])
            changed |= root[a] != least or root[b] != least
            root[a] = root[b] = least
    found = simhash.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.a: r.b for r in found.collect()} == {i: x for i, x in enumerate(root) if x != i}
