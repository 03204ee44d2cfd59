"""Runs of white space that tiktoken cannot take."""

import random

import public_tokenizers
import pytest
from llm_cases import documents
from tokenizers import Tokenizer

from cartwright.llm import packing


def test_long_white_space(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = Tokenizer.from_file(path)
    texts = [f"some words{c * 1_100_000}and the end<|endoftext|> here" for c in " \n"] + ["short  text"]
    with pytest.raises(ValueError):
        packing.encoder(path).encode(texts[0], allowed_special="all")
    got = {}
    rows = packing.tokenized_pieces(documents(spark, [(i, t, "en") for i, t in enumerate(texts)]), path, ids_too=True)
    for r in sorted(rows.collect(), key=lambda r: (r.id, r.piece)):
        got.setdefault(r.id, []).extend(r.ids)
    assert got == {i: [*coder.encode(t, add_special_tokens=False).ids, packing.END] for i, t in enumerate(texts)}


def test_search_beats_best_fit():
    """Dominance never loses a piece or overfills, and islands need no more sequences than best fit, fewer somewhere."""
    rng = random.Random(7)
    fewer = 0
    for n in (60, 300, 500):
        sizes = sorted((rng.randint(1, 900) if rng.random() < 0.7 else rng.randint(300, 520) for _ in range(n)), reverse=True)
        plain = packing.best_fit(sizes, list(range(n)), [], 1024)
        kept = [list(b) for b in plain[: len(plain) // 2]]
        free = [i for b in plain[len(plain) // 2:] for i in b]
        before = [sum(sizes[i] for i in b) for b in kept]
        fills = list(before)
        left = packing.refill(sizes, kept, fills, list(free), 1024)
        assert fills == [sum(sizes[i] for i in b) for b in kept]
        assert sorted(left + [i for b in kept for i in b]) == list(range(n))
        assert all(old <= sum(sizes[i] for i in b) <= 1024 for old, b in zip(before, kept))
        best = packing.evolve(sizes, [], packing.Plan(work=60_000), 1024, random.Random(1))[0].bins
        assert sorted(i for b in best for i in b) == list(range(n)) and all(sum(sizes[i] for i in b) <= 1024 for b in best)
        assert -(-sum(sizes) // 1024) <= len(best) <= len(plain)
        fewer += len(best) < len(plain)
    assert fewer
