"""Pieces of equal hash are told apart by their bytes."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cartwright.llm import byte_bpe

TEXTS = ["the cat and the dog and the fox", "", "x" * 200 + " " + "x" * 201, "1234 567 89 !!! ??? ...", "é è ê ü ö the and", " " * 90 + "a"]


@pytest.mark.parametrize("hashes", [
    lambda data, first, size: np.zeros(len(first), np.uint64), lambda data, first, size: size.astype(np.uint64),
    lambda data, first, size: data[first].astype(np.uint64),
])
def test_equal_hashes(monkeypatch, hashes):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    monkeypatch.setattr(byte_bpe.Coder, "_hashes", staticmethod(hashes))
    ids, counts, _ = byte_bpe.Coder(byte_bpe.read_ranks(path)).encode(TEXTS)
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [library.encode_ordinary(t) for t in TEXTS]
