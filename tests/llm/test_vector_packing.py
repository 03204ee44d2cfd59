"""Vector packing: every id in one place, all limits kept, no padding, the choice against brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import TEXTS, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartwright.llm import vector_packing as V

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def check(rows, limits, sizes):
    """Gapless sequences within the limits, of full or power-of-two size; every document covered once."""
    sequences, docs = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        docs.setdefault(r.id, []).append((r.start, r.length))
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and at & (at - 1) == 0
        assert len(pieces) <= limits.segments and sum(r.loss for r in pieces) <= limits.loss
    for key, size in sizes.items():
        at = 0
        for start, length in sorted(docs.pop(key)):
            assert start == at
            at += length
        assert at == size
    assert not docs


def test_documents(spark):
    """Nulls, empty, long and odd texts, clashing names; ids as the tokenizers library gives them."""
    rows = [(i, t, lang) for i, (_, t, lang) in enumerate(TEXTS)]
    got = V.pack(documents(spark, rows, clashes=True), PATH).collect()
    ids = {i: ids_of(t) + [V.END] for i, t, _ in rows}
    check(got, V.Limits(), {i: len(x) for i, x in ids.items()})
    for r in got:
        assert r.crc == zlib.crc32(np.array(ids[r.id][r.start:r.start + r.length], "<u4").tobytes())
        assert r.doc_tokens == len(ids[r.id])


def test_repeated_rows_null_ids_and_empty_table(spark):
    got = V.pack(documents(spark), PATH).collect()
    assert sum(r.length for r in got) == sum(len(ids_of(t)) + 1 for _, t, _ in TEXTS)
    assert any(r.id is None for r in got) and sum(r.id == 7 and r.start == 0 for r in got) == 2
    assert V.pack(documents(spark).limit(0), PATH).collect() == []


@pytest.mark.parametrize("limits", [V.Limits(256, 8, 96), V.Limits(512, 3, 512), V.Limits(64, 64, 64), V.Limits(128, 1, 1)])
def test_instruction_data(spark, limits):
    """Prompts bear no loss; each of the three limits binds in one of the cases."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["ask"] * int(rng.integers(0, 200))), " ".join(["tell"] * int(rng.integers(0, 120)))) for i in range(120)]
    data = spark.createDataFrame([(i, p if i % 7 else None, t) for i, p, t in rows], "doc_id long, question string, text string")
    got = V.pack(data.repartition(3), PATH, prompt="question", limits=limits).collect()
    before = {i: len(ids_of(p)) if i % 7 else 0 for i, p, _ in rows}
    check(got, limits, {i: before[i] + len(ids_of(t)) + 1 for i, _, t in rows})
    for r in got:
        assert r.loss == sum(at >= before[r.id] and at > r.start for at in range(r.start, r.start + r.length))


def test_choice_is_the_largest_dot_product():
    """Against plain loops over all pieces, for random pools and rooms."""
    rng = np.random.default_rng(1)
    limits = V.Limits(256, 16, 128)
    for _ in range(60):
        pool = V.Pool(limits)
        for i in range(40):
            n, answer = int(rng.integers(1, 200)), int(rng.integers(0, 200))
            pool.add(V.Document(i, np.zeros(n, "<u4"), 0, answer, n), 0, n)
        room = int(rng.integers(1, 257)), 5, int(rng.integers(1, 129))
        demand = [(int(t), int(t - f)) for t, f in zip(pool.tokens[:40], pool.free[:40])]
        means = [sum(d[k] for d in demand) / 40 for k in (0, 1)]
        scores = {}
        for i, (t, loss) in enumerate(demand):
            if t <= room[0] and loss <= room[2]:
                scores[i] = means[0] / 256 * (t / 256) * (room[0] / 256) + means[1] / 128 * (loss / 128) * (room[2] / 128)
        chosen = pool.best_whole(room)
        if any(demand[i][0] == room[0] for i in scores):
            assert demand[chosen][0] == room[0]
        elif not scores:
            assert chosen is None
        else:
            assert scores[chosen] == pytest.approx(max(scores.values()))


def test_hot_tiny_rows(spark):
    """Far more one-token rows than a sequence has segments."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    got = V.pack(docs, PATH).collect()
    check(got, V.Limits(), {i: 1 for i in range(3000)})
    assert len({r.sequence_id for r in got}) <= 3000 / 64 + 12
