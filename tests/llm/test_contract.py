"""Columns and types of the registered queries, and their digest columns against plain Python."""

import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import xxhash
from test_groups import slow_components, slow_fingerprint

from cartwright.llm import chat_format, queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op2_packing": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op3_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op4_multi_index": "query_id bigint, rank int, vec_id bigint, score double",
    "op5_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op6_chat_format": "conv_id bigint, turn bigint, role string, text string, rendered string",
    "op7_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op8_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op9_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op11_vector_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op12_merkle": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13_sharded_lloyd": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
}


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_columns(spark, name):
    types = dict(queries.registered()[name](spark, SF).dtypes)
    want = dict(c.rsplit(" ", 1) for c in COLUMNS[name].split(", "))
    assert {c: types.get(c) for c in want} == want


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_packing_digests(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: library.encode(r.text or "", add_special_tokens=False).ids for i, r in docs.items()}
    for name, end, capacity in (("op2_packing", 2, 1024), ("op11_vector_packing", 1, 2048)):
        rows = queries.registered()[name](spark, SF).collect()
        held, seen = {}, {}
        for r in rows:
            whole = ids[r.doc_id] + [end]
            assert zlib.crc32(np.array(whole[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
            held.setdefault(r.sequence_id, []).append((r.offset, r.length))
            seen.setdefault(r.doc_id, []).append((r.start, r.length))
        for pieces in [*held.values(), *seen.values()]:
            ends = [0, *(a + n for a, n in sorted(pieces))]
            assert [a for a, _ in sorted(pieces)] == ends[:-1]
        assert all(sum(n for _, n in p) <= capacity for p in held.values())
        assert {i: sum(n for _, n in p) for i, p in seen.items()} == {i: len(x) + 1 for i, x in ids.items()}


def test_language_rows(spark, docs):
    rows = queries.op3_language_id(spark, SF).collect()
    langs = {r.lang for r in docs.values() if r.lang is not None}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in docs[r.doc_id].text or "")
        assert (r.lang_pred in langs) == letters and (letters or r.lang_pred == "und")


def test_sharding_rows(spark, docs):
    """Checksums of the texts, one law, gapless slots; the rendezvous by hashes of its own; one more shard takes only into itself."""
    rows = queries.op8_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs) and {r.law for r in rows} == {"key"}
    shards = {}
    for r in rows:
        text = (docs[r.doc_id].text or "").encode()
        assert r.size == len(text) + 1 and r.text_crc32 == zlib.crc32(text)
        shards.setdefault(r.shard, []).append(r.slot)

        def bid(s):
            # a chain of 64-bit hashes, each the seed of the next: the operator's seed, the shard, the key
            h = 42
            for value, width in ((11, 4), (s, 4), (r.doc_id, 8)):
                h = xxhash.xxh64(int(value).to_bytes(width, "little", signed=True), seed=h % 2**64).intdigest()
            return h - 2**64 if h >= 2**63 else h

        assert r.shard == max(range(8), key=lambda s: (bid(s), -s)) and r.grown_shard == max(range(9), key=lambda s: (bid(s), -s))
        assert r.grown_shard in (r.shard, 8)
    assert set(shards) == set(range(8)) and all(sorted(x) == list(range(len(x))) for x in shards.values())


def test_neighbour_rows(spark):
    vectors = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    rows = queries.op4_multi_index(spark, SF).collect()
    found = {}
    for r in rows:
        assert abs(r.score - float(vectors[r.query_id] @ vectors[r.vec_id])) < 1e-12
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert set(found) == {i for i in vectors if i % 20 == 0}
    for q, got in found.items():
        near = sorted((i for i in vectors if i != q), key=lambda i: (-round(float(vectors[q] @ vectors[i]), 9), i))[:20]
        assert sorted(got) == list(enumerate(near, 1))


def test_fingerprint_rows(spark, docs):
    rows = sorted(queries.op10_simhash(spark, SF).collect(), key=lambda r: r.doc_id)
    fps = [slow_fingerprint(docs[r.doc_id].text) for r in rows]
    assert [r.fingerprint for r in rows] == [f"{f:016x}" for f in fps]
    assert [r.component_id for r in rows] == [rows[k].doc_id for k in slow_components(fps)]


def test_viterbi_against_all_paths():
    """Best score of every path by enumeration, and blocks of any size against the whole."""
    rng = np.random.default_rng(9)
    features = [f"{r}|{g}|{k}|{e}" for r in ("-", "user", "assistant") for g in ("first", "gap", "on") for k in ("short", "long") for e in "?."]
    emits = {(s, f): int(n) for s in range(chat_format.STATES) for f in features if (n := rng.integers(0, 30))}
    steps = {(s, t): int(rng.integers(1, 50)) for s in range(chat_format.STATES) for t in range(chat_format.STATES)}
    model = chat_format.Model({0: 3, 2: 9, 4: 1}, steps, emits)

    def score(path, seen):
        return model.start[path[0]] + seen[0][path[0]] + sum(model.step[a, b] + seen[i][b] for i, (a, b) in enumerate(zip(path, path[1:]), 1))

    def decoded(shown, block):
        parts = [shown[i:i + block] for i in range(0, len(shown), block)]
        sums = [{"conv": 1, "block": i, "first": model.seen(p[:1])[0].tolist(), "matrix": model.summed(model.seen(p[1:])).ravel().tolist()}
                for i, p in enumerate(parts)]
        out = []
        for p, (_, _, entry, leave, _) in zip(parts, chat_format._chain(sums, model)):
            out += model.path(model.seen(p), entry, leave)
        return out

    for _ in range(25):
        shown = [features[i] for i in rng.integers(len(features), size=5)]
        seen = model.seen(shown)
        with np.errstate(invalid="ignore"):
            best = max(score(p, seen) for p in product(range(chat_format.STATES), repeat=5))
        for block in (1, 2, 3, 5):
            assert score(decoded(shown, block), seen) == pytest.approx(best)
    shown = [features[i] for i in rng.integers(len(features), size=400)]
    whole = score(decoded(shown, 400), model.seen(shown))
    assert all(score(decoded(shown, b), model.seen(shown)) == pytest.approx(whole) for b in (7, 64, 399))
