"""SimHash, packing, nearest neighbours, chat parsing and URL rules against brute force."""

import zlib

import numpy as np
import public_tokenizers
import xxhash
from llm_cases import TEXTS, documents
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from cartwright.llm import chat_format, multi_index, packing, queries, simhash, url_filter

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    words = [w for w in words] if (text or "").isascii() else [w for w in "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace(
        "\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def slow_components(fps):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_simhash_rows(spark):
    got = simhash.near_duplicates(documents(spark, clashes=True)).collect()
    assert len(got) == len(TEXTS)
    fps = [slow_fingerprint(t) for _, t, _ in TEXTS]
    assert sorted(r.fp & (2**64 - 1) for r in got) == sorted(fps)
    labels = slow_components(fps)
    least = {k: min((i for (i, _, _), x in zip(TEXTS, labels) if x == k and i is not None), default=None) for k in set(labels)}
    assert sorted(map(str, ((r.id, r.component_id) for r in got))) == sorted(
        map(str, ((i, least[x]) for (i, _, _), x in zip(TEXTS, labels))))


def test_simhash_large_groups(spark):
    """More than GROUP fingerprints below one key: cut again, same components as brute force."""
    rng = np.random.default_rng(2)
    base = int(rng.integers(1 << 62))
    fps = {base ^ sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 7), replace=False)) for _ in range(900)}
    fps |= {int(x) for x in rng.integers(1 << 62, size=300)}
    fps = sorted(fps)
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    stars = {r.a: r.b for r in simhash.components(edges).collect()}
    want = slow_components(fps)
    assert [stars.get(f, f) for f in fps] == [fps[k] for k in want]


def test_simhash_dense_second_key():
    rng = np.random.default_rng(3)
    key = simhash_key = 5 << 32 | 0xABCD0000  # half 0, position 5
    second = key << 21 | 0 << 20 | 3 << 16 | 0x1230
    bits = simhash.free_bits(second)
    members = np.unique(np.array([sum(1 << b for b in bits if rng.random() < 0.1) for _ in range(600)], np.uint64))
    star = dict(simhash.flipped_edges(second, members))
    want = slow_components([int(m) for m in members])
    groups = {}
    for m, k in zip(members, want):
        groups.setdefault(k, set()).add(star.get(int(m), int(m)))
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)
    assert simhash_key


def test_packing(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = Tokenizer.from_file(path)
    rows = TEXTS + [(50 + i, f"some text number {i} " * (i % 90), "en") for i in range(150)]
    got = packing.pack(documents(spark, rows, clashes=True), path, ids_too=True).collect()
    by_sequence = {}
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.crc and len(r.ids) == r.length <= 1024
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    want = []
    for i, t, _ in rows:
        ids = coder.encode(t or "", add_special_tokens=False).ids + [2]
        want += [(i, p, s, n, ids[s:s + n]) for p, (s, n) in enumerate(packing.cut(len(ids), 1024))]
    assert sorted(map(str, want)) == sorted(str((r.id, r.piece, r.start, r.length, r.ids)) for r in got)
    total = sum(r.length for r in got)
    assert len(by_sequence) <= -(-total // 1024) + 2
    assert packing.pack(documents(spark, []), path).count() == 0


def test_packing_ids_equal_the_tokenizers_library():
    import random

    path = public_tokenizers.path("byte_bpe_50k.json")
    slow, fast, rng = Tokenizer.from_file(path), packing.encoder(path), random.Random(3)
    parts = ["'", "s", "re", "ll", " ", "  ", "\n", "\t", "\u00a0", "1", "\u00b2", "a", "é", "中", "!", "#", "\0", "\u0301", "<|endoftext|>", "hello", "\x85"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert fast.encode(text, allowed_special="all") == slow.encode(text, add_special_tokens=False).ids


def test_cut():
    assert packing.cut(1024, 1024) == [(0, 1024)]
    assert packing.cut(1025, 1024) == [(0, 1), (1, 1024)]
    assert packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)]


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    vectors = [rng.normal(size=8).round(2).tolist() for _ in range(300)]
    hot = vectors[0]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(1000 + i, hot) for i in range(200)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] + [1.0] * 7), (2060, [None] + [1.0] * 7), (2080, [1.0] * 7), (None, hot), (1, vectors[1])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], T.StructType(
        [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.StringType())]))
    got = {}
    for r in multi_index.search(table, table.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and (i < 2000)}
    assert set(got) == {i for i in good if i % 20 == 0}
    for q, found in got.items():
        scores = {i: float(v @ good[q]) for i, v in good.items() if i != q}
        want = sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:20]
        assert [v for _, v, _ in sorted(found)] == want
        assert all(abs(s - scores[v]) < 1e-12 for _, v, s in found)
    assert multi_index.search(table.limit(0), table.limit(0)).count() == 0


def test_neighbours_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = table.collect()
    m, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    got = {}
    index = multi_index.Index(least_budget=100)
    for r in multi_index.search(table, table.where("vec_id % 20 = 0"), index=index).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q, found in got.items():
        s = m @ m[ids == q][0]
        s[ids == q] = -9
        hits += len(found & set(ids[np.argsort(-s)[:20]].tolist()))
    assert hits / (20 * len(got)) >= 0.9


def test_visit_order():
    """The heap visits cells in the order of their summed distance."""
    rng = np.random.default_rng(0)
    books, q = (rng.normal(size=(7, 2)), rng.normal(size=(6, 2))), rng.normal(size=4)
    first, second = multi_index.distances(q, books)
    want = sorted(((first[i] + second[j]), (i, j)) for i in range(7) for j in range(6))
    assert [(i, j) for _, i, j in multi_index.visited(first, second, 30)] == [c for _, c in want[:30]]
    assert len(list(multi_index.visited(first, second, 99))) == 42
    for n in (1, 17, 42):
        assert multi_index.reach(first, second, n) == want[n - 1][0]


def test_index_grows_without_a_table_of_cells(spark):
    """More centroids than the old bound, hot rows cut into blocks, and the recall that was asked for."""
    rng = np.random.default_rng(4)
    book = rng.normal(size=(600, 3))
    sizes = rng.integers(0, 50, size=600)
    sizes[17] = 10_000
    groups = multi_index.grouped(book, sizes, 1000)
    held = np.bincount(groups.of, weights=sizes)
    assert groups.blocks[groups.of[17]] >= 10 and (held <= 1000).sum() >= len(held) - 1
    assert (groups.blocks == np.maximum(1, -(-held // 1000))).all()


def conversation_rows(turns):
    return [(c, i, ROLE[i % 2], f"line {i} of {c}\nmore of it") for c, n in turns for i in range(n)]


ROLE = ("user", "assistant")


def test_chat(spark):
    rows = conversation_rows([(k, 2 + k % 5) for k in range(60)])
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat_format.raw_transcripts(table)
    model = chat_format.learn(chat_format.lines(pieces, "conv_id", "turn", "text", carry="role"))
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in chat_format.parse(pieces.drop("role"), model).collect()}
    assert got == {(c, t): (r, x) for c, t, r, x in rows}
    # blocks give the same result as one run over the whole conversation
    long = spark.createDataFrame(conversation_rows([(1, 40)]), "conv_id long, turn long, role string, text string")
    raw = chat_format.raw_transcripts(long).drop("role")
    whole = [(r.turn, r.role, r.text) for r in chat_format.parse(raw, model).collect()]
    stretched = raw.withColumn("turn", raw.turn * 1000)
    blocks = chat_format.parse(stretched, model).collect()
    assert len({r.part for r in blocks}) >= 1
    assert sorted(whole) == sorted((r.turn, r.role, r.text) for r in blocks)
    odd = spark.createDataFrame([(None, None, None), (5, None, "Q: hi"), (5, 1, None), (5, 1, ""), (5, 1, "")], "conv_id long, turn long, text string")
    assert chat_format.parse(odd, model).count() >= 2
    assert chat_format.parse(odd.limit(0), model).count() == 0


def test_urls(spark):
    urls = [None, "", "no scheme casino", "http://", "http://A.Example.ORG/es/x", "http://example.org/en/12", "http://example.org/en/2",
            "http://x.com/fr/1", "http://x.com/de/1?casino", "http://org", "http://a.org/", "http://cheap-pills.net/", "http://cheap.net/cheap",
            "http://casinos.net/", "http://x.net/a?q=casino#t", "http://essex.net/adsorb", "ftp://h.net?x://y.org/"]
    table = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, row string, u string")
    got = {r.page_id: r for r in url_filter.filter_urls(table).collect()}
    verdicts = {urls[i]: (r.host, r.path, r.rule, r.verdict) for i, r in got.items()}
    assert verdicts[None] == ("", "", None, "allow") and verdicts["no scheme casino"] == ("", "", None, "block")
    assert verdicts["http://A.Example.ORG/es/x"] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert verdicts["http://example.org/en/12"][2:] == ("example.org/en/1", "block")
    assert verdicts["http://example.org/en/2"][2:] == ("org/", "allow")
    assert verdicts["http://x.com/fr/1"][2:] == ("com/fr/", "allow") and verdicts["http://x.com/de/1?casino"][2:] == ("com/de/", "block")
    assert verdicts["http://org"][2:] == (None, "allow") and verdicts["http://a.org/"][2:] == ("org/", "allow")
    assert verdicts["http://cheap-pills.net/"][3] == "block" and verdicts["http://cheap.net/cheap"][3] == "allow"
    assert verdicts["http://casinos.net/"][3] == "allow" and verdicts["http://x.net/a?q=casino#t"][3] == "block"
    assert verdicts["http://essex.net/adsorb"][3] == "allow" and verdicts["ftp://h.net?x://y.org/"][0] == "h.net"


def test_pipeline_stages(spark):
    good = "Many words stand here and the text of document {} goes on for a while with the usual prose."
    rows = [(i, good.format(f"number {i} " + " ".join(f"{w}{i}" for w in "alpha beta gamma delta epsilon zeta eta theta".split())), "en") for i in range(1, 9)]
    rows += [(20, rows[0][1], "en"), (21, None, "en"), (22, "short", "en"), (23, "1 2 3 4 5 6 7 8 9 10 11 12 13", "en"), (None, rows[1][1], "en"),
             (3, rows[2][1], "en")]
    docs = documents(spark, rows, clashes=True)
    names = docs.columns
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == names and {r.doc_id for r in kept.collect()} == {*range(1, 9), 20, 23, None}
    spoken = corpus_pipeline.language(spark, kept, SF)
    assert spoken.columns == names and {r.doc_id for r in spoken.collect()} == {*range(1, 9), 20, None}
    single = corpus_pipeline.near_dedup(spark, spoken, SF)
    fps = {i: slow_fingerprint(t) for i, t, _ in rows if i in range(1, 9)}
    labels = slow_components([fps[i] for i in sorted(fps)])
    assert single.columns == names and sorted(r.doc_id for r in single.collect()) == [sorted(fps)[k] for k in sorted(set(labels))]
    packed = corpus_pipeline.pack(spark, single, SF)
    assert {r.doc_id for r in packed.collect()} == {sorted(fps)[k] for k in set(labels)}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert set(queries.registered()) >= {f"op{n}_{x}" for n, x in ((1, "quality_rules"), (10, "simhash"))}
