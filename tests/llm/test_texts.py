"""Quality rules, language ID, license scan, sharding and BPE against brute force on awkward rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_cases import TEXTS, documents
from pyspark.sql import functions as F

from cartwright.llm import byte_bpe, language_id, license_scan, quality_rules, sharding

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("clashes", [False, True])
def test_quality_base_rules(spark, clashes):
    docs = documents(spark, clashes=clashes)
    rows = quality_rules.judge(docs).collect()
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted(base_counts(t) for _, t, _ in TEXTS)
    for r in rows:
        n = base_counts(r.text)
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)


def test_quality_divergence(spark):
    prose = "the cat sat on the mat and was with it for a day in that house by the sea as is "
    rows = [(i, prose * 20 + f"end{i}", "en") for i in range(20)]
    # no window of five words repeats, so only the divergence can reject
    varied = [(100 + i, " ".join(f"{w}{k}" if k % 2 else w for k, w in enumerate((prose * 20).split())), "en") for i in range(20)]
    symbols = [(200, " ".join(f"w{k}$$$###%%%" for k in range(300)), "en")]
    got = {r.doc_id: r for r in quality_rules.judge(documents(spark, rows + varied + symbols)).collect()}
    assert all(got[100 + i].kept for i in range(20))
    assert not got[200].base_failed and not got[200].kept and got[200].char_distance > 0.3


def test_quality_short_texts_are_not_judged(spark):
    got = quality_rules.judge(documents(spark, [(1, "$$$ ### *** %%% &&& ||| <<< >>> $# #$ %% **", "en")])).first()
    assert got.char_distance is None and got.word_distance is None and got.kept


def test_empty_tables(spark):
    none = documents(spark, [])
    assert quality_rules.judge(none).count() == 0
    assert language_id.identify(none).count() == 0
    assert license_scan.scan(none).count() == 0
    assert sharding.external_shuffle(none).count() == 0
    assert byte_bpe.encode_texts(none, MULTI).count() == 0


@pytest.mark.parametrize("clashes", [False, True])
def test_language(spark, clashes):
    rows = TEXTS + [(20 + i, TEXTS[0][1], "en") for i in range(8)] + [(40 + i, TEXTS[6][1], "de") for i in range(8)]
    got = language_id.identify(documents(spark, rows, clashes)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in got if r.text == TEXTS[0][1]} == {"en"}
    assert {r.lang_pred for r in got if r.text == TEXTS[6][1]} == {"de"}


def test_language_brute_force():
    """The array version against counting substrings."""
    text = "Ein Haus, ein Baum: eine Straße. 12 Häuser"
    want = Counter()
    for word in re.findall(r"[^\W\d_]+", text):
        padded = f" {word.lower()} "
        for n in (1, 2, 3):
            want.update(padded[i:i + n] for i in range(len(padded) - n + 1) if padded[i:i + n].strip())
    keys, counts = language_id.ngrams(text)

    def spelled(k):
        return "".join(chr(c) for c in (k >> 42 & 0x1FFFFF, k >> 21 & 0x1FFFFF, k & 0x1FFFFF) if c)

    got = {spelled(int(k)): int(n) for k, n in zip(keys, counts)}
    assert got == dict(want)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_id.identify(docs, carry=["lang"]).where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98


def license_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(label, i) for label, phrase in license_scan.PHRASES for p in [phrase.split()]
              for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    starts = [i for _, i in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for x, _ in places})))


def test_license_base(spark):
    rows = TEXTS + [(30, "MIT license mit LICENSE, the Apache License; GNU General Public License", "en"), (31, "mit l\u0131cense", "en"),
                    (32, "mit\u212a license", "en"), (33, "mit", "en"), (34, "x license mit license", "en")]
    got = license_scan.scan(documents(spark, rows, clashes=True)).collect()
    key = lambda x: tuple("" if v is None else str(v) for v in x)
    assert sorted(map(key, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got))) == sorted(
        map(key, ((i, *license_base(t)) for i, t, _ in rows)))
    assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in got if r.base_labels)


def test_license_diagonals(spark):
    mit = dict(license_scan.TEMPLATES)["mit"].split()
    edited = mit[:10] + ["indeed"] + mit[10:30] + mit[32:]
    rows = [(1, " ".join(edited), "en"), (2, " ".join(mit[:15]), "en"), (3, " ".join(mit[::-1]), "en")]
    got = {r.doc_id: r for r in license_scan.scan(documents(spark, rows)).collect()}
    assert got[1].labels == "mit" and got[1].base_labels == "" and 0.7 <= got[1].score < 1
    assert got[2].labels == "" and got[3].labels == "" and got[3].score == 0


@pytest.mark.parametrize("clashes", [False, True])
def test_sharding(spark, clashes):
    rows = TEXTS + [(1000 + i, "copy", "en") for i in range(300)] + [(77, "same row", "en")] * 200
    docs = documents(spark, rows, clashes).repartition(5)
    placed = sharding.external_shuffle(docs, bucket_bytes=2000).withColumn("grown", sharding.grown(F.col("doc_id"))).collect()
    assert sorted(Counter((r.doc_id, r.text) for r in placed).items(), key=str) == sorted(Counter((i, t) for i, t, _ in rows).items(), key=str)
    by_shard, homes = {}, {}
    for r in placed:
        assert r.size == len((r.text or "").encode()) + 1
        by_shard.setdefault(r.shard, []).append(r.slot)
        homes.setdefault(r.doc_id, set()).add((r.shard, r.grown))
        assert r.grown in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(h) == 1 for h in homes.values())
    assert set(by_shard) == set(range(8))


def test_bpe_rows(spark):
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(MULTI), special_tokens={})
    got = byte_bpe.encode_texts(documents(spark, clashes=True), MULTI).collect()
    want = sorted((coder.encode_ordinary(t or "") for _, t, _ in TEXTS))
    assert sorted(r.ids for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)
    assert sorted(bytes(r.decoded) for r in got) == sorted((t or "").encode() for _, t, _ in TEXTS)
    digests = byte_bpe.coded_digests(documents(spark), MULTI).collect()
    assert sorted(r.ids_sha256 for r in digests) == sorted(hashlib.sha256(np.array(w, "<u4").tobytes()).hexdigest() for w in want)


def test_bpe_strings():
    import random

    rng = random.Random(4)
    parts = ["'", "s", "re", "ll", "d", " ", "  ", "\n", "\t", "\u00a0", "7", "\u00b2", "é", "中", "!", "#", "\U0001F600", "\0", "\x1c", "\u0301", "the"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 16))) for _ in range(4000)] + ["a" * 900, " " * 300, "ab" * 500]
    coder = byte_bpe.coder(MULTI)
    truth = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    ids, counts, _ = coder.encode(texts)
    at = 0
    for t, n in zip(texts, counts):
        assert ids[at:at + n].tolist() == truth.encode_ordinary(t)
        assert coder.decode(ids[at:at + n]) == t.encode()
        at += n
