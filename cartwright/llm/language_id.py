"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (1 to 3 letters, words padded
with blanks, letters in lower case) of a language. A text is compared to every
profile by the out-of-place distance: the sum of rank differences of its own most
frequent n-grams, with the full profile length for n-grams that a profile lacks.
The smallest distance wins, ties go to the language that sorts first.

Profiles are learned from a bounded sample of labelled rows: for each language rows
whose seeded hash of the key is below a threshold that ``per_language`` rows are
expected to meet. Held out are
rows whose crc32 of the key, as text, is 2 modulo 4; nothing is learned from
them. Every row is predicted from its whole text and nothing else.

Defined results: ``lang_pred`` is ``und`` with score 0 for a null text, a text
without a letter, and where nothing could be learned. A null key counts as not
held out and is not learned from. The score is 1 minus the distance over the
largest possible one. Repeated rows are predicted one by one. Input columns named
like an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
PROFILE = 400
PER_LANGUAGE = 2000
SEED = 7
CHUNK = 1 << 20


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@lru_cache(maxsize=1)
def _fold() -> np.ndarray:
    """Lower-case letter of every code point, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low[0])
    return table


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text (up to three 21-bit code points in a number) with their counts."""
    found, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    if not text:
        return found, counts
    codes = _fold()[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    if not codes.any():
        return found, counts
    codes = np.concatenate(([0], codes, [0])).astype(np.uint64)
    codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]  # one blank between words
    blank = np.uint64(0x20)
    codes[codes == 0] = blank
    for i in range(0, len(codes), CHUNK):
        part = codes[i:i + CHUNK + 2]
        one = part[:CHUNK]
        two = part[:-1][:CHUNK] << np.uint64(21) | part[1:][:CHUNK]
        middle = part[1:-1][:CHUNK]
        three = part[:-2][:CHUNK] << np.uint64(42) | middle << np.uint64(21) | part[2:][:CHUNK]
        keys, n = np.unique(np.concatenate((one[one != blank], two, three[middle != blank])), return_counts=True)
        if len(found):
            keys, where = np.unique(np.concatenate((found, keys)), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate((counts, n)), minlength=len(keys)).astype(np.int64)
        found, counts = keys, n
    return found, counts


def top(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent keys, ties to the smaller key."""
    if len(keys) > 4 * size:  # all that can be among them
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.argsort(-counts, kind="stable")[:size]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_lang: dict[str, list] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            by_lang.setdefault(lang, []).append(ngrams(text.as_py()))
        for lang, parts in by_lang.items():
            keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(where, weights=np.concatenate([c for _, c in parts]), minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])


def _threshold(share: float) -> int:
    return (1 << 63) - 1 if share >= 1 else int(share * (1 << 64)) - (1 << 63)


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = PER_LANGUAGE, size: int = PROFILE) -> dict[str, list[int]]:
    """Profile (n-grams by rank) of each language that has a letter in its sampled rows."""
    rows = docs.select(F.xxhash64(F.lit(SEED), F.col(key)).alias("h"), F.col(lang).alias("lang"), F.col(text).alias("text"),
                       F.col(key).alias("key")).where(F.col("lang").isNotNull() & F.col("key").isNotNull()
                                                      & F.col("text").isNotNull() & ~held_out(F.col("key")))
    found = rows.groupBy("lang").count().collect()  # one short row per language
    if not found:
        return {}
    # hashes are uniform, so a threshold takes about ``per_language`` rows of each language
    limits = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], _threshold(per_language / r["count"]))])
    sample = rows.where(F.col("h") <= F.element_at(limits, F.col("lang"))).select("lang", "text")
    totals = sample.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = totals.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    profiles: dict[str, list[int]] = {}
    for r in ranked.where(F.col("r") <= size).orderBy("lang", "r").collect():
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


class Profiles:
    """All profiles as one sorted list of n-grams with their ranks in each language."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.uint64)
        self.ranks = np.full((len(self.grams), len(self.langs)), size, np.int64)
        for i, lang in enumerate(self.langs):
            at = np.searchsorted(self.grams, np.array(profiles[lang], np.uint64))
            self.ranks[at, i] = np.arange(len(at))

    def predict(self, text: str | None) -> tuple[str, float]:
        keys, counts = ngrams(text)
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0
        own = top(keys, counts, self.size)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        apart = np.abs(self.ranks[at[known]] - np.arange(len(own))[known, None])
        # an n-gram that a profile lacks costs the full length, whatever its own rank
        apart = np.where(self.ranks[at[known]] == self.size, self.size, apart).sum(axis=0)
        distance = apart + self.size * int((~known).sum())
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(own)))


def _predict(batches: Iterator[pa.RecordBatch], profiles: dict[str, list[int]], size: int) -> Iterator[pa.RecordBatch]:
    model = Profiles(profiles, size)
    for batch in batches:
        made = [model.predict(t.as_py()) for t in batch.column("text")]
        rows = batch.drop_columns(["text"])
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
            names=[*rows.schema.names, "lang_pred", "score"])


ADDED = ("held_out", "lang_pred", "score")


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
               per_language: int = PER_LANGUAGE, size: int = PROFILE, carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the input columns, or of those in ``carry``), held_out, lang_pred and score."""
    profiles = learn(docs, key, text, lang, per_language, size)
    columns = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), held_out(F.col(key)).alias("held_out"),
                       F.col(text).alias("text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(partial(_predict, profiles=profiles, size=size), schema)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             per_language: int = PER_LANGUAGE, size: int = PROFILE, carry: list[str] | None = None) -> DataFrame:
    """The input columns (or those in ``carry``) with held_out, lang_pred and score."""
    columns = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    return identified(docs, key, text, lang, per_language, size, carry).select(*[F.col(f"row.`{c}`") for c in columns], *ADDED)
