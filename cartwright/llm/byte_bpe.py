"""Byte-level BPE encoding and decoding on arrays.

Pre-tokenisation runs without regular expressions. Every code point of a batch
of texts gets a symbol (its class, with what follows it folded in), every symbol
is a transition function of a small automaton, and an associative scan over the
composition of those functions gives the state before each code point, hence
where pieces begin. Pieces are told apart by a 64-bit hash (checked by length
and bytes), so each distinct piece of a batch is merged once; merges of all new
short pieces advance together, one rank lookup for all pairs at a time, and
results are kept in a bounded cache. Ids are laid out by array gathers, piece
offsets are kept for decoding, which is a gather of token bytes.

Defined results: null and empty texts have no ids and decode to no bytes. Texts
of any length are processed whole, alone in their batch if long.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache, partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.store import fresh

# states of the automaton: what the last code point left open
FRESH, LETTERS, NUMBERS, OTHERS, BLANKS, PREFIX, NEED_ONE, NEED_TWO = range(8)
# symbols: letter, number, other, apostrophe before a one- or two-letter ending, blank with
# a blank or nothing behind it, last space before a word, other last blank before a word, start of a text
LETTER, NUMBER, OTHER, SHORT, LONG, BLANK, SPACE, BREAK, START = range(9)
# The endings that an apostrophe can begin.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")
# White space, first and last code points of its ranges.
WHITE = ((0x9, 0xD), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029),
         (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
TEXT_BATCH = 1 << 20
CACHE = 1 << 20
LONG_PIECE = 64


def _step(symbol: int, state: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins at this code point."""
    if symbol == START:
        return FRESH, False
    if symbol == LETTER:
        if state == NEED_ONE:
            return FRESH, False
        if state == NEED_TWO:
            return NEED_ONE, False
        return LETTERS, state not in (LETTERS, PREFIX)
    if symbol == NUMBER:
        return NUMBERS, state not in (NUMBERS, PREFIX)
    if symbol in (OTHER, SHORT, LONG):
        if state in (OTHERS, PREFIX):
            return OTHERS, False
        return {OTHER: OTHERS, SHORT: NEED_ONE, LONG: NEED_TWO}[symbol], True
    if symbol == BLANK:
        return BLANKS, state != BLANKS
    return (PREFIX if symbol == SPACE else FRESH), True


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function id of each symbol, product table of the functions, their value at FRESH, and begins[symbol, state]."""
    base = [tuple(_step(symbol, s)[0] for s in range(8)) for symbol in range(9)]
    functions = list(dict.fromkeys(base))
    index = {f: i for i, f in enumerate(functions)}
    for f in functions:  # grows while it is read, until closed under composition
        for g in base:
            both = tuple(g[f[s]] for s in range(8))
            if both not in index:
                index[both] = len(functions)
                functions.append(both)
    product = np.array([[index[tuple(g[f[s]] for s in range(8))] for g in functions] for f in functions], np.uint8)
    begins = np.array([[_step(symbol, s)[1] for s in range(8)] for symbol in range(9)])
    return (np.array([index[f] for f in base], np.uint8), product,
            np.array([f[FRESH] for f in functions], np.uint8), begins)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or BLANK for every code point.

    Unicode versions differ about new code points, so letters and numbers are
    asked from the Unicode tables of the tokenizer library that is to be matched.
    """
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        for i in range(0, len(points), 1 << 14):
            found = bytes(probe.encode_ordinary(points[i:i + (1 << 14)])).decode()
            table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    for first, last in WHITE:
        table[first:last + 1] = BLANK
    return table


def scan(functions: np.ndarray, product: np.ndarray, width: int = 64) -> np.ndarray:
    """Inclusive scan of function composition: rows of ``width`` in lockstep, then the rows' totals."""
    n = len(functions)
    if n <= width:
        out = functions.copy()
        for i in range(1, n):
            out[i] = product[out[i - 1], out[i]]
        return out
    full = -(-n // width)
    padded = np.zeros(full * width, np.uint8)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(full, width).T)
    for i in range(1, width):
        columns[i] = product[columns[i - 1], columns[i]]
    before = scan(columns[-1], product, width)[:-1]
    columns[:, 1:] = product[before[None, :], columns[:, 1:]]
    return np.ascontiguousarray(columns.T).reshape(-1)[:n]


def piece_starts(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces begin. ``codes`` holds texts, each behind one separator at ``starts``."""
    to_function, product, at_fresh, begins = automaton()
    symbol = classes()[codes]
    symbol[starts] = START
    n = len(codes)

    def ahead(a: np.ndarray, k: int, fill) -> np.ndarray:
        out = np.full(n, fill, a.dtype)
        out[:n - k] = a[k:]
        return out

    following = ahead(symbol, 1, START)
    last = (symbol == BLANK) & (following != BLANK) & (following != START)
    marks = np.flatnonzero((codes == 39) & (symbol == OTHER) & (following == LETTER))
    one, two = np.append(codes, [0, 0])[marks + 1], np.append(codes, [0, 0])[marks + 2]
    inside = np.append(symbol, [START, START])[marks + 2] != START
    for ending in ENDINGS:
        hit = one == ord(ending[0])
        if len(ending) == 2:
            hit &= inside & (two == ord(ending[1]))
        symbol[marks[hit]] = SHORT if len(ending) == 1 else LONG
    symbol[last] = np.where(codes[last] == 32, SPACE, BREAK)
    after = at_fresh[scan(to_function[symbol], product)]
    state = np.concatenate(([FRESH], after[:-1])).astype(np.uint8)
    return np.flatnonzero(begins[symbol, state])


def ragged(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices offsets[i], offsets[i] + 1, ... (lengths[i] of them) for all i, in a row."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(offsets - (ends - lengths), lengths)


class Coder:
    """Ranks of one vocabulary with its merge table, flat token bytes and a cache of merged pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        token = [b""] * size
        for b, r in ranks.items():
            token[r] = b
        self.lengths = np.array([len(b) for b in token], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(token), np.uint8)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for b, r in ranks.items():
            for i in range(1, len(b)):
                left, right = ranks.get(b[:i]), ranks.get(b[i:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = r
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self.cache: dict[bytes, np.ndarray] = {}

    NONE = np.int64(1) << 40

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], self.NONE)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """One piece by a heap of pairs over a linked list."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (r := self.pairs.get(rank << 32 | ids[nxt[i]])) is not None:
                    heapq.heappush(heap, (r, i, rank, ids[nxt[i]]))
            if prv[i] >= 0 and (r := self.pairs.get(ids[prv[i]] << 32 | rank)) is not None:
                heapq.heappush(heap, (r, prv[i], ids[prv[i]], rank))
        return np.array([x for x in ids if x >= 0], np.uint32)

    def _merge_short(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Pieces of much the same length together: one merge a round in each piece that has one left."""
        count, width = len(pieces), max(map(len, pieces))
        sizes = np.array([len(p) for p in pieces])
        ids = np.full((count, width), -1, np.int64)
        ids[np.arange(width)[None, :] < sizes[:, None]] = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((count, width), self.NONE)
        has = np.arange(width - 1)[None, :] < (sizes - 1)[:, None]
        rank[:, :-1][has] = self._rank(ids[:, :-1][has], ids[:, 1:][has])
        out, who = ids.copy(), np.arange(count)
        while len(who):
            at = rank.argmin(axis=1)
            row = np.arange(len(who))
            best = rank[row, at]
            done = best == self.NONE
            if done.any():
                out[who[done]] = ids[done]
                go = ~done
                who, ids, rank, sizes, at, best = who[go], ids[go], rank[go], sizes[go], at[go], best[go]
                if not len(who):
                    break
                row = np.arange(len(who))
            ids[row, at] = best
            column = np.arange(width)[None, :]
            behind = column > at[:, None]
            ids = np.where(behind, np.pad(ids[:, 1:], ((0, 0), (0, 1)), constant_values=-1), ids)
            rank = np.where(behind, np.pad(rank[:, 1:], ((0, 0), (0, 1)), constant_values=self.NONE), rank)
            sizes = sizes - 1
            right = at + 1 < sizes
            rank[row, at] = self.NONE
            rank[row[right], at[right]] = self._rank(ids[row[right], at[right]], ids[row[right], at[right] + 1])
            left = at > 0
            rank[row[left], at[left] - 1] = self._rank(ids[row[left], at[left] - 1], ids[row[left], at[left]])
        return [r[r >= 0].astype(np.uint32) for r in out]

    def merged(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; whole-piece entries of the vocabulary come first."""
        if len(self.cache) > CACHE:
            self.cache.clear()
        cache, ranks, by_length = self.cache, self.ranks, {}
        for p in pieces:
            if p in cache:
                continue
            if (r := ranks.get(p)) is not None:
                cache[p] = np.array([r], np.uint32)
            elif len(p) > LONG_PIECE:
                cache[p] = self._merge_long(p)
            else:
                by_length.setdefault((len(p) - 1) // 4, []).append(p)
        for group in by_length.values():
            for i in range(0, len(group), 1 << 14):
                part = group[i:i + (1 << 14)]
                cache.update(zip(part, self._merge_short(part)))
        return [cache[p] for p in pieces]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text, byte offsets of the pieces' begins)."""
        joined = "\0" + "\0".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        begin = piece_starts(codes, starts)
        width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        to_byte = np.concatenate(([0], np.cumsum(width)))
        raw = joined.encode()
        # a piece ends where the next begins, or at the separator before the next text
        marks = np.sort(np.concatenate((begin, starts)))
        ends = np.append(marks, len(codes))[np.searchsorted(marks, begin) + 1]
        first, last = to_byte[begin], to_byte[ends]
        which, distinct = self._distinct(raw, first, last)
        merged = self.merged(distinct)
        lengths = np.array([len(m) for m in merged], np.int64)
        flat = np.concatenate(merged) if merged else np.empty(0, np.uint32)
        ids = flat[ragged((np.cumsum(lengths) - lengths)[which], lengths[which])]
        owner = np.searchsorted(starts, begin, side="right") - 1
        counts = np.bincount(owner, weights=lengths[which], minlength=len(texts)).astype(np.int64)
        return ids, counts, first

    @staticmethod
    def _hashes(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A hash of the length and the first ``LONG_PIECE`` bytes of every slice."""
        hashes = size.astype(np.uint64)
        base = np.uint64(0x9E3779B97F4A7C15)
        live = np.arange(len(first))
        step = 0
        while len(live):  # one byte of every slice that is so long
            hashes[live] = (hashes[live] ^ data[first[live] + step].astype(np.uint64)) * base
            hashes[live] ^= hashes[live] >> np.uint64(29)
            step += 1
            live = live[size[live] > step] if step <= LONG_PIECE else live[:0]
        return hashes

    @classmethod
    def _distinct(cls, raw: bytes, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """Index of each slice among the distinct ones, and those; equal hashes are told apart by their bytes."""
        if not len(first):
            return np.empty(0, np.int64), []
        data = np.frombuffer(raw, np.uint8)
        size = last - first
        _, at, which = np.unique(cls._hashes(data, first, size), return_index=True, return_inverse=True)
        same = (size == size[at][which]) & (size <= LONG_PIECE)
        # every short slice against the one that stands for its hash
        short = np.flatnonzero(same & (at[which] != np.arange(len(first))))
        if len(short):
            apart = data[ragged(first[short], size[short])] != data[ragged(first[at[which[short]]], size[short])]
            starts = np.cumsum(size[short]) - size[short]
            same[short[np.logical_or.reduceat(apart, starts)]] = False
        others = np.flatnonzero(~same)
        distinct = [raw[a:b] for a, b in zip(first[at].tolist(), last[at].tolist())]
        if len(others):  # hashed by their beginnings only, or alike in their hash alone
            seen: dict[bytes, int] = {}
            for i in others.tolist():
                piece = raw[first[i]:last[i]]
                if piece not in seen:
                    seen[piece] = len(distinct)
                    distinct.append(piece)
                which[i] = seen[piece]
        return which, distinct

    def decode(self, ids: np.ndarray) -> bytes:
        return self.flat[ragged(self.offsets[ids], self.lengths[ids])].tobytes()


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    return Coder(read_ranks(path))


def batches_of(texts: list[str | None], limit: int = TEXT_BATCH) -> Iterator[list[str]]:
    """Texts in order, in lists of about ``limit`` characters."""
    held, size = [], 0
    for t in texts:
        t = t or ""
        if held and size + len(t) > limit:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t) + 1
    if held:
        yield held


def _coded(batches: Iterator[pa.RecordBatch], path: str, digests: bool) -> Iterator[pa.RecordBatch]:
    machine = coder(path)
    for batch in batches:
        at = 0
        for texts in batches_of([t.as_py() for t in batch.column(batch.num_columns - 1)]):
            ids, counts, _ = machine.encode(texts)
            ends = np.cumsum(counts)
            of_text = [ids[e - n:e] for e, n in zip(ends.tolist(), counts.tolist())]
            decoded = [machine.decode(x) for x in of_text]
            if digests:
                made = [pa.array([sha256(id_bytes(x)).hexdigest() for x in of_text], pa.string()),
                        pa.array([sha256(x).hexdigest() for x in decoded], pa.string())]
            else:
                made = [pa.array(of_text, pa.list_(pa.int64())), pa.array(decoded, pa.binary())]
            rows = batch.slice(at, len(texts)).drop_columns([batch.schema.names[-1]])
            at += len(texts)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(counts, pa.int64()), *made],
                                             names=[*rows.schema.names, "n_tokens", *OUTPUT[digests]])


OUTPUT = {False: ("ids", "decoded"), True: ("ids_sha256", "decoded_sha256")}


def _apply(docs: DataFrame, path: str, text: str, digests: bool) -> DataFrame:
    columns = [c for c in docs.columns if c not in ("n_tokens", *OUTPUT[digests], text)]
    kept = docs.select(*[F.col(f"`{c}`") for c in columns], F.col(text).alias(fresh("text", columns)))
    kinds = ("string", "string") if digests else ("array<long>", "binary")
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1]]
    schema += ["n_tokens long", *(f"{c} {k}" for c, k in zip(OUTPUT[digests], kinds))]
    return kept.mapInArrow(partial(_coded, path=path, digests=digests), ", ".join(schema))


def encode_texts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every row without ``text``, with ``n_tokens``, ``ids`` and ``decoded`` (the bytes that the ids stand for).

    Input columns named like an added one are replaced.
    """
    return _apply(docs, path, text, digests=False)


def coded_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Like ``encode_texts``, with the SHA-256 of the ids (little-endian, 32 bits) and of the decoded bytes."""
    return _apply(docs, path, text, digests=True)


def id_bytes(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()
