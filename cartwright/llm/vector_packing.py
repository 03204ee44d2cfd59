"""Vector bin packing of training examples: tokens, segments and loss-bearing tokens at once.

An example is an optional prompt, a text and an end token. Only the text and the end
token bear loss, and the first token of a segment never does, as nothing before it
predicts it. A sequence is limited in all three measures (``Limits``).

The open sequence takes, among the pieces of a pool that fit whole, the one with the
largest dot product of its demand and the room that is left, each measure relative to
its limit and weighted by its mean demand in the pool. A piece that fills the tokens
exactly goes first. Where no piece fits, or one segment is left, the longest prefix
that fits is cut off a piece and the rest goes back to the pool. A sequence that other limits or
the end of the pool leave short of its tokens is cut back to a power of two, the sizes that need no
padding, so no sequence is padded at all.

Every task packs its own part of the input from a pool of bounded size, without a
shuffle; it holds the ids of ``POOL`` pieces and of one document. What is left of a task's
pool, less than one sequence, is written and packed by a second, much smaller job.

Defined results: a null text or prompt counts as empty, so an empty row is its end token
alone; a text of any length is cut into whole sequences first; repeated rows are
packed each; a null id passes through; an empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.packing import encode
from cartwright.llm.store import saved

END = 1
POOL = 2048
#: a prefix shorter than this is cut off only where it fills the sequence
LEAST_CUT = 16
#: tokens of leftovers that one task of the second job packs
LEFT_TOKENS = 1 << 20
BATCH = 4096


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most; ``tokens`` is a power of two."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass(frozen=True)
class Document:
    """Ids from position ``base`` on; those before ``answer`` belong to the prompt."""

    key: int | None
    ids: np.ndarray
    base: int
    answer: int
    total: int


@dataclass
class Pool:
    """Pieces (document, start, end) that wait for a place, as parallel arrays."""

    limits: Limits
    n: int = 0
    docs: list[Document] = field(default_factory=list)
    start: np.ndarray = field(default_factory=lambda: np.empty(64, np.int64))
    tokens: np.ndarray = field(default_factory=lambda: np.empty(64, np.int64))
    free: np.ndarray = field(default_factory=lambda: np.empty(64, np.int64))

    def add(self, doc: Document, start: int, end: int) -> None:
        if self.n == len(self.start):
            for name in ("start", "tokens", "free"):
                setattr(self, name, np.concatenate((getattr(self, name), np.empty(self.n, np.int64))))
        i, self.n = self.n, self.n + 1
        self.docs.append(doc)
        # ``free``: leading tokens that bear no loss
        self.start[i], self.tokens[i], self.free[i] = start, end - start, min(max(1, doc.answer - start), end - start)

    def take(self, i: int) -> tuple[Document, int, int]:
        out = self.docs[i], int(self.start[i]), int(self.start[i] + self.tokens[i])
        last = self.n = self.n - 1
        self.docs[i] = self.docs[last]
        self.docs.pop()
        for a in (self.start, self.tokens, self.free):
            a[i] = a[last]
        return out

    def best_whole(self, room: tuple[int, int, int]) -> int | None:
        """The piece with the largest weighted dot product among those that fit whole."""
        tokens, loss = self.tokens[: self.n], self.tokens[: self.n] - self.free[: self.n]
        fits = (tokens <= room[0]) & (loss <= room[2])
        exact = fits & (tokens == room[0])
        if exact.any():
            return int(exact.argmax())
        if not fits.any():
            return None
        limits = self.limits
        # demand and room relative to the limits; the one segment of a piece is the same for all
        by_tokens = tokens.mean() / limits.tokens * room[0] / limits.tokens / limits.tokens
        by_loss = loss.mean() / limits.loss * room[2] / limits.loss / limits.loss
        return int(np.where(fits, by_tokens * tokens + by_loss * loss, -1.0).argmax())

    def best_prefix(self, room: tuple[int, int, int]) -> tuple[int, int]:
        """(piece, length): the longest prefix that fits, cut off the longest such piece."""
        tokens = self.tokens[: self.n]
        length = np.minimum(np.minimum(tokens, room[0]), self.free[: self.n] + room[2])
        i = int((length * (self.limits.tokens * 2) + np.minimum(tokens, self.limits.tokens)).argmax())
        return i, int(length[i])


def sequence(pool: Pool) -> list[tuple[Document, int, int]]:
    """Fill one sequence from a pool that is not empty."""
    limits = pool.limits
    room = limits.tokens, limits.segments, limits.loss
    placed: list[tuple[Document, int, int]] = []

    def place(piece: tuple[Document, int, int]) -> None:
        nonlocal room
        doc, a, b = piece
        placed.append(piece)
        room = room[0] - (b - a), room[1] - 1, room[2] - max(0, b - max(a + 1, doc.answer))

    while room[0] and room[1] and pool.n:
        i = pool.best_whole(room)
        if i is None or (room[1] == 1 and pool.tokens[i] < room[0]):
            j, length = pool.best_prefix(room)
            if length < min(LEAST_CUT, room[0]) and placed and i is None:
                break
            if length < pool.tokens[j]:
                doc, a, b = pool.take(j)
                pool.add(doc, a + length, b)
                place((doc, a, a + length))
                continue
            i = j
        place(pool.take(i))
    total = limits.tokens - room[0]
    surplus = total - (1 << (total.bit_length() - 1))
    while surplus:
        doc, a, b = placed.pop()
        keep = max(0, b - a - surplus)
        surplus -= b - a - keep
        pool.add(doc, a + keep, b)
        if keep:
            placed.append((doc, a, a + keep))
    return placed


def whole_sequences(doc: Document, limits: Limits) -> Iterator[tuple[int, int, bool]]:
    """(start, end, full): the document cut where a sequence of its own would reach a limit."""
    a = doc.base
    while a < doc.total:
        b = min(doc.total, a + limits.tokens, max(a + 1, doc.answer) + limits.loss)
        yield a, b, b - a == limits.tokens
        a = b


def _documents(batch: pa.RecordBatch, path: str) -> Iterator[Document]:
    for key, prompt, text in zip(batch.column("id").to_pylist(), batch.column("_prompt"), batch.column("_text")):
        before = encode(path, prompt.as_py() or "") if prompt.is_valid else []
        ids = np.array(before + encode(path, text.as_py() or "") + [END], "<u4")
        yield Document(key, ids, 0, len(before), len(ids))


def _leftovers(batch: pa.RecordBatch) -> Iterator[Document]:
    for r in batch.to_pylist():
        yield Document(r["id"], np.frombuffer(r["ids"], "<u4"), r["start"], r["answer"], r["doc_tokens"])


ROW = ("id long, start long, length long, crc long, doc_tokens long, loss long, sequence_id long, offset long, "
       "answer long, ids binary, serial long")
_KINDS = [*[pa.int64()] * 9, pa.binary(), pa.int64()]
_NAMES = [c.split()[0] for c in ROW.split(", ")]


def _packed(batches: Iterator[pa.RecordBatch], path: str, limits: Limits, last: bool) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId() << 33
    pool, rows, serial = Pool(limits), [], 0

    def flush(least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(rows) >= least:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)
            rows.clear()

    def emit(pieces: list[tuple[Document, int, int]], placed: bool = True) -> None:
        nonlocal serial
        number, offset = part | serial, 0
        for doc, a, b in pieces:
            own = doc.ids[a - doc.base:b - doc.base]
            rows.append((
                doc.key, a, b - a, zlib.crc32(own.tobytes()), doc.total, max(0, b - max(a + 1, doc.answer)),
                (-1 - number if last else number) if placed else None, offset if placed else None, doc.answer,
                None if placed else own.tobytes(), number if placed else part | serial))
            offset += b - a
            serial += not placed
        serial += placed

    for batch in batches:
        for doc in _leftovers(batch) if last else _documents(batch, path):
            end = doc.base + len(doc.ids)
            for a, b, full in whole_sequences(Document(doc.key, doc.ids, doc.base, doc.answer, end), limits):
                if full:
                    emit([(doc, a, b)])
                else:
                    pool.add(doc, a, b)
                yield from flush(BATCH)
            while pool.n >= POOL:
                emit(sequence(pool))
            yield from flush(BATCH)
    while pool.n and (last or int(pool.tokens[: pool.n].sum()) >= limits.tokens):
        emit(sequence(pool))
        yield from flush(BATCH)
    emit([pool.take(pool.n - 1) for _ in range(pool.n)], placed=False)
    yield from flush()


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", prompt: str | None = None,
         limits: Limits = Limits()) -> DataFrame:
    """(id, start, length, crc, doc_tokens, loss, sequence_id, offset) of every piece."""
    if limits.tokens & (limits.tokens - 1) or min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("limits are at least 1, and the tokens of a sequence a power of two")
    asked = F.lit(None).cast("string") if prompt is None else F.col(prompt)
    rows = docs.select(F.col(key).cast("long").alias("id"), asked.alias("_prompt"), F.col(text).alias("_text"))
    first = saved(rows.mapInArrow(partial(_packed, path=path, limits=limits, last=False), ROW), "vector-packed")
    left = first.where("sequence_id IS NULL")
    tasks = -(-(left.agg(F.sum("length")).first()[0] or 0) // LEFT_TOKENS)
    # in a fixed order, so that a repeated task packs alike
    dealt = left.repartition(max(1, tasks), F.xxhash64("serial")).sortWithinPartitions("serial")
    second = dealt.mapInArrow(partial(_packed, path=path, limits=limits, last=True), ROW)
    return first.where("sequence_id IS NOT NULL").unionByName(second).drop("answer", "ids", "serial")
