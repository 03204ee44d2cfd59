"""Transcript parsing: roles recovered by Viterbi over lines, then canonical turns.

A transcript is a conversation id and its pieces of raw text in order; roles may be
marked in several styles or not at all. The hidden states are "a turn of this role
begins" and "inside a turn of this role"; a line shows its speaker marker, whether it
opens the conversation or a blank line precedes it, its length and how it ends; where
pieces begin is not shown, so turns may run on inside a piece. Start, transition and emission
probabilities are smoothed counts over labelled lines; the tables have a row per
feature and state, whatever the corpus.

Lines are numbered in order by a distributed sort. A conversation is decoded in blocks
of at most ``BLOCK`` lines, however its pieces are numbered or keyed. Each block is first
summed up as a max-plus matrix (best log probability from every entry state to
every exit state); the chain of matrices gives the exact best states at the block
borders, and the blocks are then decoded side by side. So the result is Viterbi over
the whole conversation while no task holds all of it.

Defined results: null text counts as empty (one empty line); a null piece number comes
first; pieces with one number are ordered by text; repeated rows stay, one after the
other; null ids form one conversation; an empty table gives an empty result. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.store import saved

ROLES = ("system", "user", "assistant")
# Speaker markers by role, without their closing sign.
MARKERS = {
    "system": ("system", "system prompt", "context", "instructions"),
    "user": ("user", "human", "question", "q", "customer", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model"),
}
STATES = 2 * len(ROLES)  # begin of role r: 2r, inside: 2r + 1
BLOCK = 4096
MARKER = r"^\s*(?:###\s*|<\|\s*|\[\s*|\*\*\s*)?(" + "|".join(
    sorted((m for names in MARKERS.values() for m in names), key=len, reverse=True)) + r")\s*(?:\|>|\]|:\*\*|\*\*:?|:|$)\s*"


def _running(batches: Iterator[pa.RecordBatch], tail: list[str]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their task, the sum of ``n`` before them in it and the ``tail`` of the row before."""
    part, at, last = TaskContext.get().partitionId(), 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        n = batch.column("n").to_numpy()
        held = pa.StructArray.from_arrays([batch.column(c) for c in tail], names=tail)
        prev = pa.concat_arrays([pa.array([last], held.type), held.slice(0, len(held) - 1)])
        starts = at + np.cumsum(n) - n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(n), pa.int32()), pa.array(starts, pa.int64()), prev],
                                         names=[*batch.schema.names, "task", "at", "prev"])
        at, last = at + int(n.sum()), held[-1].as_py()


def ordered(rows: DataFrame, keys: list[str], tail: list[str], name: str) -> DataFrame:
    """``rows`` with ``at``, the sum of ``n`` (1 or more) over all rows before in the order of ``keys``, and ``prev``, the
    ``tail`` of the row before. A distributed sort; a row per task comes to the driver."""
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    held = f"struct<{','.join(f'{c}:{kind[c]}' for c in tail)}>"
    schema = ", ".join(f"{c} {k}" for c, k in kind.items())
    placed = saved(rows.orderBy(*keys).mapInArrow(partial(_running, tail=tail), f"{schema}, task int, at long, prev {held}"), name)
    ends = placed.groupBy("task").agg(F.sum("n").alias("n"), F.max_by(F.struct(*tail), "at").alias("end")).orderBy("task").collect()
    heads, base, last = [], 0, None
    for r in ends:
        heads.append((r["task"], base, last))
        base, last = base + r["n"], r["end"]
    starts = rows.sparkSession.createDataFrame(heads, f"task int, base long, end {held}")
    return placed.join(F.broadcast(starts), "task").withColumns(
        {"at": F.col("at") + F.col("base"), "prev": F.coalesce("prev", "end")}).drop("task", "base", "end")


def lines(transcripts: DataFrame, key: str, order: str, text: str, carry: str | None = None) -> DataFrame:
    """(conv, block, at, line, content, skip, feature[, label, before, opens]) of every line; ``at`` numbers all lines in
    order, content is the whole line and ``skip`` the length of what looks like a marker. Pieces follow one another line by line: their borders are not shown to the model."""
    seq = F.coalesce(F.col(order).cast("long"), F.lit(-1))
    raw = F.coalesce(F.col(text), F.lit(""))
    cut = F.split(raw, "\n")
    kept = [F.col(carry).alias("label")] if carry else []
    rows = transcripts.select(F.col(key).cast("long").alias("conv"), seq.alias("seq"), F.xxhash64(raw).alias("raw"),
                              F.monotonically_increasing_id().alias("tie"), raw.alias("whole"), F.size(cut).cast("long").alias("n"),
                              (F.trim(F.element_at(cut, -1)) == "").alias("blank"), *kept)
    # equal rows are told apart by the last key, so that they need not meet in one task
    placed = ordered(rows, ["conv", "seq", "raw", "tie"], ["conv", "n", "blank", *(["label"] if carry else [])], "chat-pieces")
    opens = F.col("prev").isNull() | ~F.col("prev.conv").eqNullSafe(F.col("conv"))
    told = [F.col("label"), F.when(~opens, F.struct("prev.label", "prev.n")).alias("before"), opens.alias("opens")] if carry else []
    split = placed.withColumn("_l", F.split("whole", "\n"))
    spread = split.select(
        "conv", "at", *told, opens.alias("_opens"), F.col("prev.blank").alias("_blank"),
        F.posexplode(F.transform("_l", lambda x, i: F.struct(x.alias("body"), F.get("_l", i - 1).alias("past")))).alias("line", "l"),
    ).withColumn("body", F.col("l.body"))
    name = F.lower(F.regexp_extract("body", "(?i)" + MARKER, 1))
    role = F.lit("-")
    for r, names in MARKERS.items():
        role = F.when(name.isin(*names), r).otherwise(role)
    after_blank = F.when(F.col("line") == 0, F.col("_blank")).otherwise(F.trim("l.past") == "")
    gap = F.when((F.col("line") == 0) & F.col("_opens"), "first").when(after_blank, "gap").otherwise("on")
    size = F.length("body")
    kind = F.when(F.trim("body") == "", "blank").when(size < 40, "short").when(size < 200, "middle").otherwise("long")
    asks = F.when(F.rtrim("body").endswith("?"), "?").otherwise(".")
    number = F.col("at") + F.col("line")
    return spread.select("conv", F.floor(number / BLOCK).cast("long").alias("block"), number.alias("at"), "line",
                         *(["label", "before", "opens"] if carry else []),
                         F.col("body").alias("content"),
                         F.when(name != "", F.length("body") - F.length(F.regexp_replace("body", "(?i)" + MARKER, ""))).otherwise(0).alias("skip"),
                         F.concat_ws("|", role, gap, kind, asks).alias("feature"))


class Model:
    """Log probabilities from smoothed counts."""

    def __init__(self, starts: dict[int, int], steps: dict[tuple[int, int], int], emits: dict[tuple[int, str], int]):
        features = sorted({f for _, f in emits})
        allowed = np.array([[t % 2 == 0 or t // 2 == s // 2 for t in range(STATES)] for s in range(STATES)])
        start = np.array([starts.get(s, 0) + 0.5 if s % 2 == 0 else 0.0 for s in range(STATES)])
        step = np.array([[steps.get((s, t), 0) + 0.5 for t in range(STATES)] for s in range(STATES)]) * allowed
        seen = np.array([[emits.get((s, f), 0) for s in range(STATES)] for f in features], float).reshape(-1, STATES)
        self.total = np.maximum(seen.sum(axis=0), 1)
        # what a line shows is counted part by part too, and these shares stand behind those of whole features, with one
        # weight and floor for all states: a state seldom seen must not draw the lines that none has shown
        self.parts: list[dict[str, np.ndarray]] = [{} for _ in range(4)]
        for f, n in zip(features, seen):
            for held, value in zip(self.parts, f.split("|")):
                held[value] = held.get(value, 0) + n
        with np.errstate(divide="ignore"):
            self.start = np.log(start / start.sum())
            self.step = np.log(step / step.sum(axis=1, keepdims=True))
        self.emit = {f: np.log(0.95 * n / self.total + 0.05 * self.expected(f)) for f, n in zip(features, seen)}

    def expected(self, feature: str) -> np.ndarray:
        """The share of a feature in each state if its parts were independent."""
        share = np.ones(STATES)
        for held, value in zip(self.parts, feature.split("|")):
            share = share * (held.get(value, 0) / self.total + 0.001)
        return share

    def seen(self, features: list[str]) -> np.ndarray:
        for f in features:
            if f not in self.emit:  # so many kinds of lines at most as parts combine to
                self.emit[f] = np.log(0.05 * self.expected(f))
        return np.array([self.emit[f] for f in features]).reshape(-1, STATES)

    def summed(self, seen: np.ndarray) -> np.ndarray:
        """Best log probability from each state before these lines to each state at their end."""
        best = np.full((STATES, STATES), -np.inf)
        np.fill_diagonal(best, 0.0)
        for e in seen:
            best = (best[:, :, None] + self.step[None, :, :]).max(axis=1) + e[None, :]
        return best

    def path(self, seen: np.ndarray, entry: int | None, leave: int) -> list[int]:
        """Best states of the lines between a given state before them (None: a start) and the state of the last one."""
        score = (self.start if entry is None else self.step[entry]) + seen[0]
        back = np.zeros((len(seen), STATES), np.int8)
        for i in range(1, len(seen)):
            via = score[:, None] + self.step
            back[i] = via.argmax(axis=0)
            score = via.max(axis=0) + seen[i]
        states = [leave]
        for i in range(len(seen) - 1, 0, -1):
            states.append(int(back[i, states[-1]]))
        return states[::-1]


def learn(labelled: DataFrame) -> Model:
    """Counts over ``lines(..., carry=role)`` of pieces that are a turn each: a handful of rows per state come to the driver."""
    def state(label: str) -> Column:
        role = F.lit(None)
        for i, r in enumerate(ROLES):
            role = F.when(F.lower(label) == r, 2 * i).otherwise(role)
        return role

    # inside a piece the role stays; a blank line before the next piece belongs to the turn before
    rows = labelled.withColumn("s", state("label") + F.when(F.col("line") == 0, 0).otherwise(1)).where(F.col("s").isNotNull())
    emits = {(r["s"], r["feature"]): r["n"] for r in rows.groupBy("s", "feature").agg(F.count("*").alias("n")).collect()}
    steps: dict[tuple[int, int], int] = {}
    for r in rows.where("line > 0").groupBy("s").agg(F.sum((F.col("line") == 1).cast("int")).alias("more"),
                                                     F.sum((F.col("line") > 1).cast("int")).alias("on")).collect():
        steps[r["s"] - 1, r["s"]], steps[r["s"], r["s"]] = r["more"], r["on"]
    starts: dict[int, int] = {}
    tops = rows.where("line = 0").select("s", "opens", state("before.label").alias("ps"), (F.col("before.n") > 1).alias("long"))
    for r in tops.groupBy("s", "opens", "ps", "long").agg(F.count("*").alias("n")).collect():
        if r["opens"]:
            starts[r["s"]] = starts.get(r["s"], 0) + r["n"]
        elif r["ps"] is not None:
            steps[r["ps"] + int(r["long"]), r["s"]] = r["n"]
    return Model(starts, steps, emits)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """(conv, block) and its lines, from sorted rows."""
    at, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            now = (row["conv"], row["block"])
            if held and now != at:
                yield at, held
                held = []
            at = now
            held.append(row)
    if held:
        yield at, held


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


PLACE = [("conv", pa.int64()), ("block", pa.int64())]
SUMS = pa.schema([*PLACE, ("first", pa.list_(pa.float64())), ("matrix", pa.list_(pa.float64()))])
BORDERS = pa.schema([*PLACE, ("entry", pa.int32()), ("leave", pa.int32()), ("closes", pa.bool_())])
TURNS = pa.schema([*PLACE, ("n", pa.int64()), ("opens", pa.bool_()), ("closed", pa.bool_()), ("role", pa.string()), ("text", pa.string())])


def _sum_up(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    def sums() -> Iterator[tuple]:
        for (conv, block), rows in _runs(batches):
            matrix = model.summed(model.seen([r["feature"] for r in rows[1:]]))
            first = model.seen([rows[0]["feature"]])[0]
            yield conv, block, first.tolist(), matrix.ravel().tolist()

    yield from _batched(sums(), SUMS)


def _chain(blocks: list[dict], model: Model) -> list[tuple]:
    """(conv, block, entry, leave, closes) for the blocks of one conversation, in order; a block closes its last turn
    unless the next one goes on inside it."""
    score, arrived = None, []
    for b in blocks:
        inner = np.array(b["matrix"]).reshape(STATES, STATES)
        via = model.start[None, :] if score is None else score[:, None] + model.step
        opened = via.max(axis=0) + np.array(b["first"])  # at the block's first line
        arrived.append((via.argmax(axis=0), (opened[:, None] + inner).argmax(axis=0)))
        score = (opened[:, None] + inner).max(axis=0)
    leave, closes, rows = int(score.argmax()), True, []
    for b, (came, opened) in zip(blocks[::-1], arrived[::-1]):
        entry = None if b is blocks[0] else int(came[opened[leave]])
        rows.append((b["conv"], b["block"], entry, leave, closes))
        leave, closes = entry, int(opened[leave]) % 2 == 0
    return rows[::-1]


def _borders(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """States at the borders of the blocks of each conversation, from sorted sums."""
    def borders() -> Iterator[tuple]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv"] != held[0]["conv"]:
                    yield from _chain(held, model)
                    held = []
                held.append(row)
        if held:
            yield from _chain(held, model)

    yield from _batched(borders(), BORDERS)


def _decode(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Turns, or parts of them, of each block."""
    def parts() -> Iterator[tuple]:
        for (conv, block), rows in _runs(batches):
            states = model.path(model.seen([r["feature"] for r in rows]), rows[0]["entry"], rows[0]["leave"])
            turns: list[tuple[bool, str, list[str]]] = []
            for r, s in zip(rows, states):
                if s % 2 == 0 or not turns:
                    turns.append((s % 2 == 0, ROLES[s // 2], []))
                # a marker is one only where the turn of its role begins; elsewhere it is text
                marks = s % 2 == 0 and r["feature"].startswith(ROLES[s // 2] + "|")
                turns[-1][2].append(r["content"][r["skip"]:] if marks else r["content"])
            n = 0
            for i, (opens, role, texts) in enumerate(turns):
                n += opens
                closed = rows[0]["closes"] if i == len(turns) - 1 else True
                text = "\n".join(texts)
                # blank lines inside a turn stay where a block ends
                text = text.lstrip("\n") if opens else text
                yield conv, block, n, opens, closed, role, text.rstrip("\n") if closed else text

    yield from _batched(parts(), TURNS)


def parse(transcripts: DataFrame, model: Model, key: str = "conv_id", order: str = "turn", text: str = "text") -> DataFrame:
    """(key, turn, part, role, text, rendered) of every recovered turn; ``part`` counts blocks that a turn runs on into."""
    rows = saved(lines(transcripts, key, order, text), "chat-lines")
    inside = ["conv", "block"]
    whole = [*inside, "at"]
    dealt = rows.repartition(*inside).sortWithinPartitions(*whole)
    sums = dealt.mapInArrow(partial(_sum_up, model=model), "conv long, block long, first array<double>, matrix array<double>")
    borders = saved(sums.repartition("conv").sortWithinPartitions(*inside).mapInArrow(
        partial(_borders, model=model), "conv long, block long, entry int, leave int, closes boolean"), "chat-borders")
    same = F.col("r.conv").eqNullSafe(F.col("b.conv")) & (F.col("r.block") == F.col("b.block"))
    known = rows.alias("r").join(borders.alias("b"), same).select("r.*", "entry", "leave", "closes")
    turns = saved(known.repartition(*inside).sortWithinPartitions(*whole).mapInArrow(
        partial(_decode, model=model), "conv long, block long, n long, opens boolean, closed boolean, role string, text string"), "chat-turns")
    begun = turns.groupBy(*inside).agg(F.max("n").alias("n"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    offsets = begun.select(*inside, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("past"),
                           (F.col("block") - F.min("block").over(Window.partitionBy("conv"))).alias("later"))
    same = F.col("t.conv").eqNullSafe(F.col("o.conv")) & (F.col("t.block") == F.col("o.block"))
    numbered = turns.alias("t").join(offsets.alias("o"), same).select("t.*", "later", (F.col("past") + F.col("n") - 1).alias("turn"))
    part = F.when(F.col("opens"), F.lit(0)).otherwise(F.col("later")).cast("long")
    header = F.when(F.col("opens"), F.concat(F.lit("<|"), "role", F.lit("|>\n"))).otherwise(F.lit(""))
    return numbered.select(F.col("conv").alias(key), "turn", part.alias("part"), "role", "text",
                           F.concat(header, "text", F.when(F.col("closed"), F.lit("\n<|end|>\n")).otherwise(F.lit("\n"))).alias("rendered"))


def raw_transcripts(conversations: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Raw transcript pieces from labelled turns: one of four marker styles per conversation, every fifth turn
    but the first unmarked, a blank line after each turn. The role itself is kept for learning only."""
    style = F.pmod(F.xxhash64(F.lit("style"), F.col(key)), F.lit(4))
    bare = (F.pmod(F.xxhash64(F.lit("bare"), F.col(key), F.col(order)), F.lit(5)) == 0) & (F.coalesce(F.col(order), F.lit(0)) > 0)
    r = F.lower(F.coalesce(F.col(role), F.lit("user")))
    short = F.when(r == "user", "Q").when(r == "assistant", "A").otherwise("Context")
    human = F.when(r == "user", "Human").when(r == "assistant", "AI").otherwise("System")
    marker = (F.when(style == 0, F.concat(F.initcap(r), F.lit(": "))).when(style == 1, F.concat(F.lit("### "), human, F.lit(":\n")))
              .when(style == 2, F.concat(short, F.lit(": "))).otherwise(F.concat(F.lit("<|"), r, F.lit("|>\n"))))
    raw = F.concat(F.when(bare, F.lit("")).otherwise(marker), F.coalesce(F.col(text), F.lit("")), F.lit("\n"))
    return conversations.select(F.col(key), F.col(order), raw.alias("text"), F.col(role).alias("role"))


def run_on(pieces: DataFrame, key: str = "conv_id", order: str = "turn", text: str = "text", size: int = 8) -> DataFrame:
    """The pieces of a conversation joined, up to ``size`` to one text, in their order."""
    seq = F.coalesce(F.col(order).cast("long"), F.lit(-1))
    rows = pieces.select(F.col(key).cast("long").alias("conv"), seq.alias("seq"), F.xxhash64(text).alias("raw"),
                         F.monotonically_increasing_id().alias("tie"), F.col(text).alias("whole"), F.lit(1).cast("long").alias("n"))
    placed = ordered(rows, ["conv", "seq", "raw", "tie"], ["conv"], "chat-order")
    joined = placed.groupBy("conv", F.floor(F.col("at") / size).cast("long").alias("g")).agg(
        F.sort_array(F.collect_list(F.struct("at", "whole"))).alias("p"))
    return joined.select(F.col("conv").alias(key), F.col("g").alias(order), F.array_join(F.col("p.whole"), "\n").alias(text))
