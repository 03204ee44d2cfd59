"""Bounded label vocabularies and their bitset form.

A menu has a bounded number of category labels, and the wide outputs have one
column per label, so the vocabulary is metadata of the plan. Sets of labels
travel through aggregations as ``bit_or`` over BIGINT words: fixed-width
buffers that combine before the shuffle, instead of collected arrays that grow
with the group. The per-label expressions are SQL text: one label is one short
term, and a plan with hundreds of them is still built quickly.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright import names as N
from cartwright.functions.scalars import normalize_label

WORD_BITS = 63


@dataclass(frozen=True)
class LabelSet:
    """Raw labels in sorted order with the output name each one normalises to."""

    prefix: str
    raw: tuple[str, ...]
    normalized: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        """Output flag columns, sorted, one per distinct non-empty name."""
        return [self.prefix + n for n in sorted({n for n in self.normalized if n})]

    def united(self, other: "LabelSet") -> "LabelSet":
        names = dict(zip(self.raw + other.raw, self.normalized + other.normalized))
        return LabelSet(self.prefix, tuple(sorted(names)), tuple(names[r] for r in sorted(names)))

    @property
    def words(self) -> int:
        return max(1, -(-len(self.raw) // WORD_BITS))

    def position(self, label: str) -> Column:
        """Position of a raw label (SQL text), NULL if missing or unknown."""
        if not self.raw:
            return F.lit(None).cast("int")
        listed = ", ".join(map(sql_text, self.raw))
        return F.expr(f"CAST(nullif(array_position(array({listed}), {label}), 0) - 1 AS INT)")

    def word_of_position(self, pos: str, word: int) -> str:
        """Bit of ``pos`` if it lives in this word, else NULL (ignored by bit_or)."""
        first = word * WORD_BITS
        return f"CASE WHEN {pos} BETWEEN {first} AND {first + WORD_BITS - 1} THEN shiftleft(1L, {pos} - {first}) END"

    def word_of_array(self, arr: str, word: int) -> Column:
        """Bits of the labels that an array column holds.

        Walks the few labels of the row and looks each one up, instead of
        testing the array for every label of the vocabulary.
        """
        first = word * WORD_BITS
        entries = [
            f"{sql_text(label)}, {1 << i}L"
            for i, label in enumerate(self.raw[first:first + WORD_BITS])
        ]
        if not entries:
            return F.expr("0L")
        bit = f"coalesce(try_element_at(map({', '.join(entries)}), x), 0L)"
        return F.expr(f"aggregate({arr}, 0L, (bits, x) -> bits | {bit})")

    def flags(self, words: list[str], known: str = "true") -> list[Column]:
        """One 0/1 column per output name from the bitset words; NULL unless ``known``."""
        out = []
        for column in self.columns:
            out.append(F.expr(f"CASE WHEN {known} THEN CAST({self.hit(words, column)} AS INT) END").alias(column))
        return out

    def hit(self, words: list[str], column: str) -> str:
        """Whether the words hold any raw label behind one output column (SQL text)."""
        return " OR ".join(f"({words[w]} & {m}L) <> 0" for w, m in enumerate(self.masks(column)) if m)

    def masks(self, column: str) -> list[int]:
        """Bits, word by word, of the raw labels behind one output column."""
        out = [0] * self.words
        for i, name in enumerate(self.normalized):
            if self.prefix + name == column:
                out[i // WORD_BITS] |= 1 << (i % WORD_BITS)
        return out

    def to_array(self, words: list[str], known: str = "true") -> Column:
        """Sorted raw labels whose bits are set (``raw`` is sorted)."""
        parts = [
            f"IF(({words[i // WORD_BITS]} & {1 << (i % WORD_BITS)}L) <> 0, {sql_text(label)}, NULL)"
            for i, label in enumerate(self.raw)
        ]
        listed = f"array_compact(array({', '.join(parts)}))" if parts else "CAST(array() AS ARRAY<STRING>)"
        return F.expr(f"CASE WHEN {known} THEN {listed} END")

    def count(self, words: list[str]) -> Column:
        return F.expr(f"CAST({' + '.join(f'bit_count({w})' for w in words)} AS BIGINT)")


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def label_set(df: DataFrame, label: Column, prefix: str) -> LabelSet:
    """Read the vocabulary of a label column: as many rows as the outputs get flag columns."""
    rows = (
        df.select(label.alias("raw"))
        .where(F.col("raw").isNotNull())
        .distinct()
        .select("raw", normalize_label(F.col("raw")).alias("name"))
        .collect()
    )
    pairs = sorted((r["raw"], r["name"]) for r in rows)
    return LabelSet(prefix, tuple(p[0] for p in pairs), tuple(p[1] for p in pairs))


@dataclass(frozen=True)
class Catalog:
    """The two category vocabularies that define the wide output columns."""

    dri: LabelSet
    base: LabelSet

    @property
    def columns(self) -> list[str]:
        return self.base.columns + self.dri.columns

    def listed(self, hits: Iterable[str]) -> str:
        """Positions in ``columns`` whose condition holds, as an array (SQL text)."""
        terms = ", ".join(f"IF({hit}, {i}, NULL)" for i, hit in enumerate(hits))
        return f"array_compact(array({terms}))" if terms else "CAST(array() AS ARRAY<INT>)"

    def present_in_flags(self) -> str:
        """The same from 0/1 columns of written order features."""
        return self.listed(f"`{c}` = 1" for c in self.columns)

    def present_in_words(self, words: Mapping[str, list[str]]) -> str:
        """The same from bitset words, by kind of label."""
        kinds = (("base", self.base), ("dri", self.dri))
        return self.listed(ls.hit(words[kind], c) for kind, ls in kinds for c in ls.columns)

    @staticmethod
    def from_categories(categories: DataFrame, exclude: str = N.EXCLUDE_LABEL) -> "Catalog":
        base = F.trim(F.col(f"`{N.BASE_LABEL}`"))
        return Catalog(
            dri=label_set(categories, F.col(f"`{N.DRI_LABEL}`"), N.DRI_PREFIX),
            base=label_set(categories.where(base != exclude), base, N.BASE_PREFIX),
        )

    def covering(self, frames: Iterable[DataFrame]) -> "Catalog":
        """This catalog and every label that written order features hold, should the dimension have changed since."""
        held = Catalog.from_order_features(frames)
        return Catalog(self.dri.united(held.dri), self.base.united(held.base))

    @staticmethod
    def from_order_features(frames: Iterable[DataFrame]) -> "Catalog":
        """Vocabularies from already written order features."""
        frames = list(frames)

        def gather(column: str, prefix: str) -> LabelSet:
            parts = [f.select(F.explode(F.col(column)).alias("label")).distinct() for f in frames]
            return label_set(reduce(DataFrame.unionByName, parts), F.col("label"), prefix)

        return Catalog(gather(N.DRI_LIST, N.DRI_PREFIX), gather(N.BASE_LIST, N.BASE_PREFIX))
