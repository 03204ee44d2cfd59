"""Merkle manifest of a table, with a proof for every row, by butterfly exchange.

Rows of a group, in the order of their keys, are the leaves of a tree of fanout
``FANOUT``; the groups' roots, in order, are the leaves of the tree above. Leaves get
their position by one range sort and offsets per partition. A partition of the
exchange is a block of ``FANOUT**height`` aligned leaves, whose own subtree is hashed in one
pass over its sorted rows.

Then blocks swap roots round by round. In round r a block meets, in each other
subtree of its run of ``FANOUT``, the block that stands at the same place in it (a shorter last
subtree sends its blocks as often as needed). Each of the up to ``FANOUT`` blocks that
meet hashes the common parent for itself and keeps the roots of the others, so after the last
round every block holds its path to the root, and nothing has to travel down again. A
meeting is a group of at most ``FANOUT`` rows, whatever the size of a group. The same exchange, with
blocks of one leaf, runs over the groups' roots. A last pass over the blocks, each with its path in
front, hashes the proofs.

Defined results: a null field is hashed as ``-``; a null group is a group of its own and
comes first; null keys come first in their group; rows of equal key stand in the order of their
hash, rows equal in all hashed columns one after the other; an empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.store import saved

FANOUT = 8
HEIGHT = 4
BATCH = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 64


def leaf_hash(fields: Sequence[Column]) -> Column:
    """H of the fields, each with its length in bytes in front, or ``-`` where it is null."""
    parts = []
    for c in fields:
        value = c.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def positions(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Written ``rows`` with ``pos``, their place in their group from 0, and ``size``, the rows of the group.

    ``order`` has to end in a column that no two rows share, so that a range sort can split any run of equal keys.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # the partition number is above bit 33, the place in the sorted partition below
    placed = saved(ranged.withColumn("_at", F.monotonically_increasing_id()), name)
    part, at = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    runs = placed.groupBy(F.col(group).alias("_g"), part.alias("_part")).agg(F.count("*").alias("_n"), F.min(at).alias("_first"))
    earlier = Window.partitionBy("_g").orderBy("_part")
    # a row per partition and group in it: a group has as many as the table has partitions, at most
    offsets = runs.select("_g", "_part", (F.sum("_n").over(earlier) - F.col("_n") - F.col("_first")).alias("_shift"),
                          F.sum("_n").over(Window.partitionBy("_g")).alias("size"))
    same = (F.col(group) == F.col("_g")) & (part == F.col("_part"))
    return placed.join(offsets, same).withColumn("pos", at + F.col("_shift")).drop("_g", "_part", "_shift", "_at")


def digest(texts: Sequence[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def levels(leaves: Sequence[str], alone: bool, height: int) -> list[list[str]]:
    """The levels above the leaves of a block; a block that is ``alone`` ends at its first single node, another at ``height``."""
    out = [list(leaves)]
    while len(out[-1]) > 1 if alone else len(out) <= height:
        row = out[-1]
        out.append([digest(row[i:i + FANOUT]) for i in range(0, len(row), FANOUT)])
    return out


# ---- passes over sorted blocks -------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[dict]]]:
    """Runs of equal (group, block); a block has ``FANOUT**height`` rows and one path at most."""
    at, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = row["grp"], row["block"]
            if key != at and rows:
                yield at, rows
                rows = []
            at = key
            rows.append(row)
    if rows:
        yield at, rows


def _block_roots(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    for (group, block), rows in _blocks(batches):
        blocks = -(-rows[0]["size"] // FANOUT ** height)
        root = levels([r["leaf"] for r in rows], blocks == 1, height)[-1][0]
        yield pa.RecordBatch.from_pylist([{"grp": group, "block": block, "blocks": blocks, "root": root}],
                                         pa.schema([("grp", pa.string()), ("block", pa.int64()), ("blocks", pa.int64()), ("root", pa.string())]))


def folded(leaf: str, path: Sequence[tuple[int, str]]) -> str:
    """The root over a leaf and the siblings of its path: (place in its run, the digests of the others)."""
    for child, others in path:
        cut = child * _DIGEST
        leaf = digest((others[:cut], leaf, others[cut:]))
    return leaf


PROOF = "key long, grp string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_PROOF = pa.schema([(c.split()[0], pa.bool_() if c.endswith("boolean") else pa.int64() if c.endswith("long") else pa.string()) for c in PROOF.split(", ")])


def _proofs(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    for (group, _), rows in _blocks(batches):
        head, rows = rows[0], rows[1:]
        above = [(p["child"], p["others"]) for p in head["path"]]
        tree = levels([r["leaf"] for r in rows], head["alone"], height)
        tail = "".join(others for _, others in above)
        out = []
        for i, row in enumerate(rows):
            path, at = [], i
            for level in tree[:-1]:
                first = at - at % FANOUT
                path.append((at - first, "".join(level[first:at] + level[at + 1:first + FANOUT])))
                at //= FANOUT
            found = folded(row["tampered"], path + above)
            out.append({"key": row["key"], "grp": group, "leaf": row["leaf"], "subroot": head["subroot"], "root": head["root"],
                        "proof_sha256": digest([others for _, others in path] + [tail]), "folded_root": found, "verified": found == head["root"]})
            if len(out) == BATCH:
                yield pa.RecordBatch.from_pylist(out, _PROOF)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, _PROOF)


def in_blocks(rows: DataFrame, *order: str) -> DataFrame:
    """Rows of a block next to each other in one task, in order."""
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", *order)


# ---- the exchange --------------------------------------------------------------------------


def butterfly(blocks: DataFrame) -> DataFrame:
    """(grp, block, root, path) from (grp, block, blocks, root); ``blocks`` counts those of the group.

    ``path`` has, level by level, the place of the block's own ancestor in its run and the digests of the others.
    """
    state = blocks.withColumn("path", F.array().cast("array<struct<child:int,others:string>>"))
    most = blocks.agg(F.max("blocks")).first()[0] or 0
    width = 1
    while width < most:
        nodes = F.ceil(F.col("blocks") / width).cast("long")
        node = F.floor(F.col("block") / width).cast("long")
        place = F.col("block") % width
        state = state.withColumns({"_nodes": nodes, "_node": node, "_place": place})
        done = state.where("_nodes = 1").select("grp", "block", "blocks", "root", "path")
        # the last subtree may be smaller: its blocks stand in for the places that it lacks
        held = F.when(F.col("_node") == F.col("_nodes") - 1, F.col("blocks") - F.col("_node") * width).otherwise(F.lit(width))
        meets = state.where("_nodes > 1").withColumn("_at", F.explode(F.sequence("_place", F.lit(width - 1).cast("long"), held)))
        one = F.struct((F.col("_node") % FANOUT).cast("int").alias("child"), "root", (F.col("_at") == F.col("_place")).alias("own"),
                       "block", "blocks", "path")
        met = meets.groupBy("grp", F.floor(F.col("_node") / FANOUT).alias("_run"), "_at").agg(F.array_sort(F.collect_list(one)).alias("run"))
        met = met.withColumn("parent", F.sha2(F.encode(F.concat_ws("", F.transform("run", lambda x: x["root"])), "UTF-8"), 256))
        each = met.select("grp", "run", "parent", F.explode(F.filter("run", lambda x: x["own"])).alias("me"))
        others = F.concat_ws("", F.transform(F.filter("run", lambda x: x["child"] != F.col("me.child")), lambda x: x["root"]))
        step = F.struct(F.col("me.child").alias("child"), others.alias("others"))
        swapped = each.select("grp", F.col("me.block").alias("block"), F.col("me.blocks").alias("blocks"), F.col("parent").alias("root"),
                              F.concat("me.path", F.array(step)).alias("path"))
        state = saved(swapped.unionByName(done), "butterfly")
        width *= FANOUT
    return state


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS,
             tampered: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """(key, grp, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``grp`` is the group as text, null kept. ``tampered`` names other values of fields, as they
    would be found by someone who checks the proofs; ``folded_root`` is computed from those.
    """
    found = {**{f: F.col(f) for f in fields}, **(tampered or {})}
    most = FANOUT ** height
    leaves = saved(docs.select(
        F.col(key).cast("long").alias("key"),
        # null first, then bytewise: an equals sign keeps a null apart from an empty group
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("grp"),
        leaf_hash([F.col(f) for f in fields]).alias("leaf"), leaf_hash([found[f] for f in fields]).alias("tampered"),
        F.monotonically_increasing_id().alias("serial")), "merkle-leaves")
    placed = positions(leaves, "grp", ["key", "leaf", "serial"], "merkle-sorted").withColumn("block", F.floor(F.col("pos") / most))
    placed = placed.select("key", "grp", "leaf", "tampered", "pos", "size", "block")
    roots = in_blocks(placed, "pos").mapInArrow(partial(_block_roots, height=height), "grp string, block long, blocks long, root string")
    inner = butterfly(saved(roots, "merkle-blocks")).withColumnsRenamed({"root": "subroot", "path": "inner"})
    # every block of a group knows its root; the first one speaks for it
    groups = saved(inner.where("block = 0").select("grp", "subroot", F.lit(0).alias("all")), "merkle-groups")
    ranked = saved(positions(groups, "all", ["grp"], "merkle-ranked"), "merkle-subroots")
    outer = butterfly(ranked.select(F.lit("").alias("grp"), F.col("pos").alias("block"), F.col("size").alias("blocks"), F.col("subroot").alias("root")))
    above = ranked.select("grp", F.col("pos").alias("_pos")).join(outer.select(F.col("block").alias("_pos"), "root", "path"), "_pos")
    heads = inner.join(above, "grp").select(
        "grp", "block", F.lit(-1).cast("long").alias("pos"), (F.col("blocks") == 1).alias("alone"), "subroot", "root",
        F.concat("inner", "path").alias("path"))
    rows = in_blocks(placed.drop("size").unionByName(heads, allowMissingColumns=True), "pos")
    proofs = rows.mapInArrow(partial(_proofs, height=height), PROOF)
    return proofs.withColumn("grp", F.when(F.col("grp") != "", F.substring("grp", 2, (1 << 31) - 1)))
