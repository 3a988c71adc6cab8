"""Merkle manifest of a table: a tree of digests for every group of rows, one root over all groups, a proof for every row.

Rows are numbered in their group and cut into aligned blocks, the partitions of the method. Every block hashes its own
subtree. Then blocks exchange roots in rounds, as in a butterfly network: in round r a block meets those whose number differs
from its own in digit r alone (to the base of the fanout), and all of them hash the same ancestor. After the last round every
block knows the root and the siblings of its whole upper path, so nothing is sent back down.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sievepoint.operators.lookup import lookup_join
from sievepoint.operators.ordered import group_index
from sievepoint.runtime import materialize

# Leaves of a block, at most: the largest power of the fanout up to this.
BLOCK = 4096
PROOF = "array<struct<left: string, right: string>>"


def leaf_digest(*fields: Column) -> Column:
    """Digest of values that cannot be confused: ``-`` for NULL, else byte count, colon and the value as text."""
    def framed(field):
        text = field.cast("string")
        return F.when(field.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.sha2(F.concat(*(framed(f) for f in fields)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def siblings(proof: Column) -> Column:
    """The proof's digests as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _height(fanout: int) -> int:
    levels = 1
    while fanout ** (levels + 1) <= BLOCK:
        levels += 1
    return levels


def _levels(leaves: list[str], fanout: int, height: int, first: bool) -> list[list[str]]:
    """All levels of a block's subtree. The first block may be its whole tree, which ends at one node."""
    levels = [leaves]
    while len(levels) <= height and not (first and len(levels[-1]) == 1):
        below = levels[-1]
        levels.append([sha256("".join(below[i:i + fanout]).encode()).hexdigest() for i in range(0, len(below), fanout)])
    return levels


def _sorted(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table, [("_spot", "ascending")]))


def _block_root(fanout: int, height: int):
    def of(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        top = _levels(_sorted(table)["_digest"].to_pylist(), fanout, height, block == 0)[-1]
        return pa.table({"_tree": [tree], "_block": pa.array([block], pa.int64()), "digest": top})
    return of


def _block_proofs(fanout: int, height: int):
    """Proofs of a block's leaves: the siblings inside the block, then those of the block's upper path."""
    def of(key: tuple[pa.Scalar, ...], table: pa.Table, upper: pa.Table) -> pa.Table:
        table = _sorted(table)
        levels = _levels(table["_digest"].to_pylist(), fanout, height, key[1].as_py() == 0)
        left, right, bases = [], [], []
        for level in levels[:-1]:
            bases.append(len(left))
            for i in range(len(level)):
                start = i - i % fanout
                left.append("".join(level[start:i]))
                right.append("".join(level[i + 1:start + fanout]))
        above = upper["proof"][0].as_py()
        n, own = table.num_rows, len(bases)
        index = np.empty((n, own + len(above)), np.int64)
        for k, base in enumerate(bases):
            index[:, k] = base + np.arange(n) // fanout ** k
        index[:, own:] = len(left) + np.arange(len(above))
        left += [s["left"] for s in above]
        right += [s["right"] for s in above]
        pairs = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
        offsets = np.arange(n + 1, dtype=np.int32) * index.shape[1]
        proof = pa.ListArray.from_arrays(pa.array(offsets), pairs.take(pa.array(index.ravel())))
        subroot = pa.array([upper["digest"][0].as_py()] * n, pa.string())
        return table.append_column("subroot", subroot).append_column("proof", proof)
    return of


def _exchange(blocks: DataFrame, fanout: int) -> DataFrame:
    """Root and upper proof of every block: (_tree, _block, digest, proof).

    Where the tree's last nodes are not full, a block's partner may be missing; any other block of the partner's subtree
    holds the same ancestor, and the asking blocks are dealt over those that exist.
    """
    sizes = materialize(blocks.groupBy("_tree").agg(F.count(F.lit(1)).alias("_blocks")))
    state = materialize(lookup_join(blocks, sizes, ["_tree"]).withColumn("proof", F.array().cast(PROOF)))
    most = sizes.agg(F.max("_blocks")).first()[0] or 0
    span = 1
    while span < most:
        node = F.expr(f"_block div {span}L")
        nodes = F.expr(f"(_blocks + {span - 1}L) div {span}L")
        group = node - node % fanout
        others = F.filter(F.sequence(group, F.least(group + fanout, nodes) - 1), lambda q: q != node)
        asked = state.where(nodes > 1).select("_tree", "_block", "_blocks", F.explode(others).alias("q"))
        there = F.least(F.lit(span), F.col("_blocks") - F.col("q") * span)
        asked = asked.withColumn("_from", F.col("q") * span + F.col("_block") % span % there)
        sent = state.select("_tree", F.col("_block").alias("_from"), F.col("digest").alias("sent"))
        met = (asked.join(sent, ["_tree", "_from"]).groupBy("_tree", "_block")
               .agg(F.sort_array(F.collect_list(F.struct("q", "sent"))).alias("met")))  # fanout - 1 at most

        def side(keep):
            return F.array_join(F.transform(F.filter("met", lambda m: keep(m["q"])), lambda m: m["sent"]), "")
        step = state.join(met, ["_tree", "_block"], "left").withColumn("met", F.coalesce("met", F.array().cast("array<struct<q:bigint,sent:string>>")))
        step = step.select("*", (nodes > 1).alias("goes_on"), side(lambda q: q < node).alias("left"), side(lambda q: q > node).alias("right"))
        state = materialize(step.select(
            "_tree", "_block", "_blocks",
            F.when(F.col("goes_on"), F.sha2(F.concat("left", "digest", "right"), 256)).otherwise(F.col("digest")).alias("digest"),
            F.when(F.col("goes_on"), F.concat("proof", F.array(F.struct("left", "right")))).otherwise(F.col("proof")).alias("proof")))
        span *= fanout
    return state.select("_tree", "_block", "digest", "proof")


def _blocked(nodes: DataFrame, fanout: int) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (_tree, _spot, _digest and others) with their block, and the root and upper proof of every block."""
    height = _height(fanout)
    nodes = nodes.withColumn("_block", F.expr(f"_spot div {fanout ** height}L"))
    grouped = nodes.select("_tree", "_block", "_spot", "_digest").groupBy("_tree", "_block")
    blocks = materialize(grouped.applyInArrow(_block_root(fanout, height), "_tree string, _block bigint, digest string"))
    return nodes, _exchange(blocks, fanout)


def _proved(nodes: DataFrame, upper: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with subroot and proof of each."""
    added = T._parse_datatype_string(f"subroot string, proof {PROOF}")
    return (nodes.groupBy("_tree", "_block").cogroup(upper.groupBy("_tree", "_block"))
            .applyInArrow(_block_proofs(fanout, _height(fanout)), T.StructType([*nodes.schema.fields, *added.fields])))


def manifest(rows: DataFrame, group: str, order: str, leaf: str = "leaf", fanout: int = 2) -> DataFrame:
    """``rows`` with subroot, root and proof added; columns of these three names are replaced.

    ``leaf`` holds each row's digest. In each ``group`` leaves ascend by ``order``, and while more than one node remains every
    ``fanout`` consecutive ones (the last run may be shorter) become the digest of their digests, joined as hex text. What
    remains is the group's subroot, and the subroots in order of their group, NULL first, give ``root`` in the same way. A
    proof has one pair for each level from leaf to root: the digests to the left and to the right in the run, joined.

    A group of any size is many blocks, which are numbered over ranges and hashed by as many tasks; only their roots travel
    between blocks. Rows of one place in the order are taken by leaf, so repeated rows all have a place of their own. A NULL
    order comes first; groups are ordered by their text. An empty table gives an empty result.
    """
    names = [c for c in rows.columns if c not in ("subroot", "root", "proof")]
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    slim = materialize(rows.select(F.struct(*names).alias("_row"), tree.alias("_tree"), F.col(order).alias("_order"), F.col(leaf).alias("_digest")))
    placed = group_index(slim.withColumn("_same", F.monotonically_increasing_id()),
                         [F.asc_nulls_first("_order"), F.asc("_digest"), F.asc("_same")], ["_tree"], "_spot")
    nodes, upper = _blocked(placed.select("_row", "_tree", "_spot", "_digest"), fanout)
    tops = upper.where("_block = 0").select("_tree", F.col("digest").alias("_digest"), F.lit("all").alias("_all"))
    one = group_index(tops, [F.asc("_tree")], ["_all"], "_spot")
    over = _proved(*_blocked(one.select(F.col("_tree").alias("of"), F.col("_all").alias("_tree"), "_spot", "_digest"), fanout), fanout)
    over = materialize(over.select(F.col("of").alias("_tree"), F.col("subroot").alias("root"), F.col("proof").alias("_over")))
    whole = lookup_join(_proved(nodes, upper, fanout).select("_row", "_tree", "subroot", "proof"), over, ["_tree"])
    return whole.select(*(F.col("_row")[c].alias(c) for c in names), "subroot", "root", F.concat("proof", "_over").alias("proof"))
