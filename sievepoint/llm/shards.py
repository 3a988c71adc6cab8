"""Shards by a tree of weighted hash draws: region, rack, shard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.llm.mixing import unit_hash
from sievepoint.llm.text import once, whole_text
from sievepoint.operators.ordered import group_index
from sievepoint.runtime import materialize

# Bytes that a row takes beside its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Leaf:
    """A shard, its place in the tree and its weight."""
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int, per_rack: int = 6, racks_per_region: int = 3) -> list[Leaf]:
    """Shards of equal weight, filled up rack by rack, so that one more shard leaves all others where they are."""
    return [Leaf(s // per_rack // racks_per_region, s // per_rack, s) for s in range(shards)]


def _draws(ident: Column, leaves: list[Leaf], seed: str) -> Column:
    """An exponential draw for each leaf: small for few identities, in proportion to the weight."""
    table = F.array(*(F.struct(F.lit(x.shard).alias("shard"), F.lit(float(x.weight)).alias("weight")) for x in leaves))
    unit = lambda x: unit_hash(F.lit(seed), ident, x["shard"].cast("string"))
    return F.transform(table, lambda x: -F.log(unit(x) + F.lit(2.0 ** -53)) / x["weight"])


def _descend(draws: Column, leaves: list[Leaf], at: dict[int, int]) -> Column:
    """Region, rack and shard on the path of least draws.

    A node's draw is the least of the leaves under it, so it has the exponential law of their summed weight: a child is taken
    with odds of its weight, as with fresh draws on every level. But a changed weight changes draws on its own path alone,
    and always the same way: what it wins on the upper levels it wins for the changed leaf, never for its neighbours.
    """
    regions = {}
    for x in leaves:
        regions.setdefault(x.region, {}).setdefault(x.rack, []).append(x)
    tree = F.array(*(
        F.struct(F.lit(region).alias("region"), F.array(*(
            F.struct(F.lit(rack).alias("rack"), F.array(*(
                F.struct(F.lit(x.shard).alias("shard"), F.lit(at[x.shard]).alias("at")) for x in members)).alias("shards"))
            for rack, members in racks.items())).alias("racks"))
        for region, racks in regions.items()))

    def in_rack(node):
        return F.array_min(F.transform(node["shards"], lambda x: F.struct(F.get(draws, x["at"]).alias("draw"), x["shard"].alias("shard"))))

    def in_region(node):
        return F.array_min(F.transform(node["racks"], lambda x: F.struct(in_rack(x).alias("below"), x["rack"].alias("rack"))))
    return F.array_min(F.transform(tree, lambda x: F.struct(in_region(x).alias("below"), x["region"].alias("region"))))


def place(docs: DataFrame, leaves: list[Leaf], later: list[Leaf] | None = None, seed: str = "shard") -> DataFrame:
    """``docs`` with region, rack and shard added, and ``grown_shard`` by the tree ``later``; columns of these names are replaced.

    A leaf's share of the rows follows its weight; a weight of zero takes none. Raising one weight, or adding a leaf anywhere,
    moves rows to that leaf only; lowering one moves rows from it only. Only ``doc_id`` and the tree decide; a row without id
    goes by its text. This is a projection: no row moves between tasks. Repeated rows share a shard.
    """
    used = [x for x in leaves if x.weight > 0]
    grown = [x for x in later or leaves if x.weight > 0]
    # A leaf that both trees hold alike is drawn once.
    drawn = list(dict.fromkeys([*used, *grown]))
    numbers = {x: i for i, x in enumerate(drawn)}
    ident = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(whole_text("text"))))
    names = [c for c in docs.columns if c not in ("region", "rack", "shard", "grown_shard")]
    rows = docs.select(F.struct(*names).alias("row"), ident.alias("ident"))
    rows = once(rows, draws=_draws(F.col("ident"), drawn, seed))
    rows = once(rows, now=_descend(F.col("draws"), used, {x.shard: numbers[x] for x in used}),
                later=_descend(F.col("draws"), grown, {x.shard: numbers[x] for x in grown}))
    return rows.select(*(F.col("row")[c].alias(c) for c in names), "now.region", "now.below.rack", "now.below.below.shard",
                       F.col("later.below.below.shard").alias("grown_shard"))


def number(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``slot`` added: the place in its shard, from 0 without gaps, by ``order`` (NULL first).

    A shard is numbered over ranges, so one of any size is shared out over tasks.
    """
    marked = materialize(rows).withColumn("_same", F.monotonically_increasing_id())
    keys = [*(F.asc_nulls_first(c) for c in order), F.asc("_same")]
    return group_index(marked.drop("slot"), keys, ["shard"], "slot").drop("_same")


def sizes(docs: DataFrame) -> DataFrame:
    """``docs`` with size (bytes of the text and ``ROW_BYTES``) and text_crc32 added; a NULL text has no bytes."""
    body = whole_text("text")
    return docs.withColumns({"size": F.octet_length(body).cast("long") + ROW_BYTES, "text_crc32": F.crc32(body)})


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """Shard and slot of every row, and its shard after one more is added: doc_id, size, text_crc32, law, region, rack, shard, slot, grown_shard.

    Texts are only measured; nothing but these columns is shuffled. Rows without id are numbered first. Repeated rows get slots
    of their own. Other columns are ignored; an empty table gives an empty result.
    """
    slim = sizes(place(docs.select("doc_id", "text"), even_tree(shards), even_tree(shards + 1))).drop("text")
    return number(slim, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "region", "rack", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, leaves: list[Leaf]) -> None:
    """Write all columns as one folder for each shard, rows with their ``slot`` and sorted by it within each file."""
    placed = place(docs, leaves).drop("region", "rack", "grown_shard")
    rows = number(placed, ["doc_id"])
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
