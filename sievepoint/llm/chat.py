"""Collapse cumulative conversation logs to the longest versions and render them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sievepoint.runtime import materialize

TURN = "<|{role}|>\n{text}\n<|end|>\n"


def maximal_conversations(turns: DataFrame, template: str = TURN) -> DataFrame:
    """Render the conversations that are no prefix of another: conv_id, n_turns, n_copies, text.

    Logs often hold a conversation anew after every turn. Each turn gets two 64-bit hashes of all turns up to it;
    a conversation whose last hashes are those of an inner turn of another one is a prefix of it, and an
    anti join drops it. Of equal conversations the least ``conv_id`` stays, ``n_copies`` counts them. ``template``
    shows one turn and holds {role} and {text} once each, in this order.

    Turns are ordered by ``turn``, then role and text, NULL first; equal rows of one conversation count once. A
    NULL role or text is empty in the rendering but differs from an empty one when conversations are compared.
    Turns with a NULL ``conv_id`` belong to no conversation and are not rendered. Other columns are
    ignored; an empty table gives an empty result.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    # Position and NULL marks go into the hash of a turn, so the exclusive-or of the turns tells their order.
    parts = ["pos", F.col("role").isNull(), "role", F.col("text").isNull(), "text"]
    placed = (turns.where("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text").distinct()
              .withColumn("pos", F.row_number().over(order))
              .withColumn("h1", F.xxhash64(*parts)).withColumn("h2", F.xxhash64(F.lit("#"), *parts)))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = materialize(placed.withColumn("p1", F.bit_xor("h1").over(upto)).withColumn("p2", F.bit_xor("h2").over(upto))
                         .select("conv_id", "pos", "role", "text", "p1", "p2"))
    ends = rolled.groupBy("conv_id").agg(F.max_by(F.struct("pos", "p1", "p2"), "pos").alias("end")).select("conv_id", "end.*")
    unique = ends.groupBy("pos", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    size = ends.select("conv_id", F.col("pos").alias("n_turns"))
    inner = (rolled.select("conv_id", "pos", "p1", "p2").join(size, "conv_id")
             .where(F.col("pos") < F.col("n_turns")).select("pos", "p1", "p2").distinct())
    kept = unique.join(inner, ["pos", "p1", "p2"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"), "n_copies")
    before, _, rest = template.partition("{role}")
    between, _, after = rest.partition("{text}")
    shown = F.concat(F.lit(before), F.coalesce("role", F.lit("")), F.lit(between), F.coalesce("text", F.lit("")), F.lit(after))
    said = rolled.join(kept, "conv_id").groupBy("conv_id", "n_turns", "n_copies").agg(
        F.array_sort(F.collect_list(F.struct("pos", shown.alias("said")))).alias("all"))
    return said.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), "n_copies",
                       F.array_join(F.transform("all", lambda x: x["said"]), "").alias("text"))
