"""Drop lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.llm.text import BLANKS, lower_ascii, row_keys, whole_text
from sievepoint.runtime import fits_broadcast, materialize

# Hashes that a large table of shared lines broadcasts ahead of its shuffle.
HOT_LINES = 100_000


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _hits(lines: DataFrame, shared: DataFrame, most: int = HOT_LINES) -> DataFrame:
    """Lines whose hash is in ``shared`` (h1, h2, docs).

    A table within the broadcast bounds meets the lines where they are. Of a larger one the ``most`` widespread
    hashes are broadcast, and the lines that they settle are spread by their row; only hashes rarer than all of
    these are matched by a shuffle, so no task gets a line that a large share of the documents holds.
    """
    keys = ["h1", "h2"]
    if fits_broadcast(shared):
        return lines.join(F.broadcast(shared.select(*keys)), keys, "left_semi")
    hot = shared.orderBy(F.desc("docs"), *keys).limit(most).select(*keys, F.lit(True).alias("hot"))
    marked = lines.join(F.broadcast(materialize(hot)), keys, "left")
    spread = F.when(F.col("hot"), 1 + F.pmod(F.xxhash64("k1", "pos"), F.lit(1 << 20))).otherwise(F.lit(0))
    cold = shared.select(*keys, F.lit(0).cast("long").alias("salt"), F.lit(True).alias("cold"))
    found = marked.withColumn("salt", spread.cast("long")).join(cold, [*keys, "salt"], "left")
    return found.where("hot OR cold").select(*lines.columns)


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Remove every line whose key is found in at least ``min_docs`` documents.

    The key is the line without ASCII white space at its ends, A-Z lower-cased. Lines are exploded and
    hashed to 128 bits, distinct documents are counted per hash, and hits come back as line positions,
    so that only the last join moves texts. Returns ``docs`` with ``text`` rewritten and ``n_lines``
    (before) and ``n_dropped`` added; columns of these two names are replaced.

    A NULL or empty text is one empty line, and its new text is empty. Keys shorter than ``min_chars``
    stay. Rows with the same ``doc_id`` count as one document; rows without an id count by their text.
    Repeated rows all come back. An empty table gives an empty result.
    """
    base = docs.select(F.struct("*").alias("row"), *row_keys(F.col("doc_id"), F.col("text")),
                       F.coalesce(F.col("doc_id"), F.xxhash64("text")).alias("doc"),
                       whole_text("text").alias("body"))
    key = line_key(F.col("line"))
    lines = (base.select("k1", "k2", "doc", F.posexplode_outer(F.split("body", "\n", -1)).alias("pos", "line"))
             .select("k1", "k2", "doc", "pos", key.alias("key"))
             .where(F.length("key") >= min_chars)
             .select("k1", "k2", "doc", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("#"), "key").alias("h2")))
    shared = materialize(lines.groupBy("h1", "h2").agg(F.count_distinct("doc").alias("docs"))
                         .where(F.col("docs") >= min_docs))
    hits = (_hits(lines.select("k1", "k2", "pos", "h1", "h2"), shared)
            .groupBy("k1", "k2").agg(F.collect_set("pos").alias("hit")))
    all_lines = F.split("body", "\n", -1)
    none = F.array().cast("array<int>")
    kept = (base.select("row", "k1", "k2", all_lines.alias("lines"))
            .join(hits, ["k1", "k2"], "left")
            .select("row", F.size("lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size("hit"), F.lit(0)).cast("long").alias("n_dropped"), "lines",
                    F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("hit", none)).alias("stay")))
    text = F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return kept.select(*(text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in names),
                       "n_lines", "n_dropped")
