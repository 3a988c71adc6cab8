"""Near duplicates by SimHash: fingerprints, links by shared blocks, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from sievepoint.llm.graph import components
from sievepoint.llm.text import row_keys
from sievepoint.runtime import materialize

SEED = 42
# Shingles whose bits are counted at a time, so that memory does not grow with the text.
CHUNK = 32_768


def fingerprint_of(text: str | None, size: int = 3) -> int:
    """Unsigned 64-bit fingerprint; zero if the text has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = max(1, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        hashes = np.array([digest(join(words[i:i + size]), SEED) for i in range(at, min(n, at + CHUNK))], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(text: Column, size: int = 3) -> Column:
    """Signed 64-bit fingerprints of a text column."""
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, size) for t in texts], np.uint64).view(np.int64))
    return F.pandas_udf(of, LongType())(text)


def block_masks(radius: int, fingerprints_known: int) -> list[int]:
    """Bit masks such that two fingerprints within ``radius`` bits agree on one of them at least.

    The bits are cut into blocks; ``radius`` differing bits leave all but ``radius`` blocks alike, and a mask
    is a choice of so many blocks. With more fingerprints more blocks are cut: a mask then holds as many bits
    as the count needs, and unrelated fingerprints seldom share a key. Any number gives the same links.
    """
    blocks = radius + 2
    while blocks < radius + 6 and 64 * (blocks - radius) // blocks < fingerprints_known.bit_length():
        blocks += 1
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << k for k in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [sum(kept) for kept in combinations(masks, blocks - radius)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(known: DataFrame, radius: int = 3, crowd: int = 1024) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column ``fp``) whose closure is that of all links.

    Fingerprints meet in a bucket for each mask. Up to ``crowd`` of them are compared in pairs, so each
    meets a bounded number; larger buckets go through ``_crowd_links``, which is exact as well.
    """
    masks = [_signed(m) for m in block_masks(radius, known.count())]
    keys = F.explode(F.array(*(F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                               for i, m in enumerate(masks))))
    spread = known.select("fp", keys.alias("k")).select("fp", "k.mask", "k.key")
    buckets = (spread.groupBy("mask", "key")
               .agg(F.count(F.lit(1)).alias("n"), F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("varied"))
               .where("n > 1"))
    members = materialize(spread.join(buckets, ["mask", "key"]))
    few = members.where(F.col("n") <= crowd).select("mask", "key", "fp")
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), ["mask", "key"])
             .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
             .select("a", "b"))
    return pairs.union(_crowd_links(members.where(F.col("n") > crowd), radius)).distinct()


def _crowd_links(members: DataFrame, radius: int) -> DataFrame:
    """Links within large buckets without comparing pairs.

    Two fingerprints within r1 + r2 bits have a point within r1 of one and r2 of the other. Each names all
    points within r2 of it, over the bits that vary in its bucket; if a point has a fingerprint within r1,
    all others that named it are within r1 + r2 of that one, and so all are linked to the least of them.
    """
    near, far = radius // 2, radius - radius // 2
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("varied", i) == 1)
    points = members.select("mask", "key", "fp", bits.alias("bits"), F.col("fp").alias("point"),
                            F.lit(0).alias("steps"), F.lit(-1).alias("last"))
    reached = points
    for step in range(1, far + 1):
        flips = F.explode(F.filter("bits", lambda i: i > F.col("last")))
        flipped = F.col("point").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit")))
        points = (points.select("mask", "key", "fp", "bits", "point", flips.alias("bit"))
                  .select("mask", "key", "fp", "bits", flipped.alias("point"), F.lit(step).alias("steps"),
                          F.col("bit").alias("last")))
        reached = reached.union(points)
    named = reached.select("mask", "key", "point", "fp", "steps")
    hubs = (named.groupBy("mask", "key", "point")
            .agg(F.min("fp").alias("a"), F.min("steps").alias("least"), F.count(F.lit(1)).alias("n"))
            .where((F.col("least") <= near) & (F.col("n") > 1)).select("mask", "key", "point", "a"))
    return named.join(hubs, ["mask", "key", "point"]).where("a != fp").select("a", F.col("fp").alias("b"))


def near_duplicates(docs: DataFrame, radius: int = 3, size: int = 3) -> DataFrame:
    """Fingerprint and component of every document row: doc_id, k1, k2, fp, component_id.

    Fingerprints cover the whole text: words are runs without ASCII white space, A-Z lower-cased, in
    shingles of ``size`` words, repeats included. Texts with equal fingerprints are one node, so groups of
    copies cost one row, and nodes are linked if they differ in at most ``radius`` bits. ``component_id`` is
    the least ``doc_id`` that can be reached.

    A NULL or empty text has fingerprint zero and is linked like any other. Rows without an id take part and
    get the component's least id, NULL if it has none. Repeated rows come back as often as they are given; k1
    and k2 identify the row. Other columns are ignored, and an empty table gives an empty result.
    """
    rows = materialize(docs.select("doc_id", *row_keys(F.col("doc_id"), F.col("text")),
                                   fingerprints(F.col("text"), size).alias("fp")))
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = materialize(rooted.join(ids, "root").select("fp", "root", "component_id"))
    return rows.join(by_fp, "fp").select("doc_id", "k1", "k2", "fp", "root", "component_id")


def keep_one_of_each(docs: DataFrame, radius: int = 3, size: int = 3) -> DataFrame:
    """One row of each near-duplicate component, chosen as in ``keep_first``; all columns kept."""
    return keep_first(docs, near_duplicates(docs, radius, size))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The row of least id (rows without id last) for each ``root`` in ``found``; all columns of ``docs`` kept.

    Among rows with that id the choice is by hash of the text, and of repeated rows one stays.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2"))
    kept = found.groupBy("root").agg(first.alias("r")).select("r.k1", "r.k2")
    rows = docs.select(F.struct("*").alias("row"), *row_keys(F.col("doc_id"), F.col("text")))
    return rows.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")
