"""Approximate nearest neighbours: a small-world graph per shard, shard results merged."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sievepoint.runtime import materialize

SHARD_ROWS = 8192
LINKS = 16          # per node on upper layers, twice as many on the lowest
BUILD_WIDTH = 80
SEARCH_WIDTH = 120
QUERY_BLOCK = 512   # queries in one row of the block table
TASK_BLOCKS = 32    # blocks that one task runs against one shard


def _walk(vectors, links, query, entries, width, seen, mark):
    """Best-first search on one layer from scored entries; a heap of the ``width`` best (score, node)."""
    seen[[n for _, n in entries]] = mark
    best = list(entries)
    heapq.heapify(best)
    todo = [(-s, n) for s, n in entries]
    heapq.heapify(todo)
    while todo:
        score, node = heapq.heappop(todo)
        if len(best) >= width and -score < best[0][0]:
            break
        near = links[node]
        near = near[near >= 0]
        near = near[seen[near] != mark]
        if not len(near):
            continue
        seen[near] = mark
        scores = vectors[near] @ query
        if len(best) >= width:
            good = scores > best[0][0]
            near, scores = near[good], scores[good]
        for s, n in zip(scores.tolist(), near.tolist()):
            if len(best) < width:
                heapq.heappush(best, (s, n))
            elif s > best[0][0]:
                heapq.heapreplace(best, (s, n))
            else:
                continue
            heapq.heappush(todo, (-s, n))
    return best


def _spread(vectors, scores, nodes, most):
    """Up to ``most`` of the nodes, nearest first, leaving out for the time those closer to a chosen one."""
    order = np.argsort(-scores, kind="stable")
    nodes, scores = nodes[order], scores[order]
    if len(nodes) <= most:
        return nodes
    own = vectors[nodes]
    between = own @ own.T
    shadow = np.full(len(nodes), -np.inf)
    chosen, left = [], []
    for i, s in enumerate(scores.tolist()):
        if s > shadow[i]:
            chosen.append(i)
            if len(chosen) == most:
                break
            np.maximum(shadow, between[i], out=shadow)
        else:
            left.append(i)
    return nodes[chosen + left[:most - len(chosen)]]


def build_graph(vectors: np.ndarray, width: int = BUILD_WIDTH, m: int = LINKS) -> tuple[np.ndarray, int]:
    """Neighbour numbers as one flat array (layers, nodes, 2 m), -1 where there is none, and the entry node."""
    n = len(vectors)
    level = np.minimum(-np.log(1 - np.random.default_rng(n).random(n)) / math.log(m), 15).astype(int)
    links = np.full((int(level.max()) + 1, n, 2 * m), -1, np.int32)
    seen = np.full(n, -1, np.int32)
    mark, entry = 0, 0
    for node in range(1, n):
        query, top = vectors[node], level[entry]
        entries = [(float(vectors[entry] @ query), entry)]
        for layer in range(top, -1, -1):
            mark += 1
            joins = layer <= level[node]
            found = _walk(vectors, links[layer], query, entries, width if joins else 1, seen, mark)
            entries = found if joins else [max(found)]
            if not joins:
                continue
            most = m if layer else 2 * m
            own = _spread(vectors, np.array([s for s, _ in found]), np.array([x for _, x in found], np.int32), m)
            links[layer, node, :len(own)] = own
            for other in own.tolist():
                row = links[layer, other, :most]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = node
                else:
                    pool = np.append(row, np.int32(node))
                    row[:] = _spread(vectors, vectors[pool] @ vectors[other], pool, most)
        if level[node] > top:
            entry = node
    return links, entry


def search_graph(vectors, links, entry, queries, count, width=SEARCH_WIDTH) -> list[np.ndarray]:
    """For each query the numbers of its ``count`` nearest found."""
    seen, out = np.full(len(vectors), -1, np.int32), []
    for mark, query in enumerate(queries):
        found = [(float(vectors[entry] @ query), entry)]
        for layer in range(len(links) - 1, -1, -1):
            found = _walk(vectors, links[layer], query, found, max(width, count) if layer == 0 else 1,
                          seen, mark * len(links) + layer)
            found = found if layer == 0 else [max(found)]
        out.append(np.array([n for _, n in heapq.nlargest(count, found)], np.int32))
    return out


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node")
    vectors = np.stack(rows.vector.to_numpy()).astype(np.float64)
    links, entry = build_graph(vectors.astype(np.float32))
    return pd.DataFrame([{
        "dim": rows.dim.iloc[0], "shard": rows.shard.iloc[0], "nodes": rows.node.to_numpy(np.int64).tobytes(),
        "vectors": vectors.tobytes(), "layers": len(links), "links": links.tobytes(), "entry": entry}])


def _searched(count: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                nodes = np.frombuffer(row.nodes, np.int64)
                vectors = np.frombuffer(row.vectors, np.float64).reshape(len(nodes), row.dim)
                links = np.frombuffer(row.links, np.int32).reshape(row.layers, len(nodes), 2 * LINKS)
                queries = np.stack([q["vector"] for q in row.queries]).astype(np.float64)
                small = vectors.astype(np.float32)
                found = search_graph(small, links, row.entry, queries.astype(np.float32), count)
                yield pd.DataFrame({
                    "query": np.repeat([q["node"] for q in row.queries], [len(f) for f in found]),
                    "node": nodes[np.concatenate(found)],
                    "score": np.concatenate([vectors[f] @ q for f, q in zip(found, queries)])})
    return of


def nearest(table: DataFrame, queries, k: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest rows by inner product for each row of ``table`` (vec_id, embedding) that ``queries`` selects.

    Equal vectors are one node of the index, with their ``k`` + 1 least ids: that is all a result can hold
    of them, so a third of all rows may be one vector. Nodes are dealt to shards of about ``shard_rows`` by hash and
    a layered graph is built for each, stored as flat arrays in one row. Blocks of distinct queries meet
    every shard; the best of all shards are merged, expanded to ids, and each query drops itself.

    Returns query_id, rank (from 1), vec_id, score: nearest first, ties to the smaller id, in double precision on
    the given vectors. Rows with a NULL id, a NULL, empty or zero vector, or a NULL or non-finite component
    take no part. Vectors of different length never meet. Repeated rows count once; one id with several
    vectors is a candidate with each. Other columns are ignored. No valid row, no result.
    """
    large = F.lit(float("inf"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < large))
    valid = (table.select("vec_id", "embedding")
             .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite
                    & F.exists("embedding", lambda x: x != 0))
             .select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector")))
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    nodes = (valid.distinct().withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k + 1)
             .groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
             .select(F.col("ids")[0].alias("node"), F.size("vector").alias("dim"), "vector", "ids"))
    # Two vectors of one id could share a node number; the hash tells them apart.
    nodes = materialize(nodes.withColumn("node", F.xxhash64("node", "vector")))
    asked = materialize(valid.where(queries).distinct().join(nodes.select("vector", "node"), "vector")
                        .select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")))
    shards = {r.dim: max(1, math.ceil(r["count"] / shard_rows)) for r in nodes.groupBy("dim").count().collect()}
    if not shards:
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("query").alias("vec_id"), F.lit(0.0).alias("score"))
    of_dim = F.lit(0)
    for dim, n in shards.items():
        of_dim = F.when(F.col("dim") == dim, F.pmod(F.xxhash64("node", F.lit("shard")), F.lit(n)).cast("int")).otherwise(of_dim)
    graphs = materialize(
        nodes.select("dim", of_dim.alias("shard"), "node", "vector")
        .repartition(max(8, sum(shards.values())), "dim", "shard").groupBy("dim", "shard")
        .applyInPandas(_built, "dim int, shard int, nodes binary, vectors binary, layers int, links binary, entry int"))
    wanted = nodes.join(asked.select(F.col("query").alias("node")).distinct(), "node", "left_semi")
    blocks = max(1, math.ceil(wanted.count() / QUERY_BLOCK))
    lanes = math.ceil(blocks / TASK_BLOCKS)
    packed = (wanted.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.lit(blocks)).cast("int"))
              .groupBy("dim", "block").agg(F.collect_list(F.struct("node", "vector")).alias("queries"))
              .withColumn("lane", F.pmod(F.col("block"), F.lit(lanes))))
    every = F.lit(None).cast("array<int>")
    for dim, n in shards.items():
        every = F.when(F.col("dim") == dim, F.sequence(F.lit(0), F.lit(n - 1))).otherwise(every)
    on, tasks = ["dim", "shard", "lane"], max(8, min(10_000, sum(shards.values()) * lanes))
    met = (packed.withColumn("shard", F.explode(every)).repartition(tasks, *on)
           .join(graphs.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).repartition(tasks, *on)
                 .hint("shuffle_hash"), on))
    found = met.select("dim", "nodes", "vectors", "layers", "links", "entry", "queries").mapInPandas(
        _searched(k + 1), "query long, node long, score double")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    ids = nodes.select("node", "ids")
    merged = (found.join(ids, "node").withColumn("first", F.col("ids")[0])
              .withColumn("at", F.row_number().over(by_score)).where(F.col("at") <= k + 1)
              .select("query", "score", F.explode("ids").alias("vec_id"))
              .groupBy("query").agg(F.slice(F.array_sort(F.collect_list(
                  F.struct((-F.col("score")).alias("below"), "vec_id"))), 1, k + 1).alias("near")))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (asked.join(merged, "query").select("query_id", F.posexplode(others).alias("pos", "x"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), "x.vec_id", (-F.col("x.below")).alias("score")))
