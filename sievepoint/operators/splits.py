"""Reproducible splits and noise by hash order of the row key.

A cut is the hash of the k-th row in hash order. It is found by counting rows per hash prefix,
then ranking only the rows that share the cut's prefix; md5 spreads keys evenly, so that group
is about n / 65536 rows. Membership is then one comparison per row, and wide rows never move.
"""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sievepoint.functions.hashing import normal, order_key, salted_order_key, uniform
from sievepoint.operators.lookup import lookup_join
from sievepoint.operators.selection import select_positions
from sievepoint.runtime import fits_broadcast, materialize

PREFIX_DIGITS = 4


class _Prefixes:
    """Rows per (stratum, hash prefix), written once: stratum sizes and cuts both come from it.

    ``keys``: (stratum, h), with few strata, so the table has at most 65536 rows for each.
    """

    def __init__(self, keys: DataFrame):
        self.keys = keys.withColumn("_p", F.substring("h", 1, PREFIX_DIGITS))
        self.counts = materialize(self.keys.groupBy("stratum", "_p").agg(F.count(F.lit(1)).alias("_n")))
        self.sizes = self.counts.groupBy("stratum").agg(F.sum("_n").alias("n"))

    def cuts(self, wanted: DataFrame) -> DataFrame:
        """(stratum, cuts): the hashes at the wanted 1-based positions (stratum, cut, k), in order."""
        through = W.partitionBy("stratum").orderBy("_p").rowsBetween(W.unboundedPreceding, W.currentRow)
        reach = (self.counts.withColumn("_to", F.sum("_n").over(through))
                 .withColumn("_from", F.col("_to") - F.col("_n")))
        w = wanted.select(F.col("stratum").alias("_ws"), "cut", "k")
        same = F.col("stratum").eqNullSafe(F.col("_ws"))
        # One row per stratum and cut.
        aimed = materialize(reach.join(
            _small(w), same & (F.col("k") > F.col("_from")) & (F.col("k") <= F.col("_to"))).select(
            F.col("stratum").alias("_as"), F.col("_p").alias("_ap"), "cut", (F.col("k") - F.col("_from")).alias("_rn")))
        here = F.col("stratum").eqNullSafe(F.col("_as")) & (F.col("_p") == F.col("_ap"))
        near = self.keys.join(_small(aimed.select("_as", "_ap").distinct()), here)
        ranked = near.select("stratum", "_p", "h", F.row_number().over(
            W.partitionBy("stratum", "_p").orderBy("h")).cast("long").alias("_rank"))
        hit = ranked.join(_small(aimed), here & (F.col("_rank") == F.col("_rn")))
        return materialize(hit.groupBy("stratum").agg(F.sort_array(F.collect_list("h")).alias("cuts")))


def _small(table: DataFrame) -> DataFrame:
    """Broadcast a table of strata within the bounds; more strata than that are joined by a shuffle."""
    return F.broadcast(table) if fits_broadcast(table) else table


def _with_cuts(df: DataFrame, stratum: Column, cuts: DataFrame) -> DataFrame:
    small = cuts.select(F.col("stratum").alias("_s"), F.col("cuts").alias("_cuts"))
    return df.join(_small(small), stratum.eqNullSafe(F.col("_s")), "left").drop("_s")


def _quotas(sizes: DataFrame, share: float) -> DataFrame:
    """Split ``ceil(share * n)`` over the strata by largest remainder."""
    everything = W.partitionBy(F.lit(0))  # one row per class
    exact = (sizes.withColumn("_n", F.sum("n").over(everything))
             .withColumn("_take", F.ceil(F.lit(share) * F.col("_n")))
             .withColumn("_q", F.col("n") * F.col("_take") / F.col("_n"))
             .withColumn("_base", F.floor("_q")))
    left = F.col("_take") - F.sum("_base").over(everything)
    place = F.row_number().over(everything.orderBy(
        F.desc(F.col("_q") - F.col("_base")), F.col("stratum").asc_nulls_first()))
    return exact.select("stratum", F.lit(0).alias("cut"),
                        (F.col("_base") + (place <= left).cast("int")).cast("long").alias("k"))


def split_random(df: DataFrame, key: str, share: float, label: str | None = None,
                 seed: int = 42, name: str = "is_test") -> DataFrame:
    """Holdout of ``ceil(share * n)`` rows, in proportion by ``label`` when it is given.

    ``label`` is the class column of a classifier: few values. Share 0 gives an empty holdout.
    """
    if share == 0:
        return df.withColumn(name, F.lit(False))
    stratum = F.col(label) if label else F.lit(0)
    keys = df.select(stratum.alias("stratum"), order_key(F.col(key), seed).alias("h"))
    prefixes = _Prefixes(keys)
    cuts = prefixes.cuts(_quotas(prefixes.sizes, share))
    hashed = order_key(F.col(key), seed)
    return (_with_cuts(df, stratum, cuts)
            .withColumn(name, F.coalesce(hashed <= F.col("_cuts")[0], F.lit(False))).drop("_cuts"))


def _share_cuts(keys: DataFrame, position) -> DataFrame:
    prefixes = _Prefixes(keys)
    return prefixes.cuts(prefixes.sizes.select("stratum", F.lit(0).alias("cut"), position(F.col("n")).alias("k")))


def _fold_cuts(keys: DataFrame, k: int) -> DataFrame:
    prefixes = _Prefixes(keys)
    fold = F.explode(F.sequence(F.lit(1), F.lit(k - 1)))
    wanted = prefixes.sizes.withColumn("cut", fold).select(
        "stratum", "cut", (F.col("cut") * F.floor(F.col("n") / k)
                           + F.least(F.col("cut"), F.col("n") % k)).alias("k"))
    return prefixes.cuts(wanted)


def _below(cuts: Column, h: Column) -> Column:
    return F.coalesce(F.size(F.filter(cuts, lambda c: c < h)), F.lit(0))


def kfold(df: DataFrame, key: str, k: int, seed: int = 42, name: str = "fold") -> DataFrame:
    """Shuffled folds 0..k-1; the first ``n mod k`` folds hold one row more."""
    stratum = F.lit(0)
    keys = df.select(stratum.alias("stratum"), order_key(F.col(key), seed).alias("h"))
    return (_with_cuts(df, stratum, _fold_cuts(keys, k))
            .withColumn(name, _below(F.col("_cuts"), order_key(F.col(key), seed))).drop("_cuts"))


def _value_text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def _value_keys(df: DataFrame, column: str, seed: int) -> DataFrame:
    return (df.select(_value_text(column).alias("v")).distinct()
            .select(F.lit(0).alias("stratum"), order_key(F.col("v"), seed).alias("h")))


def split_by_value(df: DataFrame, column: str, share: float, seed: int = 42,
                   name: str = "is_test") -> DataFrame:
    """Holdout of whole values: ``ceil(share * distinct values)`` of them."""
    if share == 0:
        return df.withColumn(name, F.lit(False))
    keys = _value_keys(df, column, seed)
    cuts = _share_cuts(keys, lambda n: F.ceil(F.lit(share) * n))
    hashed = order_key(_value_text(column), seed)
    return (_with_cuts(df, F.lit(0), cuts)
            .withColumn(name, F.coalesce(hashed <= F.col("_cuts")[0], F.lit(False))).drop("_cuts"))


def kfold_by_value(df: DataFrame, column: str, k: int, seed: int = 42, name: str = "fold") -> DataFrame:
    cuts = _fold_cuts(_value_keys(df, column, seed), k)
    return (_with_cuts(df, F.lit(0), cuts)
            .withColumn(name, _below(F.col("_cuts"), order_key(_value_text(column), seed))).drop("_cuts"))


def split_by_time(df: DataFrame, ts: str, marker: datetime, name: str = "is_test") -> DataFrame:
    """Train before ``marker``, test from it on; a missing time is in neither part."""
    return df.filter(F.col(ts).isNotNull()).withColumn(name, F.col(ts) >= F.lit(marker))


def simple_sample(df: DataFrame, key: str, share: float = 0.995, seed: int = 42,
                  name: str = "in_sample") -> DataFrame:
    """Mark ``round(share * n)`` rows; the unmarked rows are the remainder."""
    keys = df.select(F.lit(0).alias("stratum"), order_key(F.col(key), seed).alias("h"))
    cuts = _share_cuts(keys, lambda n: F.bround(F.lit(share) * n).cast("long"))
    return (_with_cuts(df, F.lit(0), cuts)
            .withColumn(name, F.coalesce(order_key(F.col(key), seed) <= F.col("_cuts")[0], F.lit(False)))
            .drop("_cuts"))


def shuffle_marks(df: DataFrame, key: str, repeats: int, share: float = 0.2, seed: int = 0,
                  name: str = "is_test") -> DataFrame:
    """``repeats`` independent holdouts of ``ceil(share * n)`` as one array of Booleans on each row.

    Only keys are repeated to find the cuts; rows are neither copied nor moved.
    """
    many = df.select(key, F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("stratum"))
    keys = many.select("stratum", salted_order_key(F.col(key), F.col("stratum"), seed).alias("h"))
    # One row per repeat.
    cuts = {r.stratum: r.cuts[0] for r in _share_cuts(keys, lambda n: F.ceil(F.lit(share) * n)).collect()}
    marks = [F.coalesce(salted_order_key(F.col(key), F.lit(r), seed) <= F.lit(cuts.get(r)), F.lit(False)) for r in range(repeats)]
    return df.withColumn(name, F.array(*marks))


def shuffle_splits(df: DataFrame, key: str, repeats: int, share: float = 0.2, seed: int = 0,
                   name: str = "is_test") -> DataFrame:
    """The same holdouts with one row per repeat and input row, for callers that want all copies."""
    return shuffle_marks(df, key, repeats, share, seed, "_marks").select(
        *df.columns, F.posexplode("_marks").alias("repeat", name))


def _row_order(df: DataFrame, key: str) -> Column:
    """NULL keys first, then by key; rows with one key by a hash of the row. Equal rows cannot be told apart."""
    return F.struct(F.col(key).isNotNull().alias("known"), F.col(key).alias("key"), F.xxhash64(*df.columns).alias("tie"))


def _chunk_marks(df: DataFrame, key: str, ends) -> list:
    """Place of the first row of every chunk but the first; ``ends`` maps n to an array of 0-based starts."""
    keys = df.select(F.lit(0).alias("g"), _row_order(df, key).alias("o"))
    n = df.count()
    wanted = df.sparkSession.range(1).select(F.posexplode(ends(F.lit(n))).alias("want", "k")).select("want", F.lit(0).alias("g"), "k")
    # One row per chunk boundary: the chunk count is a parameter.
    return [r.o for r in sorted(select_positions(keys, wanted).collect(), key=lambda r: r.want)]


def _chunk_number(df: DataFrame, key: str, marks: list) -> Column:
    number, k, tie = F.lit(0), F.col(key), F.xxhash64(*df.columns)
    for mark in marks:
        if not mark.known:
            reached = k.isNotNull() | (tie >= F.lit(mark.tie))
        else:
            reached = F.coalesce((k > F.lit(mark.key)) | ((k == F.lit(mark.key)) & (tie >= F.lit(mark.tie))), F.lit(False))
        number = number + reached.cast("int")
    return number


def contiguous_folds(df: DataFrame, key: str, k: int = 5, name: str = "fold") -> DataFrame:
    """Unshuffled folds over the key order; the first ``n mod k`` folds hold one row more.

    NULL keys come first. Rows that share a key are parted by a hash of the whole row; only rows that are equal in
    every column always share a fold.
    """
    starts = lambda n: F.transform(
        F.sequence(F.lit(1), F.lit(k - 1)),
        lambda i: (i * F.floor(n / k) + F.least(i.cast("long"), n % k)).cast("long"))
    return df.withColumn(name, _chunk_number(df, key, _chunk_marks(df, key, starts)))


def row_range_chunks(df: DataFrame, key: str, n_chunks: int, name: str = "chunk") -> DataFrame:
    """Chunk i holds positions ``i * (n + 1) // c`` up to the next start."""
    starts = lambda n: F.transform(
        F.sequence(F.lit(1), F.lit(n_chunks - 1)),
        lambda i: F.floor(i * (n + 1) / n_chunks).cast("long"))
    return df.withColumn(name, _chunk_number(df, key, _chunk_marks(df, key, starts)))


def split_chronological(df: DataFrame, group: str, ts: str, key: str, share: float = 0.8,
                        name: str = "is_train") -> DataFrame:
    """First ``floor(share * n)`` rows by time of each group train; rows with no group are dropped.

    Nothing is sorted: each group's last training row is found by counting, and looked up by the wide rows.
    """
    present = df.filter(F.col(group).isNotNull())
    own = F.struct(F.col(ts).isNull().alias("late"), F.col(ts).alias("t"), F.col(key).alias("k"))
    keys = present.select(F.col(group).alias("g"), own.alias("o"))
    sizes = materialize(keys.groupBy("g").agg(F.count(F.lit(1)).alias("n")))
    # The row at 0-based position floor(share * n) - 1 is the last one to train on.
    wanted = materialize(sizes.select("g", (F.floor(F.lit(share) * F.col("n")) - 1).alias("k")).withColumn("want", F.monotonically_increasing_id()))
    last = select_positions(keys, wanted).join(wanted.select("want", F.col("g").alias(group)), "want")
    last = materialize(last.select(group, F.col("o").alias("_cut")))
    return (lookup_join(present, last, [group])
            .withColumn(name, F.coalesce(own <= F.col("_cut"), F.lit(False))).drop("_cut"))


def noise_features(df: DataFrame, key: str, columns: list[str], level: float = 1.0,
                   share: float = 0.6, seed: int = 0) -> DataFrame:
    """Multiply ``floor(share * n)`` rows by N(1, level); each column meets the same rows and factors."""
    keys = df.select(F.lit(0).alias("stratum"), order_key(F.col(key), seed).alias("h"))
    cuts = _share_cuts(keys, lambda n: F.floor(F.lit(share) * n))
    picked = F.coalesce(order_key(F.col(key), seed) <= F.col("_cuts")[0], F.lit(False))
    factor = F.lit(1.0) + F.lit(float(level)) * normal(F.col(key), seed)
    noisy = _with_cuts(df, F.lit(0), cuts)
    return noisy.select(*(F.when(picked, F.col(c) * factor).otherwise(F.col(c)).alias(c)
                          if c in columns else F.col(c) for c in df.columns))


def noise_label(df: DataFrame, key: str, label: str, ratio: float, seed: int = 0) -> DataFrame:
    """Flip a label when its row is drawn at least once.

    Drawing ``ratio * n`` rows with replacement leaves a row undrawn with chance ``exp(-ratio)``.
    """
    drawn = uniform(F.col(key), seed, "label") < F.lit(1.0 - math.exp(-ratio))
    return df.withColumn(label, F.when(drawn, ~F.col(label)).otherwise(F.col(label)))


def split_data(df: DataFrame, method: str = "random", *, key: str, share: float = 0.2,
               label: str | None = None, column: str | None = None, ts: str | None = None,
               marker: datetime | None = None, folds: int | None = None, seed: int = 42) -> DataFrame:
    """One entry for every split: adds ``fold`` when ``folds`` is given, else ``is_test``."""
    if method == "split_by_time":
        if folds:
            raise ValueError("folds need a random split or a split by feature")
        return df.withColumn("is_test", F.lit(False)) if share == 0 else split_by_time(df, ts, marker)
    if method == "split_by_feature":
        return (kfold_by_value(df, column, folds, seed) if folds
                else split_by_value(df, column, share, seed))
    return kfold(df, key, folds, seed) if folds else split_random(df, key, share, label, seed)
