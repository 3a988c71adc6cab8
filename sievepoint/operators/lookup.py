"""Left lookups of small or large keyed tables, membership flags, merges."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.runtime import BROADCAST_ROWS, fits_broadcast, materialize

# Keys broadcast ahead of a shuffled lookup; every other key is rarer than each of these.
HOT_KEYS = 10_000
# Copies of the groups with a NULL key in a large merge, and so the tasks that share one such group's rows.
MERGE_SALTS = 256


@dataclass(frozen=True)
class Sized:
    """A table that was measured before, so that a lookup in it starts no job of its own."""
    table: DataFrame
    small: bool
    hot_keys: int = HOT_KEYS


def measured(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> Sized:
    return Sized(table, fits_broadcast(table, max_rows))


def lookup_join(rows: DataFrame, table: DataFrame | Sized, on: list[str],
                max_rows: int = BROADCAST_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Left join ``rows`` to ``table``, whose ``on`` keys are unique.

    A table of checked size is broadcast. A larger one is shuffled, but first the keys that occur
    most in ``rows`` are answered from a broadcast of at most ``HOT_KEYS`` of them (fewer where the table
    says so, for long values), so no task receives a hot key. They are counted in ``counted`` where that has the keys of
    ``rows`` at less cost.
    """
    sized = table if isinstance(table, Sized) else measured(table, max_rows)
    if sized.small:
        return rows.join(F.broadcast(sized.table), on, "left")
    return _shuffled_lookup(rows, sized.table, on, sized.hot_keys, counted)


def _shuffled_lookup(rows: DataFrame, table: DataFrame, on: list[str],
                     hot_keys: int = HOT_KEYS, counted: DataFrame | None = None) -> DataFrame:
    values = [c for c in table.columns if c not in on]
    keyed = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in on))
    frequent = ((rows if counted is None else counted).filter(keyed).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
                .orderBy(F.desc("_n"), *on).limit(hot_keys).select(*on))
    hot = materialize(frequent.join(table, on, "left")
                      .select(*on, F.struct(*values).alias("_hot_value")))
    cold = table.select(*(F.col(k).alias(f"_k_{k}") for k in on),
                        F.lit(0).alias("_spread"), F.struct(*values).alias("_cold_value"))
    marked = rows.join(F.broadcast(hot.withColumn("_is_hot", F.lit(True))), on, "left")
    # Hot and NULL keys can match nothing below; a hash of the row spreads them over the tasks.
    settled = F.col("_is_hot").isNotNull() | ~keyed
    marked = marked.withColumn(
        "_salt", F.when(settled, 1 + F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)))
        .otherwise(F.lit(0)))
    match = reduce(lambda a, b: a & b, (F.col(k) == F.col(f"_k_{k}") for k in on),
                   F.col("_salt") == F.col("_spread"))
    joined = marked.join(cold, match, "left")
    picked = [F.coalesce(F.col(f"_hot_value.{v}"), F.col(f"_cold_value.{v}")).alias(v) for v in values]
    return joined.select(*on, *(c for c in rows.columns if c not in on), *picked)


def in_list(value: Column, words: list[str]) -> Column:
    """Membership in a short fixed list; NULL counts as not listed."""
    return F.coalesce(value.isin(list(words)), F.lit(False))


def in_table(rows: DataFrame, value: Column, table: DataFrame, column: str, name: str) -> DataFrame:
    """Membership in a list held as a table: adds Boolean ``name``."""
    # Written first: the size check and the join both read it.
    listed = materialize(table.select(F.col(column).alias("_member")).distinct()
                         .withColumn("_listed", F.lit(True)))
    return (lookup_join(rows.withColumn("_member", value), listed, ["_member"])
            .withColumn(name, F.coalesce("_listed", F.lit(False)))
            .drop("_member", "_listed"))


def prepare_codes(codes: DataFrame) -> Sized:
    return measured(codes.select(F.col("code").alias("_code"), F.col("state").alias("_state"), F.lit(True).alias("_found")))


def area_state(df: DataFrame, codes: DataFrame | Sized, phone_code: str = "area_code",
               name: str = "area_code_state") -> DataFrame:
    """``(916)`` -> ``CA`` / ``non-CA`` / ``unknown``; anything but 5 characters -> ``na``."""
    token = F.col(phone_code)
    table = codes if isinstance(codes, Sized) else prepare_codes(codes)
    shaped = df.withColumn("_code", F.when(F.length(token) == 5, F.substring(token, 2, 3)))
    looked = lookup_join(shaped, table, ["_code"])
    state = (F.when(F.coalesce(F.length(token) != 5, F.lit(True)), "na")
             .when(F.col("_found").isNull(), "unknown")
             .when(F.col("_state") == "CA", "CA").otherwise("non-CA"))
    return looked.withColumn(name, state).drop("_code", "_state", "_found")


def remainder(df: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``taken``."""
    return df.join(taken.select(key), key, "left_anti")


def merge_on(rows: DataFrame, stats: DataFrame, keys: list[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Inner merge of aggregates back to rows; NULL keys meet each other, as in pandas."""
    stats = materialize(stats)
    right = stats.select(*(F.col(k).alias(f"_r_{k}") for k in keys),
                         *(c for c in stats.columns if c not in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    if fits_broadcast(stats, max_rows):
        return rows.join(F.broadcast(right), same).drop(*(f"_r_{k}" for k in keys))
    # Too many groups to broadcast. Rows with whole keys take the lookup that answers hot keys first;
    # those with a NULL key, which that lookup cannot match, are spread over copies of the few NULL groups.
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    met = lookup_join(rows.where(whole), stats.where(whole).withColumn("_met", F.lit(True)), keys, max_rows)
    met = met.where("_met").drop("_met")
    holed = right.where(~reduce(lambda a, b: a & b, (F.col(f"_r_{k}").isNotNull() for k in keys)))
    salted = rows.where(~whole).withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(MERGE_SALTS)).cast("int"))
    copies = holed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(MERGE_SALTS - 1))))
    rest = (salted.join(copies, same & (F.col("_salt") == F.col("_copy")))
            .drop("_salt", "_copy", *(f"_r_{k}" for k in keys)))
    return met.select(*rest.columns).unionByName(rest)


def union_rows(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
