"""Numbers of distinct values from sketches that are kept for each part of the data and merged.

A part is read once for all its columns, and never again: new data bring a sketch of their own. Only columns whose estimate lies near the
bound are counted exactly, and of these nothing but their own cells is read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from sievepoint.operators.fitted import numeric_columns
from sievepoint.operators.trim import variety

# 2^14 registers: a standard error of 0.8 %. An estimate further than ``MARGIN`` from a bound, some eight standard errors, decides.
REGISTERS, MARGIN = 14, 0.065


def sketch_columns(df: DataFrame, columns: list[str], part: str) -> DataFrame:
    """(part, feature, sketch, has_null) for each column, by one pass over all of them."""
    cells = [F.struct(F.lit(c).alias("feature"), F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), F.lit(REGISTERS)).alias("sketch"),
                      F.coalesce(F.bool_or(F.col(f"`{c}`").isNull()), F.lit(False)).alias("has_null")) for c in columns]
    if not columns:
        return df.sparkSession.createDataFrame([], "part string, feature string, sketch binary, has_null boolean")
    return df.agg(F.array(*cells).alias("all")).select(F.lit(part).alias("part"), F.inline("all"))


def merged_variety(sketches: DataFrame) -> DataFrame:
    """(feature, estimate) over all parts, NULL counted as one value. A part that is there twice counts once."""
    return sketches.groupBy("feature").agg(
        (F.hll_sketch_estimate(F.hll_union_agg("sketch")) + F.bool_or("has_null").cast("long")).alias("estimate"))


def low_variety(sketches: DataFrame, bound: int, exact) -> list[str]:
    """Features with fewer than ``bound`` distinct values, the same as exact counts give.

    ``exact`` maps a list of features to (feature, n_values) and is asked for those near the bound only.
    """
    # One row per column.
    estimates = {r.feature: r.estimate for r in merged_variety(sketches).collect()}
    near = sorted(f for f, n in estimates.items() if bound * (1 - MARGIN) <= n <= bound * (1 + MARGIN) + 1)
    counted = {r.feature: r.n_values for r in exact(near).collect()} if near else {}
    return sorted(f for f, n in estimates.items() if counted.get(f, n) < bound)


def keep_low_variety_of_parts(parts: list[DataFrame], sketches: DataFrame, bound: int) -> DataFrame:
    """What ``keep_low_variety`` gives for all parts together, from their sketches of the text columns."""
    whole = reduce(DataFrame.unionByName, parts)
    few = low_variety(sketches, bound, lambda near: variety(whole, near))
    texts = [f.name for f in whole.schema.fields if isinstance(f.dataType, T.StringType)]
    return whole.select(*(c for c in texts if c in few), *numeric_columns(whole, booleans=True))
