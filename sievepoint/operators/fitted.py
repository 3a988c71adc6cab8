"""Fitted state as small tables: popularity ranks, rare values, ordinal codes, scales.

``fit_*`` returns a written table keyed by (feature, value); ``apply_*`` looks it up. All columns
are fitted in one shuffle through the long form (feature, value, count).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sievepoint.constants import RANK_SHARE
from sievepoint.functions.hashing import md5_mod
from sievepoint.operators.lookup import Sized, lookup_join
from sievepoint.operators.ordered import group_index
from sievepoint.runtime import BROADCAST_ROWS, PLAN_BYTES, materialize

# A column with no more fitted values than this is looked up in a constant map.
LITERAL_VALUES = 64


def long_form(df: DataFrame, columns: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per cell: (keep..., feature, value as text)."""
    cells = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                      for c in columns))
    return df.select(*keep, F.explode(cells).alias("_cell")).select(*keep, "_cell.feature", "_cell.value")


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Frequency of every value of every column, NULL included."""
    return long_form(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Fitted:
    """A fitted table made ready for rows, so that applying it starts no job.

    A column with at most ``LITERAL_VALUES`` fitted values becomes one constant map, so any number of
    such columns cost one projection. The others are measured slices to join. The shortest are broadcast, as long as all
    that are have no more than ``PLAN_BYTES`` together, however many columns there are.
    """
    value: str
    constants: dict[str, str]
    kind: str
    slices: dict[str, Sized]
    lengths: dict[str, int]

    @property
    def features(self) -> set[str]:
        return set(self.constants) | set(self.slices)

    @property
    def shuffled(self) -> bool:
        """Whether a column is too long for a broadcast, so that rows have to be counted and shuffled to look it up."""
        return any(not s.small for s in self.slices.values())


def prepare(state: DataFrame | Fitted, value: str) -> Fitted:
    """Collect the small columns of a table (feature, value, ``value``) and measure the large ones.

    A row without a value holds the length of its feature's list.
    """
    if isinstance(state, Fitted):
        return state
    # One row per column, then at most LITERAL_VALUES rows for each.
    whole = F.struct(F.col(value).alias("length"))
    counted = state.groupBy("feature").agg(F.count("value").alias("n"), F.sum(F.octet_length("value")).alias("bytes"),
                                           F.max(F.when(F.col("value").isNull(), whole)).alias("whole")).collect()
    sizes = {r.feature: r.n for r in counted}
    lengths = {r.feature: r.whole.length for r in counted if r.whole is not None}
    known: dict[str, dict] = {c: {} for c, n in sizes.items() if n <= LITERAL_VALUES}
    named = state.where(F.col("value").isNotNull())
    for r in named.where(F.col("feature").isin(list(known))).select("feature", "value", value).collect():
        known[r.feature][r.value] = r[value]
    # 16 bytes for the place of each text and of each number, as ``measured_size`` has it.
    taken, small = 0, set()
    for r in sorted((r for r in counted if r.feature not in known), key=lambda r: (r.bytes + 32 * r.n, r.feature)):
        taken += r.bytes + 32 * r.n
        if r.n <= BROADCAST_ROWS and taken <= PLAN_BYTES:
            small.add(r.feature)
    slices = {c: Sized(named.where(F.col("feature") == c).select(F.col("value").alias("_v"), F.col(value).alias("_found")), c in small)
              for c in sizes if c not in known}
    return Fitted(value, {c: json.dumps(v) for c, v in known.items()}, state.schema[value].dataType.simpleString(), slices, lengths)


def _look_up(df: DataFrame, state: Fitted, columns: list[str], pick) -> DataFrame:
    """Look each column up; ``pick(column, found)`` builds the new column."""
    known = {c: F.try_element_at(F.from_json(F.lit(state.constants.get(c, "{}")), f"map<string,{state.kind}>"), F.col(c).cast("string"))
             for c in columns if c not in state.slices}
    picked = dict(pick(c, found) for c, found in known.items())
    # Constant maps first: rows are shuffled with short numbers in place of texts.
    out = df.withColumns(picked) if picked else df
    for i, c in enumerate(columns):
        if c in state.slices:
            part = Sized(state.slices[c].table.select(F.col("_v").alias(f"_v{i}"), F.col("_found").alias(f"_found{i}")), state.slices[c].small)
            # Frequent values are those of the rows as they came, without the lookups of the columns before.
            asked = F.col(c).cast("string").alias(f"_v{i}")
            out = lookup_join(out.withColumn(f"_v{i}", asked), part, [f"_v{i}"], counted=df.select(asked))
    late = dict(pick(c, F.col(f"_found{i}")) for i, c in enumerate(columns) if c in state.slices)
    named = [pick(c, F.lit(None))[0] for c in columns]
    fresh = [late[n].alias(n) if n in late else F.col(n) for n in dict.fromkeys(named) if n not in df.columns]
    return out.select(*(late[c].alias(c) if c in late else F.col(c) for c in df.columns), *fresh)


def fit_rank(df: DataFrame, columns: list[str], share: float = RANK_SHARE) -> DataFrame:
    """Rank values by falling count, ties by value, and keep the first ``int(share * distinct)``.

    Each feature also has one row with no value, whose rank is the length of its kept list.
    """
    counts = value_counts(df, columns).filter(F.col("value").isNotNull())
    ranked = group_index(counts, [F.desc("n"), F.col("value")], ["feature"], "rank")
    sizes = ranked.groupBy("feature").agg(F.floor(F.count(F.lit(1)) * F.lit(share)).cast("long").alias("kept"))
    # One row per fitted column.
    kept = (ranked.join(F.broadcast(sizes), "feature").filter(F.col("rank") < F.col("kept"))
            .select("feature", "value", "rank", "n"))
    rest = sizes.select("feature", F.lit(None).cast("string").alias("value"),
                        F.col("kept").alias("rank"), F.lit(None).cast("long").alias("n"))
    return materialize(kept.unionByName(rest))


def apply_rank(df: DataFrame, state: DataFrame | Fitted, columns: list[str]) -> DataFrame:
    """Add ``<column>_rank``; an unranked value gets the list length, NULL stays NULL."""
    ready = prepare(state, "rank")

    def pick(c: str, found: Column):
        return f"{c}_rank", F.when(F.col(c).isNotNull(), F.coalesce(found, F.lit(ready.lengths.get(c, 0))))
    return _look_up(df, ready, columns, pick)


def fit_common(df: DataFrame, columns: list[str], thresh: int = 10) -> DataFrame:
    """Lower-cased values that occur more than ``thresh`` times."""
    counts = value_counts(df.select(*(F.lower(c).alias(c) for c in columns)), columns)
    return materialize(counts.filter(F.col("value").isNotNull() & (F.col("n") > thresh)))


def collapse_rare(df: DataFrame, state: DataFrame | Fitted, columns: list[str], other: str = "Other") -> DataFrame:
    """Lower-case the columns and replace values outside the fitted table by ``other``."""
    lowered = df.select(*(F.lower(c).alias(c) if c in columns else F.col(c) for c in df.columns))

    def pick(c: str, found: Column):
        return c, F.when(F.col(c).isNull() | found.isNotNull(), F.col(c)).otherwise(F.lit(other))
    return _look_up(lowered, prepare(state, "n"), columns, pick)


def fit_codes(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Code values 0, 1, ... by first appearance in ``key`` order."""
    first = (long_form(df, columns, (key,)).filter(F.col("value").isNotNull())
             .groupBy("feature", "value").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n")))
    coded = group_index(first, [F.col("first"), F.col("value")], ["feature"], "code")
    return materialize(coded.select("feature", "value", "code", "n"))


def apply_codes(df: DataFrame, state: DataFrame | Fitted, columns: list[str]) -> DataFrame:
    """Replace values by their codes; unseen and NULL are -1."""
    return _look_up(df, prepare(state, "code"), columns, lambda c, found: (c, F.coalesce(found, F.lit(-1))))


def fit_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation per column, in one pass."""
    one = df.agg(*(F.avg(c).alias(f"m_{c}") for c in columns),
                 *(F.stddev_pop(c).alias(f"s_{c}") for c in columns))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"),
                                        F.col(f"s_{c}").alias("std")) for c in columns)))
    return one.select(rows.alias("_r")).select("_r.*")


def apply_scale(df: DataFrame, state: DataFrame, columns: list[str]) -> DataFrame:
    """``(x - mean) / std`` from the training table; a constant column is only centred."""
    fitted = {r.feature: r for r in state.filter(F.col("feature").isin(columns)).collect()}

    def scaled(c: str) -> Column:
        return ((F.col(c) - F.lit(fitted[c]["mean"])) / F.lit(fitted[c]["std"] or 1.0)).alias(c)
    return df.select(*(scaled(c) if c in fitted else F.col(c) for c in df.columns))


def one_hot_vector(df: DataFrame, state: DataFrame | Fitted, column: str, name: str | None = None) -> DataFrame:
    """Indicators as one sparse vector, for any number of fitted values; unseen and NULL are all zero."""
    ready = prepare(state, "code")
    size = (ready.slices[column].table.count() if column in ready.slices else len(json.loads(ready.constants.get(column, "{}"))))
    coded = _look_up(df, ready, [column], lambda c, found: ("_code", F.coalesce(found, F.lit(size)).cast("double")))
    # The last code stands for "none" and is dropped from the vector.
    known = df.sparkSession.createDataFrame([(float(size),)], "_code double")
    encoder = OneHotEncoder(inputCols=["_code"], outputCols=[name or f"{column}_flags"], dropLast=True).fit(known)
    return encoder.transform(coded).drop("_code")


def one_hot(df: DataFrame, state: DataFrame, column: str, limit: int = 1000) -> DataFrame:
    """Indicators as 0/1 columns, one per fitted code; ``limit`` guards the width of the frame.

    Beyond it ``one_hot_vector`` holds the same in one column.
    """
    values = [r.value for r in state.filter(F.col("feature") == column).orderBy("code").limit(limit + 1).collect()]
    if len(values) > limit:
        raise ValueError(f"{column} has over {limit} values; use one_hot_vector")
    text = F.col(column).cast("string")
    return df.select("*", *(F.coalesce((text == v).cast("int"), F.lit(0)).alias(f"{column}_{i}")
                            for i, v in enumerate(values)))


def hash_encode(df: DataFrame, columns: list[str], n: int = 8) -> DataFrame:
    """Replace ``columns`` by ``n`` counters; each value adds one to counter ``md5(value) mod n``."""
    slots = [md5_mod(F.coalesce(F.col(c).cast("string"), F.lit("None")), n) for c in columns]
    marked = df.select("*", *(s.alias(f"_h{i}") for i, s in enumerate(slots)))
    rest = [c for c in df.columns if c not in columns]
    counters = []
    for j in range(n):
        total = F.lit(0)
        for i in range(len(columns)):
            total = total + (F.col(f"_h{i}") == j).cast("int")
        counters.append(total.alias(f"col_{j}"))
    return marked.select(*rest, *counters)


def fit_leave_one_out(df: DataFrame, columns: list[str], y: str) -> DataFrame:
    """(feature, value, total, n) of the labels, with one row per feature for all labels and no value."""
    label = F.col(y).cast("double")
    cells = long_form(df.withColumn("_y", label), columns, ("_y",))
    sums = (F.sum("_y").alias("total"), F.count("_y").alias("n"))
    own = cells.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(*sums)
    every = cells.groupBy("feature").agg(*sums).select("feature", F.lit(None).cast("string").alias("value"), "total", "n")
    return materialize(own.unionByName(every))


def apply_leave_one_out(df: DataFrame, state: DataFrame, column: str, y: str | None = None, name: str | None = None) -> DataFrame:
    """Mean label of the fitted rows with the same value, without the row's own label where ``y`` is given.

    New rows have no part in the fit and give no ``y``. A value without any other row, unseen or NULL gets the
    mean of all labels.
    """
    mine = state.where(F.col("feature") == column)
    whole = mine.where("value IS NULL").first()
    overall = whole.total / whole.n if whole and whole.n else None
    part = mine.where("value IS NOT NULL").select(F.col("value").alias("_v"), F.col("total").alias("_sum"), F.col("n").alias("_cnt"))
    label = F.col(y).cast("double") if y else F.lit(None).cast("double")
    total = F.col("_sum") - F.coalesce(label, F.lit(0.0))
    n = F.col("_cnt") - label.isNotNull().cast("int")
    joined = lookup_join(df.withColumn("_v", F.col(column).cast("string")), part, ["_v"])
    value = F.when(n > 0, total / n).otherwise(F.lit(overall).cast("double"))
    return joined.withColumn(name or f"{column}_loo", value).drop("_v", "_sum", "_cnt")


def leave_one_out(df: DataFrame, column: str, y: str, name: str | None = None) -> DataFrame:
    """Mean label of the other rows with the same value; a lone row gets the overall mean."""
    return apply_leave_one_out(df, fit_leave_one_out(df, [column], y), column, y, name)


def categorical_columns(df: DataFrame, skip: tuple[str, ...] = ("y", "ts")) -> list[str]:
    """Everything that is not a number: text, Booleans and times."""
    return [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, T.NumericType)]


def numeric_columns(df: DataFrame, booleans: bool = False) -> list[str]:
    kinds = (T.NumericType, T.BooleanType) if booleans else T.NumericType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]
