"""Column selection by name, by variety, and assembly of the feature vector."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

from sievepoint.constants import FILL_NUMBER, TRIM_NAMES, TRIM_PATTERNS
from sievepoint.operators.fitted import numeric_columns, value_counts

NOT_FEATURES = ("y", "ts", "idx")


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(re.sub(r"\s+", "", c) for c in df.columns))


def declared_only(df: DataFrame, declared, extra: tuple[str, ...] = ()) -> DataFrame:
    wanted = set(declared) | set(extra)
    return df.select(*(c for c in df.columns if c in wanted))


def trimmed_names(columns: list[str], patterns=TRIM_PATTERNS, names=TRIM_NAMES, exceptions=()) -> list[str]:
    """Columns to drop. The name list counts only while there are patterns."""
    if not patterns:
        return []
    hit = {c for c in columns if any(re.search(p, c) for p in patterns)}
    drop = (hit | set(names)) - set(exceptions)
    return [c for c in columns if c in drop]


def trim(df: DataFrame, patterns=TRIM_PATTERNS, names=TRIM_NAMES, exceptions=()) -> DataFrame:
    return df.drop(*trimmed_names(df.columns, patterns, names, exceptions))


def variety(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column, NULL counted as one."""
    return value_counts(df, columns).groupBy("feature").agg(F.count(F.lit(1)).alias("n_values"))


def keep_low_variety(df: DataFrame, bound: int) -> DataFrame:
    """Numbers, Booleans, and text columns with fewer than ``bound`` distinct values."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    # One row per column.
    few = {r.feature for r in variety(df, texts).filter(F.col("n_values") < bound).collect()} if texts else set()
    return df.select(*(c for c in texts if c in few), *numeric_columns(df, booleans=True))


def feature_names(df: DataFrame, id_column: str) -> list[str]:
    return [c for c in df.columns if c not in (*NOT_FEATURES, id_column)]


def feature_matrix(df: DataFrame, features: list[str], keep: tuple[str, ...],
                   fill: float = FILL_NUMBER) -> DataFrame:
    """``features`` in fixed order as doubles with ``fill`` for missing, beside the kept columns."""
    return df.select(*keep, *(F.coalesce(F.col(c).cast("double"), F.lit(float(fill))).alias(c)
                              for c in features))
