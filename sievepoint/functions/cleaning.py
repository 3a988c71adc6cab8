"""Missing values, Boolean text, recodes and row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sievepoint.constants import MISSING_WORDS

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above all numbers in Spark; as NULL it fails every comparison."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.select(*(F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
                       for c in df.columns))


def words_to_null(text: Column) -> Column:
    """The words that mark a missing cell of a CSV file, in exactly this spelling."""
    return F.when(~text.isin(*MISSING_WORDS), text)


def blank_to_null(text: Column) -> Column:
    """``None`` and text of spaces only are missing."""
    return F.when(~((text == "None") | text.rlike("^ *$")), text)


def normalize_missing(df: DataFrame) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*(blank_to_null(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns))


def parse_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin("t", "true"), True).when(word.isin("f", "false"), False)


def recode_yes_no(text: Column) -> Column:
    """Global recode of single letters in text columns: ``Y`` -> ``true``, ``N`` -> ``false``."""
    return F.when(text == "Y", "true").when(text == "N", "false").otherwise(text)


def recode_frame(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)} - set(keep)
    return df.select(*(recode_yes_no(F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns))


def flag_columns(text: Column, names: tuple[str, ...]) -> list[Column]:
    """Fixed-width Y/N text to one Boolean per character."""
    return [(F.substring(text, i, 1) == "Y").alias(n) for i, n in enumerate(names, 1)]


def _total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts, F.lit(0))


def zero_count(df: DataFrame, skip: tuple[str, ...] = ("y",), recoded: bool = False) -> Column:
    """Cells equal to 0; Boolean false is 0, times never are, and text only as a recoded ``false``."""
    parts = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.BooleanType):
            parts.append(F.when(~F.col(f.name), 1).otherwise(0))
        elif isinstance(f.dataType, NUMERIC):
            parts.append(F.when(F.col(f.name) == 0, 1).otherwise(0))
        elif recoded and isinstance(f.dataType, T.StringType):
            parts.append(F.when(F.col(f.name) == "false", 1).otherwise(0))
    return _total(parts)


def missing_count(df: DataFrame, skip: tuple[str, ...] = ("y",)) -> Column:
    return _total([F.col(c).isNull().cast("int") for c in df.columns if c not in skip])


def missing_flags(columns: tuple[str, ...]) -> list[Column]:
    flags = [F.col(c).isNull() for c in columns]
    return [*(f.alias(f"{c}_isna") for c, f in zip(columns, flags)),
            _total([f.cast("int") for f in flags]).alias("num_pii_na")]


def fill_missing(df: DataFrame, text: str = "missing", number: float = -100,
                 skip: tuple[str, ...] = ()) -> DataFrame:
    """Text and Boolean columns get ``text``, numbers get ``number``."""
    picked = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in skip:
            picked.append(c)
        elif isinstance(f.dataType, NUMERIC):
            picked.append(F.coalesce(c, F.lit(number).cast(f.dataType)).alias(f.name))
        else:
            picked.append(F.coalesce(c.cast("string"), F.lit(text)).alias(f.name))
    return df.select(*picked)


def categorical_text(df: DataFrame, columns: list[str], declared_text: set[str],
                     filler: str = "missing") -> DataFrame:
    """Categories as text: a missing declared string is ``nan``, any other missing is ``filler``."""
    wanted = set(columns)
    return df.select(*(
        F.coalesce(F.col(c).cast("string"), F.lit("nan" if c in declared_text else filler)).alias(c)
        if c in wanted else F.col(c) for c in df.columns))
