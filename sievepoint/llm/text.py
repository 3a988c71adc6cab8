"""Column helpers shared by the text operators."""

from __future__ import annotations

import math
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from sievepoint.runtime import BROADCAST_BYTES, BROADCAST_ROWS, measured_size

# ASCII white space: space and the range from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ASCII texts take the built-in, which is the same for them and much faster."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, ascii_uppercase, ascii_lowercase)))


def whole_text(column: str | Column) -> Column:
    return F.coalesce(column if isinstance(column, Column) else F.col(column), F.lit(""))


def row_keys(doc_id: Column, text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a row's id and text; rows that share both are repeats of one row."""
    return [F.xxhash64(doc_id, text).alias("k1"), F.xxhash64(text, F.lit("#"), doc_id).alias("k2")]


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    Projections are merged and filters pushed down by repeating their expressions, inside a lambda even for every
    element. A generator is a border that neither crosses.
    """
    made = F.struct(*(c.alias(name) for name, c in columns.items()))
    return rows.select("*", F.explode_outer(F.array(made)).alias("made")).select(
        *(rows[c] for c in rows.columns), *(F.col("made")[name].alias(name) for name in columns))


def bounded_blocks(small: DataFrame, *key: str) -> list[DataFrame]:
    """Cut a table into blocks by key so that each can be broadcast; mostly this is one block.

    Every block is broadcast after rows and bytes of the whole are counted, so a table of any
    size is joined exactly, with one pass over the other side per block.
    """
    rows, size = measured_size(small)
    blocks = max(1, math.ceil(rows / BROADCAST_ROWS), math.ceil(size / BROADCAST_BYTES))
    if blocks == 1:
        return [small]
    return [small.where(F.pmod(F.xxhash64(*key), F.lit(blocks)) == i) for i in range(blocks)]


def joined_in_blocks(large: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Inner join on one key with the small side broadcast block by block."""
    parts = [large.join(F.broadcast(block), key) for block in bounded_blocks(small, key)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
