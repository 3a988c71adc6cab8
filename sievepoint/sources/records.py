"""CSV records of splittable files: cells may hold line breaks, and a record may begin in one split and end in another.

A line lies inside a quoted cell if the file has an odd number of quotes before it. Quotes are summed for each split, the
splits' sums are carried on in file order, and each split is then read by itself, knowing how it begins. What a split leaves open
at its edges (two pieces at most) is put together afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

# A piece of a record that a split begins, goes on with, or ends; whole records are 0.
WHOLE, BEGUN, PASSED, ENDED = 0, 1, 2, 3
PIECES = "file string, block bigint, first boolean, kind int, record string"


def _lines(spark: SparkSession, path) -> DataFrame:
    value = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), value.alias("value"))


def _starts(lines: DataFrame) -> DataFrame:
    """For each split whether it begins inside a quoted cell. One row for each split that the scan has."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    sums = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return sums.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


class _Split:
    """Lines of one split, taken in order, to whole records and the pieces at its edges."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.odd = file, block, int(inside)
        self.open: list[str] = []
        self.kind = PASSED if inside else BEGUN  # of what is open, if it does not end here
        self.first = block == 0

    def batch(self, first: list[bool], kind: list[int], records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.file] * n, pa.string()), pa.array([self.block] * n, pa.int64()), pa.array(first, pa.bool_()),
             pa.array(kind, pa.int32()), records.cast(pa.string())], ["file", "block", "first", "kind", "record"])

    def take(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        after = (self.odd + np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False))) % 2
        closes = np.flatnonzero(after == 0)
        self.odd = int(after[-1])
        if not len(closes):
            self.open += lines.to_pylist()
            return
        begin = 0
        if self.open or self.kind == PASSED:  # the first close ends what was open before
            begin = int(closes[0]) + 1
            text = "\n".join([*self.open, *lines[:begin].to_pylist()])
            yield self.batch([self.first and self.kind == BEGUN], [ENDED if self.kind == PASSED else WHOLE], pa.array([text]))
            self.first, self.open, self.kind = False, [], BEGUN
        end = int(closes[-1]) + 1
        if end > begin:
            ends = closes[closes >= begin] + 1 - begin
            inner = lines[begin:end]
            if len(ends) < len(inner):
                offsets = np.concatenate([[0], ends]).astype(np.int32)
                parts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(inner.to_pylist(), pa.string()))
                inner = pc.binary_join(parts, "\n")
            yield self.batch([self.first, *[False] * (len(inner) - 1)], [WHOLE] * len(inner), inner)
            self.first = False
        self.open = lines[end:].to_pylist()

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.open:
            yield self.batch([self.first and self.kind == BEGUN], [self.kind], pa.array(["\n".join(self.open)]))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split = None
    for batch in batches:
        files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy(zero_copy_only=False)
        code = files.indices.to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero((np.diff(code) != 0) | (np.diff(blocks) != 0)) + 1), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            file, block = files.dictionary[int(code[a])].as_py(), int(blocks[a])
            if split is None or (split.file, split.block) != (file, block):
                if split is not None:
                    yield from split.close()
                split = _Split(file, block, batch.column("inside")[a].as_py())
            yield from split.take(batch.column("value").slice(a, b - a))
    if split is not None:
        yield from split.close()


def csv_records(spark: SparkSession, path) -> DataFrame:
    """(file, first, record): every record of the files as one text; ``first`` marks the first record of its file.

    Quotes are doubled inside quoted cells, and only quoted cells hold quotes. Lines end with a line feed, with or without a
    carriage return before it; inside a record a break is a line feed. Empty lines between records are left out. A file whose last
    cell is not closed ends with that record.
    """
    lines = _lines(spark, path)
    # As many rows as the scan has splits, which the driver lists anyway.
    known = lines.join(F.broadcast(_starts(lines)), ["file", "block"]).select("file", "block", "inside", "value")
    pieces = known.mapInArrow(_assemble, PIECES)
    order = W.partitionBy("file").orderBy("block", (F.col("kind") == BEGUN).cast("int"))
    edges = pieces.where(F.col("kind") != WHOLE).withColumn(
        "owner", F.sum((F.col("kind") == BEGUN).cast("int")).over(order))
    at_edges = edges.groupBy("file", "owner").agg(
        F.bool_or("first").alias("first"),
        F.sort_array(F.collect_list(F.struct("block", "record"))).alias("parts")  # one for each split that the record touches
    ).select("file", "first", F.array_join(F.col("parts.record"), "\n").alias("record"))
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "first", "record")
    return whole.unionByName(at_edges).where("first OR record != ''")
