"""Batches of few files are scored on all cores."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from sievepoint.catalog import modelling as Q
from sievepoint.plans import features as P
from sievepoint.runtime import evened
from sievepoint.streaming.scoring import read_scored, score_stream

SF = "/root/testdata/sf0.001"
OPTIONS = P.FeatureOptions(as_of=date(2024, 2, 8))


def _parts(df):
    return df.groupBy(F.spark_partition_id()).count().count()


def test_one_row_group_is_dealt_to_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    heavy = spark.range(0, 60_000, numPartitions=1).union(spark.range(60_000, 60_010, numPartitions=2 * cores))
    out = evened(heavy)
    assert _parts(out) == cores and sorted(r.id for r in out.collect()) == list(range(60_010))
    # Few rows, or rows that are dealt evenly already, stay where they are.
    for kept in (spark.range(0, 900, numPartitions=1), spark.range(0, 60_000 * cores, numPartitions=cores), spark.range(0)):
        assert evened(kept) is kept


def test_a_batch_of_one_file_is_scored_by_all_cores(spark, tmp_path):
    spark.range(0, 60_000, numPartitions=1).withColumnRenamed("id", "app_id").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("app_id long").parquet(f"{tmp_path}/in")
    score_stream(stream, f"{tmp_path}/state", f"{tmp_path}/out", f"{tmp_path}/progress", OPTIONS, bypass=True,
                 trigger={"availableNow": True}).awaitTermination()
    assert len(list((tmp_path / "out" / "scored").glob("batch=0/part-*.parquet"))) >= spark.sparkContext.defaultParallelism
    assert sorted(r.app_id for r in read_scored(spark, f"{tmp_path}/out").collect()) == list(range(60_000))


def test_json_lines_are_written_by_all_cores(spark, tmp_path, monkeypatch):
    class Sent(Exception):
        pass

    def sent(*args, **kwargs):
        raise Sent
    monkeypatch.setattr(Q, "_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(Q, "fitted", lambda *args, **kwargs: None)
    monkeypatch.setattr(Q, "score_stream", sent)
    with pytest.raises(Sent):
        Q.running_json_stream(spark, SF)
    assert len(list((tmp_path / "in").glob("part-*"))) >= spark.sparkContext.defaultParallelism
    assert spark.read.text(f"{tmp_path}/in").count() == 1020
