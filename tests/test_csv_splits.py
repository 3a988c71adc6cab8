"""CSV files of many splits, whose records cross the edges of splits."""

import random

import pytest
from conftest import values

from sievepoint.sources import readers as S
from sievepoint.sources.records import csv_records

KINDS = {"id": "int", "note": "str", "last": "str"}


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def made(seed, rows=120, end="\n"):
    pick = random.Random(seed)
    notes = ["plain", "", "two\nlines", 'a "word", here', "\n\nblank lines\n", '"', "x" * 300 + "\n" + "y" * 300, "é, ü", "\n".join("abcdefgh" * 9)]
    out = [(i, pick.choice(notes), pick.choice(["z", "q\nr", ""])) for i in range(rows)]
    lines = ["id,note,last"] + [f"{i},{quoted(n) if n else n},{quoted(t) if t else t}" for i, n, t in out]
    return out, end.join(line.replace("\n", end) for line in lines) + pick.choice(["", end])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_across_splits(spark, small_splits, tmp_path, end):
    want = []
    for seed in range(3):
        rows, text = made(seed, end=end)
        (tmp_path / f"f{seed}.csv").write_bytes(text.encode())
        want += [(i, n or None, t or None) for i, n, t in rows]
    path = str(tmp_path)
    assert csv_records(spark, path).rdd.getNumPartitions() > 100
    read = S.read_typed_csv(spark, path, KINDS)
    key = lambda r: tuple(map(str, r))
    # Blank cells are missing values, so breaks alone become NULL in both readers.
    strip = lambda rows: sorted([(a, b if b and b.strip(" ") else None, c) for a, b, c in rows], key=key)
    got = strip(tuple(r) for r in read.select("id", "note", "last").collect())
    assert got == strip(want)
    whole = S.read_typed_csv(spark, path, KINDS, splittable=False)
    assert got == strip(tuple(r) for r in whole.select("id", "note", "last").collect())


def test_edges_of_files(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('"i\nd",note\n1,"never closed\nto the end\n' + "more\n" * 60)
    assert sorted((r.first, r.record[:12]) for r in csv_records(spark, str(tmp_path)).collect()) == [
        (False, '1,"never clo'), (True, '"i\nd",note')]
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,note\n")
    assert S.read_typed_csv(spark, str(tmp_path / "b.csv"), KINDS).columns == ["id", "note"]
    assert S.read_typed_csv(spark, str(tmp_path / "b.csv"), KINDS).count() == 0
    (tmp_path / "c.csv").write_text("id,note,more\n5,x,y\n")
    with pytest.raises(Exception, match="different headers"):
        S.read_typed_csv(spark, str(tmp_path / "[bc].csv"), KINDS).collect()
    assert values(S.read_typed_csv(spark, str(tmp_path / "[bc].csv"), KINDS, mixed_headers=True), "id", "note") == [(5, "x")]


def test_headers_that_hold_line_breaks(spark, small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('"i\nd",note\n1,x\n')
    (tmp_path / "b.csv").write_bytes(b'note,"i\nd"\r\ny,2\r\n')
    got = S.read_typed_csv(spark, str(tmp_path), {"i\nd": "int", "note": "str"}, mixed_headers=True)
    assert sorted((r["i\nd"], r.note) for r in got.collect()) == [(1, "x"), (2, "y")]


def test_bare_quotes_need_whole_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,5" pipe\n2,x\n')
    got = S.read_typed_csv(spark, str(tmp_path), KINDS, splittable=False)
    assert values(got, "id", "note") == [(1, '5" pipe'), (2, "x")]
