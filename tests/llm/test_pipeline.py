"""The corpus pipeline stage by stage, and every query beside its SQL."""

import hashlib
import math
import re
import sys
from itertools import combinations
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import corpus_pipeline  # noqa: E402
from check_queries import compare, connect  # noqa: E402
from sievepoint.llm import language, simhash  # noqa: E402
from sievepoint.llm.queries import ORACLES, QUERIES, WEIGHTS  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(got, connect(SF), ORACLES[name]) is None
    else:
        assert got.count() > 0


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs)
    return out


def test_columns_and_order(kept):
    assert [d.columns for d in kept[:-1]] == [COLUMNS] * 4
    assert kept[-1].columns == COLUMNS + ["copy_no", "order_key"]


def test_stages_take_effect(spark, kept):
    before = spark.read.parquet(f"{SF}/documents.parquet")
    known, lined, unique, clean, mixed = kept
    assert known.count() >= 0.97 * before.count()
    assert lined.count() == known.count() and lined.where(F.length("text") != F.col("n_chars")).count() == 0
    assert lined.agg(F.sum("n_chars")).first()[0] <= known.agg(F.sum(F.length("text"))).first()[0]
    found = simhash.near_duplicates(lined)
    assert unique.count() == found.select("root").distinct().count()
    items = duckdb.sql(f"select doc_id from read_parquet('{SF}/documents.parquet')").fetchall()
    assert clean.count() <= unique.count() <= len(items)
    assert {r.doc_id for r in mixed.select("doc_id").collect()} <= {r.doc_id for r in clean.select("doc_id").collect()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def plain_run(docs, items):
    """Stages two to five over (doc_id, text, source) in plain Python."""
    holders = {}
    split = lambda text: [(line, lower(line.strip(" \t\n\x0b\x0c\r"))) for line in text.split("\n")]
    for i, text, _ in docs:
        for _, key in split(text):
            holders.setdefault(key, set()).add(i)
    docs = [(i, "\n".join(line for line, key in split(text) if not key or len(holders[key]) < 10), s) for i, text, s in docs]
    prints = {i: simhash.fingerprint_of(text) for i, text, _ in docs}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    docs = [d for d in docs if find(d[0]) == d[0]]
    windows = set()
    for text in items:
        w = words(text)
        n = min(10, len(w))
        windows |= {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()
    sizes = {len(w) for w in windows}
    clean = []
    for i, text, s in docs:
        w = words(text)
        if not any(tuple(w[k:k + n]) in windows for n in sizes for k in range(len(w) - n + 1)):
            clean.append((i, text, s))
    chars = {}
    for _, text, s in clean:
        chars[s] = chars.get(s, 0) + len(text)
    others = [s for s in chars if s not in WEIGHTS and chars[s]]
    out = []
    for i, text, s in clean:
        weight = WEIGHTS.get(s, (1 - sum(WEIGHTS.values())) / max(1, len(others)))
        rate = weight * sum(chars.values()) / chars[s] if chars[s] else 0
        u = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        n, upto = 0, math.exp(-rate)
        while rate and upto <= u and n < 1000:
            n += 1
            upto += math.exp(n * math.log(rate) - rate - math.lgamma(n + 1))
        out += [(i, k, text) for k in range(1, n + 1)]
    return sorted(out)


def test_run_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = language.keep_identified(docs).select("doc_id", "text", "source").collect()
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted((r.doc_id, r.copy_no, r.text) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == plain_run([tuple(r) for r in known], items) and len(got) > 50


def test_run_is_the_stages_in_turn(spark, kept):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, kept[-1].collect()))
