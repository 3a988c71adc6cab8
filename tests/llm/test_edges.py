"""Defined results for NULLs, empty and very long texts, repeated rows, empty tables and clashing column names."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sievepoint.llm import chat, decontamination, hnsw, language, licences, lines, mixing, pii, simhash, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, words string, line string, n_lines long, k1 string, u string"
LONG = "alpha beta gamma delta epsilon " * 20_000


def doc(i, text, lang="en", source="a"):
    return (i, text, lang, source, 1, "r", "w", "l", 7, "k", "u")


@pytest.fixture(scope="module")
def docs(spark):
    data = [doc(1, "one two three four five six seven eight nine ten eleven"), doc(2, None), doc(3, ""), doc(None, "lost words here"),
            doc(5, LONG), doc(6, "same text"), doc(6, "same text"), doc(7, "same text", None, None), doc(8, " \n\t\n")]
    return spark.createDataFrame(data, DOCS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


def test_lines(docs, none):
    got = by_id(lines.drop_shared_lines(docs, min_docs=2))
    assert (got[2][0].text, got[2][0].n_lines, got[2][0].n_dropped) == ("", 1, 0)
    assert (got[3][0].text, got[3][0].n_lines) == ("", 1)
    assert [r.text for r in got[6] + got[7]] == ["", "", ""] and got[6][0].n_dropped == 1
    assert (got[8][0].text, got[8][0].n_lines, got[8][0].n_dropped) == (" \n\t\n", 3, 0)  # empty keys stay
    assert got[5][0].text == LONG and got[5][0].row == "r" and got[5][0].k1 == "k"
    assert lines.drop_shared_lines(none).count() == 0


def test_one_document_twice_is_one_document(spark):
    twice = spark.createDataFrame([doc(1, "x"), doc(1, "x"), doc(1, "x")], DOCS)
    assert [r.text for r in lines.drop_shared_lines(twice, min_docs=2).collect()] == ["x"] * 3


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame(
        [(1, "two three four five six seven eight nine ten eleven", 0), (2, "lost words", 0), (3, None, 0), (None, "same", 0), (4, "!?", 0)],
        "item_id long, text string, words int")
    got = by_id(decontamination.find_passages(docs, items))
    assert (got[1][0].n_words, got[1][0].n_hit, got[1][0].item_ids) == (11, 10, ["1"])
    assert (got[None][0].n_hit, got[None][0].item_ids) == (2, ["2"])
    assert [(r.n_hit, r.item_ids, r.contaminated) for r in got[6]] == [(1, [], True)] * 2
    assert (got[2][0].n_words, got[2][0].contaminated, got[3][0].n_words) == (0, False, 0)
    assert got[5][0].n_words == 100_000 and not got[5][0].contaminated
    assert decontamination.find_passages(none, items).count() == 0
    clean = decontamination.find_passages(docs, items.where("false"))
    assert clean.where("contaminated or n_hit > 0").count() == 0 and clean.count() == docs.count()
    left = decontamination.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 5, 8]


def test_simhash(docs, none):
    got = by_id(simhash.near_duplicates(docs))
    assert {r.fp for i in (2, 3, 8) for r in got[i]} == {0} and {r.component_id for i in (2, 3, 8) for r in got[i]} == {2}
    assert [r.component_id for r in got[6] + got[7]] == [6] * 3 and got[None][0].component_id is None
    left = simhash.keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in left.collect()) == [(False, 1), (False, 2), (False, 5), (False, 6), (True, None)]
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one_of_each(none).count() == 0


def test_language(docs, none):
    got = by_id(language.identify(docs.withColumn("score", F.lit("old"))))
    assert [(got[i][0].lang_pred, got[i][0].score) for i in (2, 3, 8)] == [("und", 0.0)] * 3
    assert got[5][0].lang_pred == "en" and got[5][0].spans[0][:2] == (0, len(LONG)) and len(got[6]) == 2
    assert language.identify(none).count() == 0
    untaught = language.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}
    left = language.keep_identified(docs)
    assert left.columns == docs.columns and 2 not in {r.doc_id for r in left.collect()}


def test_mixing(docs, none):
    got = mixing.mix_sources(docs.withColumn("order_key", F.lit("old")), {"a": 1.0}, epochs=2.0)
    assert got.columns == docs.columns + ["copy_no", "order_key"]
    assert got.where("source is null").count() == 0  # its weight is zero
    per_row = got.where("doc_id = 6").groupBy("copy_no").count().collect()
    assert all(r["count"] == 2 for r in per_row)  # repeated rows are repeated alike
    assert mixing.mix_sources(none, {"a": 1.0}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(docs, {"a": 1.5})


def test_licences(spark, none):
    long_line = "word " * 50_000
    docs = spark.createDataFrame([
        doc(1, "intro\nreleased under THE mit license\n" + long_line), doc(2, None), doc(3, ""), doc(4, "single"),
        doc(5, "Released under the MIT License."), doc(5, "Released under the MIT License."),
        doc(None, "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.")], DOCS)
    got = by_id(licences.scan_licences(docs))
    assert got[1][0].licence == "MIT" and got[1][0].dice == 1.0 and got[1][0].licences[0].unit.startswith("released")
    assert [got[i][0].licence for i in (2, 3, 4)] == [None] * 3 and [r.licence for r in got[5]] == ["MIT"] * 2
    assert got[None][0].licence == "CC-BY-NC-4.0" and len(got[None][0].licences) == 2  # equal scores: the first name
    assert licences.scan_licences(none).count() == 0


def test_personal_data(docs, none, spark):
    got = by_id(pii.find_personal_data(docs))
    assert all(not r.spans for rows in got.values() for r in rows) and len(got[6]) == 2
    assert pii.find_personal_data(none).count() == 0
    n = 60_000  # runs that would recurse or backtrack
    texts = ["a@" + "b." * n + "c", "1 2 " * n, "9" * n, "a" * n, "a@b" * n, "+1" + "(" * n, "1." * n, "AA00" * n]
    rows = spark.createDataFrame([doc(i, t) for i, t in enumerate(texts)], DOCS)
    found = by_id(pii.find_personal_data(rows))
    assert [(s.kind, s.start, s.end) for s in found[0][0].spans] == [("email", 0, 2 + 2 * n + 1)]
    assert not found[1][0].spans and not found[2][0].spans and not found[3][0].spans


def test_pages(spark):
    schema = "page_id long, url string, host string, template string, verdict int"
    pages = spark.createDataFrame([
        (1, None, "h", "t", 0), (2, "", "h", "t", 0), (3, "no address", "h", "t", 0), (4, "http://A.B.Example.COM/en/1?x=/y", "h", "t", 0),
        (5, "x://www.example.com/en/#a", "h", "t", 0), (6, "http://example.com", "h", "t", 0), (7, "http://Éx.net/es/", "h", "t", 0),
        (7, "http://Éx.net/es/", "h", "t", 0), (None, "http://h.org/" + "a/" * 5_000 + "?q", "h", "t", 0)], schema)
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block")]
    got = {}
    for r in urls.judge_pages(pages, rules).collect():
        got.setdefault(r.page_id, []).append(r)
    assert [(got[i][0].host, got[i][0].path, got[i][0].rule, got[i][0].verdict) for i in (1, 2, 3)] == [("", "", None, "allow")] * 3
    assert (got[4][0].host, got[4][0].path, got[4][0].rule) == ("a.b.example.com", "/en/1", "example.com/en/")
    assert (got[5][0].rule, got[5][0].verdict) == ("www.example.com/en/", "allow")
    assert (got[6][0].path, got[6][0].rule) == ("", None)
    assert [(r.host, r.verdict) for r in got[7]] == [("Éx.net", "block")] * 2
    assert got[None][0].template.endswith("/**")
    assert urls.judge_pages(pages.where("false"), rules).count() == 0


def test_nearest(spark):
    schema = "vec_id long, embedding array<float>, label int, query_id int, score string"
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, []), (None, [9.0, 9.0]), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 0.5]), (2, [0.5, 0.5])]
    table = spark.createDataFrame([(i, v, 0, 0, "s") for i, v in data], schema)
    got = hnsw.nearest(table, F.col("vec_id") % 2 == 0, k=3).collect()
    rows = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)
    assert rows == [(0, 1, 1, 1.0), (0, 2, 2, 0.5), (0, 3, 10, -1.0), (2, 1, 0, 0.5), (2, 2, 1, 0.5), (2, 3, 10, -0.25),
                    (10, 1, 2, -0.25), (10, 2, 0, -1.0), (10, 3, 1, -1.0)]
    assert hnsw.nearest(table.where("false"), F.lit(True)).count() == 0


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, pos int, h1 int, n_turns int"
    data = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "yes"), (3, 1, "bot", "yes"), (3, 0, "user", "hi"), (4, 0, "user", None),
            (5, 0, "user", ""), (5, 1, None, "x"), (None, 0, "user", "lost"), (6, 0, "user", "hi"), (6, 0, "user", "hi"), (7, None, "user", LONG)]
    turns = spark.createDataFrame([(*r, 0, 0, 0) for r in data], schema)
    got = {r.conv_id: r for r in chat.maximal_conversations(turns).collect()}
    assert sorted(got) == [2, 4, 5, 7] and got[2].n_copies == 2 and got[2].n_turns == 2
    assert got[2].text == "<|user|>\nhi\n<|end|>\n<|bot|>\nyes\n<|end|>\n"
    assert got[4].text == "<|user|>\n\n<|end|>\n" and len(got[7].text) > len(LONG)
    assert chat.maximal_conversations(turns.where("false")).count() == 0


def test_digest_of_nothing(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.sql("select sha2('', 256) as x").first().x
