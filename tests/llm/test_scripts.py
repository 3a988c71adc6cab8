"""Letters, marks and scripts in language labels, and languages that are rare beside others."""

import pytest
from pyspark.sql import functions as F

from sievepoint.llm import language

RU = "это просто слова на русском языке которые стоят рядом и говорят о погоде".split()
EN = "these are only words of the english language that stand here and tell about the weather".split()
HI = "यह केवल हिंदी भाषा के शब्द हैं जो यहाँ खड़े हैं और मौसम के बारे में बताते हैं".split()


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, " ".join(words[i % 5:]), lang) for lang, words in (("ru", RU), ("en", EN), ("hi", HI)) for i in range(40)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def found(spark, model, *texts):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r.x for r in frame.select(language.label(F.col("text"), model).alias("x")).collect()]


def test_no_letter_is_undetermined(spark, model):
    got = found(spark, model, "½ ² ③ 12 ⅷ", "\u0301\u093e", "_ - 3", "²a")
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert got[3].lang_pred != "und"


def test_marks_belong_to_words(spark, model):
    assert language.WORD.findall("हिंदी भाषा, a1b ½x") == ["हिंदी", "भाषा", "a", "b", "x"]
    assert found(spark, model, " ".join(HI))[0].lang_pred == "hi"


def test_one_word_of_another_script_is_a_span_of_its_own(spark, model):
    text = " ".join([*EN[:6], RU[1], *EN[6:]])
    got = found(spark, model, text)[0]
    assert [s.lang for s in got.spans] == ["en", "ru", "en"] and got.lang_pred == "en"
    assert text[got.spans[1].start:got.spans[1].end].strip() == RU[1]


def test_a_rare_language_is_learned(spark):
    """Three rows beside many of another language, with room for few rows and features; a third of the rows is one text."""
    rows = [(i, " ".join(EN[i % 7:]) + f" {i}", "en") for i in range(2_000)] + [(5_000 + i, " ".join(EN), "en") for i in range(1_000)]
    rows += [(9_000 + i, "dnes je velmi pekne pocasie a vsetci sme tu spolu", "sk") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, sample_rows=60, features=200)
    assert model.langs == ["en", "sk"] and len(model.rows) <= 200
    assert [r.lang_pred for r in found(spark, model, "velmi pekne pocasie", "words of the weather")] == ["sk", "en"]
