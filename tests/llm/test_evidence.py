"""The language stage rejects texts without evidence for a learned language."""

import numpy as np

import corpus_pipeline
from sievepoint.llm import language

SF = "/root/testdata/sf0.01"


def test_texts_without_evidence_go(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rng = np.random.default_rng(5)
    noise = " ".join("".join(rng.choice(list("bcdfghjkqvwxyz"), 9)) for _ in range(300))
    thai = "ภาษาไทยเป็นภาษา " * 40
    good = docs.where("lang = 'en' and length(text) > 400").first().text[:400]
    planted = [(-1, thai, None), (-2, noise, None), (-3, good, None), (-4, good + thai * 10, None), (-5, "12 34", None)]
    every = docs.union(spark.createDataFrame(planted, docs.schema)).cache()
    got = {r.doc_id: r for r in language.identify(every).collect()}
    known = {r.lang for r in docs.select("lang").distinct().collect()}
    assert all(got[i].lang_pred in known for i in (-1, -2, -3, -4))
    assert got[-1].score == 0 and got[-2].score < 0.05 and got[-3].score > 0.95 and got[-4].score < 0.5
    kept = {r.doc_id for r in corpus_pipeline.language_stage(spark, every, SF).collect()}
    assert {i for i in kept if i < 0} == {-3}
    assert len(kept) >= 0.97 * docs.count()
