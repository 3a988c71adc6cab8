"""Path templates keep a section that differs, however many stand beside it and however deep it lies."""

from sievepoint.llm import urls


def judged(spark, pages, rules):
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    return {spark_row.path: spark_row for spark_row in urls.judge_pages(frame, rules).collect()}


def name(i):
    return f"{chr(97 + i // 26)}{chr(97 + i % 26)}"


def test_sections_beside_many(spark):
    paths = [f"/s-{name(i)}/p-{name(k)}" for i in range(120) for k in range(20)]
    rules = [("h.org", f"/s-ab/p-{name(k)}", "block") for k in range(16)]
    got = judged(spark, [f"http://h.org{p}" for p in paths], rules)
    assert got["/s-ab/p-at"].rule is None and got["/s-ab/p-at"].template.startswith("/s-ab/")
    assert got["/s-ac/p-at"].template == "/*/*" and got["/s-ac/p-at"].verdict == "allow"


def test_scattered_pages_stay_together(spark):
    paths = [f"/u-{name(i)}" for i in range(300)]
    rules = [("h.org", p, "block") for p in paths[:270:9]]
    got = judged(spark, [f"http://h.org{p}" for p in paths], rules)
    assert {r.template for r in got.values()} == {"/*"} and got["/u-lm"].verdict == "block"


def test_deep_sections(spark):
    deep = "/a/b/c/d/e/f/g"
    paths = [f"{deep}/{s}/{i}" for s in ("good", "ads") for i in range(100, 160)] + ["/x" * 4_000]
    rules = [("h.org", f"{deep}/ads/1{i}", "block") for i in range(0, 5)] + [("h.org", f"{deep}/good/10", "allow")]
    got = judged(spark, [f"http://h.org{p}" for p in paths], rules)
    assert got[f"{deep}/ads/159"].verdict == "block" and got[f"{deep}/ads/159"].template.endswith("/ads/*")
    assert got[f"{deep}/good/159"].verdict == "allow" and got["/x" * 4_000].template.endswith("/**")


def test_verdict_does_not_depend_on_neighbours(spark):
    """The same section beside few and many others, on one host in one table."""
    rules, pages = [], []
    for host, beside in (("few.org", 3), ("some.org", 40), ("many.org", 60), ("more.org", 600)):
        pages += [f"http://{host}/spam/b{chr(97 + i)}/x" for i in range(12)] + [f"http://{host}/s-{name(i)}/x" for i in range(beside)]
        rules += [(host, f"/spam/b{chr(97 + i)}/", "block") for i in range(11)]
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    got = {(r.host, r.path): r for r in urls.judge_pages(frame, rules).collect()}
    asked = [got[h, "/spam/bl/x"] for h in ("few.org", "some.org", "many.org", "more.org")]
    assert {r.verdict for r in asked} == {"block"} and all(r.rule is None for r in asked)
    assert {r.template for r in asked[1:]} == {"/spam/*/*"}


def test_alike_sections_pool_their_labels(spark):
    """Two labels a section do not reach the purity; ten sections alike do, and sections of another kind stay apart."""
    paths = [f"/ad-{name(i)}/{k}" for i in range(10) for k in range(100, 106)]
    paths += [f"/ok-{name(i)}/{k}" for i in range(10) for k in range(100, 106)] + [f"/free/{k}" for k in range(100, 1000)]
    rules = [("h.org", f"/ad-{name(i)}/10{k}", "block") for i in range(10) for k in range(3)]
    rules += [("h.org", f"/ok-{name(i)}/10{k}", "allow") for i in range(10) for k in range(3)]
    got = judged(spark, [f"http://h.org{p}" for p in paths], rules)
    assert {got[f"/ad-{name(i)}/105"].template for i in range(10)} == {"/(ad-aa|..)/*"}
    assert {got[f"/ad-{name(i)}/105"].verdict for i in range(10)} == {"block"}
    assert {got[f"/ok-{name(i)}/105"].template for i in range(10)} == {"/(ok-aa|..)/*"} and got["/free/500"].template == "/free/*"
    assert {r.verdict for p, r in got.items() if not p.startswith("/ad-")} == {"allow"}


def test_one_address_on_many_pages(spark):
    got = judged(spark, [None] * 3_000 + ["http://h.org/a"], [("h.org", "/", "block")])
    assert got[""].verdict == "allow" and got["/a"].verdict == "block"
