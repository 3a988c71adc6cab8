"""Allow or block page addresses by rules and, where none fits, by path templates learned per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from sievepoint.llm.text import lower_ascii, whole_text
from sievepoint.operators.lookup import lookup_join
from sievepoint.runtime import materialize

WILD, REST = "*", "**"
ADDRESS = r"^(?s)(?:.*?)://([^/?#]*)([^?#]*)"
# A segment that varies by its looks: digits with or without an ending, a date, a long hex or base-64 run.
VARIABLE = r"^([0-9]+(\.[A-Za-z0-9]+)?|[0-9]{4}-[0-9]{2}(-[0-9]{2})?|[0-9A-Fa-f-]{16,}|(?=.*[0-9])[A-Za-z0-9_=-]{20,})$"


def host_of(url: Column) -> Column:
    """What is between the first :// and the next /, ? or #, A-Z lower-cased; empty without ://."""
    return lower_ascii(F.regexp_extract(whole_text(url), ADDRESS, 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return F.regexp_extract(whole_text(url), ADDRESS, 2)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule (host, path, verdict), NULL if none fits.

    A rule fits its host and all subdomains where the path starts with the rule's. Of equally long
    rules the one with the longer host wins. The list is a parameter of the caller and part of the plan.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


KINDS = ("bad", "good", "rest")


def _distance(mine: dict[str, Column], whole: dict[str, Column]) -> Column:
    """How far the kinds of some pages are from shares given by counts: a chi-square whose expected counts have one added.

    The one keeps a handful of pages from being far from anything, by the pages' own number: it is the same
    beside few sections and beside many.
    """
    n, every = sum(mine.values()), sum(whole.values())
    out = F.lit(0.0)
    for kind in KINDS:
        expected = n * whole[kind] / every
        out = out + (mine[kind] - expected) * (mine[kind] - expected) / (expected + 1)
    return out


def _merged(own: DataFrame, chi_square: float) -> DataFrame:
    """Names for segments (host, template, part, bad, good, rest) of their own: (host, template, part, name).

    Segments of one parent whose kinds are much alike share a name. They are put into cells by tenths of their blocked
    and allowed pages, 66 at most; cells are taken in that order, and one joins those before it while the test finds no
    difference. A segment that stands alone keeps its name, others are ``(least|..)``.
    """
    every = F.col("bad") + F.col("good") + F.col("rest")
    own = materialize(own.withColumns({"cb": F.floor(10 * F.col("bad") / every), "cg": F.floor(10 * F.col("good") / every)}))
    cells = own.groupBy("host", "template", "cb", "cg").agg(
        *(F.sum(k).alias(k) for k in KINDS), F.min("part").alias("least"), F.count(F.lit(1)).alias("parts"))
    listed = cells.groupBy("host", "template").agg(F.sort_array(F.collect_list(F.struct("cb", "cg", *KINDS, "least", "parts"))).alias("cells"))
    start = F.struct(*(F.lit(0).cast("long").alias(k) for k in KINDS), F.lit(0).alias("group"), F.array().cast("array<int>").alias("groups"))

    def step(acc, x):
        pool = {k: acc[k] + x[k] for k in KINDS}
        joins = (_distance({k: acc[k] for k in KINDS}, pool) + _distance({k: x[k] for k in KINDS}, pool)) < chi_square
        joins = joins & (F.size(acc["groups"]) > 0)
        group = acc["group"] + F.when(joins, 0).otherwise(1)
        return F.struct(*(F.when(joins, pool[k]).otherwise(x[k]).alias(k) for k in KINDS), group.alias("group"),
                        F.concat(acc["groups"], F.array(group)).alias("groups"))
    groups = F.aggregate("cells", start, step, lambda acc: acc["groups"])
    numbered = listed.select("host", "template", F.explode(F.arrays_zip("cells", groups.alias("groups"))).alias("c")).select(
        "host", "template", "c.cells.cb", "c.cells.cg", "c.cells.least", "c.cells.parts", F.col("c.groups").alias("group"))
    every_cell = W.partitionBy("host", "template", "group")  # 66 rows at most
    named = materialize(numbered.select("host", "template", "cb", "cg", F.min("least").over(every_cell).alias("least"),
                                        F.sum("parts").over(every_cell).alias("parts")))
    placed = lookup_join(own, named, ["host", "template", "cb", "cg"])
    name = F.when(F.col("parts") == 1, F.col("part")).otherwise(F.concat(F.lit("("), "least", F.lit("|..)")))
    return placed.select("host", "template", "part", name.alias("name"))


def path_templates(paths: DataFrame, depth: int = 6, chi_square: float = 5.99) -> DataFrame:
    """Grow a template tree per host over (host, path, n, labelled, bad) and give each path its ``template``.

    Level by level from the host: a segment becomes a wildcard if it looks variable. Of the others those
    whose pages are blocked, allowed and unlabelled much as their parent's are (a chi-square under ``chi_square``; the
    default is the 5 % point for two degrees of freedom) are merged into the wildcard too. Those that differ from their
    parent are merged with each other where they are alike. The test weighs a section by its own pages, so
    the section keeps its verdict however many others stand beside it.

    Below ``depth`` only branches that hold pages of different kinds are grown on, to their last segment; what lies
    below the others is one ``**``, which holds pages of one kind only and so changes no verdict. Rows are distinct
    paths with counts; each level is a few sums and lookups by host and parent, which broadcast a
    table of measured size, or else its most used keys ahead of a shuffle, so that a host with a third of all
    pages is no single task.
    """
    segments = F.split(F.regexp_replace("path", "^/", ""), "/", -1)
    rows = materialize(paths.withColumn("parts", segments).withColumn("template", F.lit("")))
    deepest = rows.agg(F.max(F.size("parts"))).first()[0] or 0
    sums = [F.sum(c).alias(k) for k, c in zip(KINDS, (F.col("bad"), F.col("labelled") - F.col("bad"), F.col("n") - F.col("labelled")))]
    ended = []
    for level in range(deepest):
        if level >= depth:
            ended.append(rows.where(F.size("parts") <= level))
            below = rows.where(F.size("parts") > level)
            counts = below.groupBy("host", "template").agg(*sums)
            kinds = sum((F.col(k) > 0).cast("int") for k in KINDS)
            unlike = (kinds > 1) & (F.col("bad") + F.col("good") > 0)
            mixed = materialize(counts.where(unlike).select("host", "template", F.lit(True).alias("mixed")))
            placed = lookup_join(below, mixed, ["host", "template"])
            ended.append(placed.where("mixed IS NULL").drop("mixed").withColumn("template", F.concat("template", F.lit("/" + REST))))
            rows = materialize(placed.where("mixed").drop("mixed"))
            if rows.isEmpty():
                break
        here = F.get("parts", F.lit(level))
        rows = rows.withColumn("part", F.when(here.rlike(VARIABLE), F.lit(WILD)).otherwise(here))
        kids = materialize(rows.where("part IS NOT NULL AND part != '*'").groupBy("host", "template", "part").agg(*sums))
        whole = materialize(kids.groupBy("host", "template").agg(*(F.sum(k).alias(f"all_{k}") for k in KINDS)))
        differs = _distance({k: F.col(k) for k in KINDS}, {k: F.col(f"all_{k}") for k in KINDS}) >= chi_square
        own = lookup_join(kids, whole, ["host", "template"]).where(differs).select("host", "template", "part", *KINDS)
        names = materialize(_merged(own, chi_square))
        rows = (lookup_join(rows, names, ["host", "template", "part"])
                .withColumn("template", F.when(F.col("part").isNull(), F.col("template"))
                            .otherwise(F.concat("template", F.lit("/"), F.coalesce("name", F.lit(WILD)))))
                .drop("name", "part"))
        rows = materialize(rows)
    for part in ended:
        rows = rows.unionByName(part)
    return rows.drop("parts")


def judge_pages(pages: DataFrame, rules: list[tuple[str, str, str]], reject_at: float = 0.8, prior_weight: float = 4.0,
                **tree) -> DataFrame:
    """Verdict for each page address: page_id, host, path, rule, verdict, template, purity.

    The rule's verdict where a rule fits. These pages are also the labels of the tree: a template's purity is its
    share of blocked labels, smoothed by ``prior_weight`` labels of which half are blocked, and a page without a
    rule is blocked if its template's purity reaches ``reject_at``. A template without labels is thus allowed.

    A NULL url, or one without ``://``, has an empty host and path and is judged like any other. Repeated rows
    come back as often as they are given. Other columns are ignored; an empty table gives an empty result.
    """
    found = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = found.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    paths = materialize(found.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("fit").alias("labelled"), F.count_if(F.col("fit.verdict") == "block").alias("bad")))
    placed = path_templates(paths, **tree)
    sums = placed.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    purity = (F.col("bad") + prior_weight / 2) / (F.col("labelled") + prior_weight)
    rated = materialize(sums.select("host", "template", purity.alias("purity")))
    judged = lookup_join(placed.select("host", "path", "template"), rated, ["host", "template"])
    own = F.when(F.col("purity") >= reject_at, "block").otherwise("allow")
    # An address that a third of all pages have is a hot key.
    return (lookup_join(found, materialize(judged.select("host", "path", "template", "purity")), ["host", "path"])
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", own).alias("verdict"), "template", "purity"))
