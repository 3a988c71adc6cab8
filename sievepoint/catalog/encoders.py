"""Fitted tables: ranks, rare values, codes, scales, and the distribution function."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sievepoint.catalog.registry import applications, query, table
from sievepoint.functions import cleaning as C, identity as I
from sievepoint.operators import distribution as E, fitted as M

_RANK_INPUT = """r AS (SELECT app_id, city, state, nullif(split_part(lower(email), '@', 2), '') AS email_domain FROM applications)"""


def _rank_ctes(c: str) -> str:
    return f"""c_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS k,
  CAST(floor(count(*) OVER () * 0.3::DOUBLE) AS BIGINT) AS kept FROM r WHERE {c} IS NOT NULL GROUP BY {c})"""


def _rank_column(c: str) -> str:
    return (f"CASE WHEN r.{c} IS NULL THEN NULL ELSE coalesce((SELECT k FROM c_{c} WHERE v = r.{c} AND k < kept), "
            f"(SELECT max(kept) FROM c_{c})) END AS {c}_rank")


_RANKED = ("city", "state", "email_domain")


@query("popularity_ranks", f"""
WITH {_RANK_INPUT}, {", ".join(_rank_ctes(c) for c in _RANKED)}
SELECT app_id, {", ".join(_rank_column(c) for c in _RANKED)} FROM r""")
def popularity_ranks(spark, sf):
    rows = applications(spark, sf, "app_id", "city", "state", "email").select(
        "app_id", "city", "state", I.email_domain(F.col("email")).alias("email_domain"))
    state = M.fit_rank(rows, list(_RANKED))
    return M.apply_rank(rows, state, list(_RANKED)).select("app_id", *(f"{c}_rank" for c in _RANKED))


@query("popularity_rank_table", """
WITH c AS (SELECT 'p_brand' AS feature, p_brand AS value, count(*) AS n FROM part GROUP BY 2
           UNION ALL SELECT 'p_name', p_name, count(*) FROM part GROUP BY 2),
k AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS rank,
             CAST(floor(count(*) OVER (PARTITION BY feature) * 0.3::DOUBLE) AS BIGINT) AS kept FROM c)
SELECT feature, value, rank, n FROM k WHERE rank < kept
UNION ALL SELECT DISTINCT feature, NULL, kept, CAST(NULL AS BIGINT) FROM k""")
def popularity_rank_table(spark, sf):
    return M.fit_rank(table(spark, sf, "part"), ["p_brand", "p_name"])


@query("rare_values_collapsed", """
WITH l AS (SELECT app_id, lower(city) AS city, lower(college_id) AS college_id FROM applications),
c AS (SELECT city FROM l GROUP BY 1 HAVING count(*) > 160), g AS (SELECT college_id FROM l GROUP BY 1 HAVING count(*) > 65)
SELECT app_id, CASE WHEN city IS NULL OR city IN (SELECT city FROM c WHERE city IS NOT NULL) THEN city ELSE 'Other' END AS city,
       CASE WHEN college_id IS NULL OR college_id IN (SELECT college_id FROM g WHERE college_id IS NOT NULL) THEN college_id ELSE 'Other' END AS college_id FROM l""")
def rare_values_collapsed(spark, sf):
    rows = applications(spark, sf, "app_id", "city", "college_id")
    out = M.collapse_rare(rows, M.fit_common(rows, ["city"], 160), ["city"])
    out = M.collapse_rare(out, M.fit_common(rows, ["college_id"], 65), ["college_id"])
    # The first pass leaves college_id alone, so its lower-casing comes from the second.
    return out


_CODE = lambda c: (f"k_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY min(app_id), {c}) - 1 AS code "
                   f"FROM t WHERE tstmp_submit < TIMESTAMP '2024-01-01 02:00:00' GROUP BY {c})")
_CODED = ("state", "city", "campaign1")


@query("ordinal_codes", f"""
WITH t AS (SELECT app_id, coalesce(state, 'nan') AS state, coalesce(city, 'nan') AS city, coalesce(campaign1, 'missing') AS campaign1, tstmp_submit FROM applications),
{", ".join(_CODE(c) for c in _CODED)}
SELECT app_id, {", ".join(f"coalesce((SELECT code FROM k_{c} WHERE v = t.{c}), -1) AS {c}" for c in _CODED)} FROM t""")
def ordinal_codes(spark, sf):
    """Codes are fitted on the first two hours, so later rows meet unseen values."""
    rows = C.categorical_text(applications(spark, sf, "app_id", "tstmp_submit", *_CODED), list(_CODED), {"state", "city"})
    early = rows.filter(F.col("tstmp_submit") < F.lit("2024-01-01 02:00:00").cast("timestamp"))
    return M.apply_codes(rows, M.fit_codes(early, list(_CODED), "app_id"), list(_CODED)).drop("tstmp_submit")


@query("library_ordinal_codes", """
WITH c AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS code FROM part GROUP BY p_type)
SELECT p_partkey, CAST(code AS DOUBLE) AS code FROM part JOIN c USING (p_type)""")
def library_ordinal_codes(spark, sf):
    """Codes by falling frequency: the popularity ranks of all values."""
    rows = table(spark, sf, "part").select("p_partkey", "p_type")
    return M.apply_rank(rows, M.fit_rank(rows, ["p_type"], 1.0), ["p_type"]).select("p_partkey", F.col("p_type_rank").cast("double").alias("code"))


@query("encoder_map", """
WITH s AS (SELECT c_mktsegment, row_number() OVER (ORDER BY min(c_custkey)) - 1 AS i FROM customer GROUP BY 1),
n AS (SELECT c_nationkey, row_number() OVER (ORDER BY min(c_custkey)) - 1 AS i FROM customer GROUP BY 1)
SELECT c_custkey, n.i AS nation, s.i AS segment, CAST(s.i = 0 AS INT) AS segment_0, CAST(s.i = 1 AS INT) AS segment_1
FROM customer JOIN s USING (c_mktsegment) JOIN n USING (c_nationkey)""")
def encoder_map(spark, sf):
    """One table of codes for several columns, fitted once, then applied as numbers and as a sparse vector."""
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    state = M.prepare(M.fit_codes(rows, ["segment", "nation"], "c_custkey"), "code")
    coded = M.apply_codes(M.one_hot_vector(rows, state, "segment", "flags"), state, ["segment", "nation"])
    hot = vector_to_array("flags")
    return coded.select("c_custkey", F.col("nation").cast("long").alias("nation"), F.col("segment").cast("long").alias("segment"),
                        hot[0].cast("int").alias("segment_0"), hot[1].cast("int").alias("segment_1"))


@query("one_hot_flags", """
WITH c AS (SELECT o_orderstatus, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS i FROM orders GROUP BY 1)
SELECT o_orderkey, CAST(i = 0 AS INT) AS o_orderstatus_0, CAST(i = 1 AS INT) AS o_orderstatus_1, CAST(i = 2 AS INT) AS o_orderstatus_2
FROM orders JOIN c USING (o_orderstatus)""")
def one_hot_flags(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return M.one_hot(rows, M.fit_codes(rows, ["o_orderstatus"], "o_orderkey"), "o_orderstatus").drop("o_orderstatus")


_SLOT = lambda c: f"CAST(('0x' || substr(md5({c}), 25, 8))::BIGINT % 8 AS INT)"


@query("hashed_counters", f"""
WITH h AS (SELECT p_partkey, {_SLOT("p_brand")} AS a, {_SLOT("p_type")} AS b FROM part)
SELECT p_partkey, {", ".join(f"CAST(a = {j} AS INT) + CAST(b = {j} AS INT) AS col_{j}" for j in range(8))} FROM h""")
def hashed_counters(spark, sf):
    return M.hash_encode(table(spark, sf, "part").select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"])


@query("leave_one_out_rates", """
WITH g AS (SELECT p_brand, sum(y) AS s, count(*) AS c FROM (SELECT p_brand, CASE WHEN p_size > 25 THEN 1.0::DOUBLE ELSE 0 END AS y FROM part) GROUP BY 1)
SELECT p_partkey, round((s - CASE WHEN p_size > 25 THEN 1 ELSE 0 END) / (c - 1), 9) AS loo FROM part JOIN g USING (p_brand)""")
def leave_one_out_rates(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_brand", (F.col("p_size") > 25).cast("int").alias("y"))
    return M.leave_one_out(rows, "p_brand", "y", "loo").select("p_partkey", F.round("loo", 9).alias("loo"))


@query("standard_scaled", """
WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd
           FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01')
SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_discount - md) / sd, 6) AS l_discount
FROM lineitem, s""")
def standard_scaled(spark, sf):
    """The scale is fitted on training rows only and applied to all."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate")
    early = rows.filter(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp"))
    state = M.fit_scale(early, ["l_quantity", "l_discount"])
    scaled = M.apply_scale(rows, state, ["l_quantity", "l_discount"])
    return scaled.select("l_orderkey", "l_linenumber", *(F.round(c, 6).alias(c) for c in ("l_quantity", "l_discount")))


@query("event_value_ecdf", """
WITH d AS (SELECT value AS v, count(*) AS n FROM events GROUP BY 1)
SELECT v, CAST(sum(n) OVER (ORDER BY v) AS DOUBLE) / ((SELECT count(*) FROM events) + 1.0::DOUBLE) AS p FROM d""")
def event_value_ecdf(spark, sf):
    return E.ecdf(table(spark, sf, "events"), "value")


@query("quantity_ecdf_lookup", """
WITH d AS (SELECT CAST(l_quantity AS DOUBLE) AS v, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
k AS (SELECT v, CAST(sum(n) OVER (ORDER BY v) AS DOUBLE) / (sum(n) OVER () + 1.0::DOUBLE) AS p FROM d),
s AS (SELECT v, p, lead(v) OVER (ORDER BY v) AS v1, lead(p) OVER (ORDER BY v) AS p1 FROM k),
q AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) + l_discount * 10 AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, round(CASE WHEN v IS NULL THEN (SELECT arg_min(p, v) FROM k) WHEN v1 IS NULL THEN p
       ELSE p + (x - v) * (p1 - p) / (v1 - v) END, 9) AS p FROM q ASOF LEFT JOIN s ON x >= v""")
def quantity_ecdf_lookup(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag")
    knots = E.ecdf(rows.filter("l_returnflag = 'R'"), "l_quantity")
    x = F.col("l_quantity").cast("double") + F.col("l_discount") * 10
    return E.ecdf_lookup(rows, x, knots).select("l_orderkey", "l_linenumber", F.round("p", 9).alias("p"))
