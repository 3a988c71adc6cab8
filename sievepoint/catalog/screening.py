"""Feature, rule and lookup queries over applications."""

import uuid

from pyspark.sql import functions as F

from sievepoint import constants as K
from sievepoint.catalog.quality import AS_OF
from sievepoint.catalog.registry import applications, area_codes, ip_ranges, query, table
from sievepoint.functions import cleaning as C, identity as I, temporal as D
from sievepoint.operators import lookup as L, ranges as N, rules as R
from sievepoint.plans import features as P
from sievepoint.runtime import state_dir

_words = lambda words: "(" + ", ".join(f"'{w}'" for w in sorted(set(words))) + ")"
_DOM = "nullif(split_part(lower(email), '@', 2), '')"
_LAST = "split_part(lower(email), '.', -1)"
_SECONDS = "date_diff('microsecond', tstmp_create, tstmp_submit) / 1e6"
_IP = "CASE WHEN ip_address = 'unknown' THEN '000.000.000.000' ELSE ip_address END"


@query("time_features", f"""
SELECT app_id, {_SECONDS} AS app_duration,
       CAST(isodow(tstmp_create) - 1 AS INT) AS create_wday, CAST(hour(tstmp_create) AS INT) AS create_hour,
       CAST(hour(tstmp_create) // 4 * 4 AS INT) AS create_4hrblock,
       CAST(isodow(tstmp_submit) - 1 AS INT) AS submit_wday, CAST(hour(tstmp_submit) AS INT) AS submit_hour,
       CAST(hour(tstmp_submit) // 4 * 4 AS INT) AS submit_4hrblock FROM applications""")
def time_features(spark, sf):
    rows = applications(spark, sf, "app_id", "tstmp_create", "tstmp_submit")
    return P.time_features(rows).drop("tstmp_create", "tstmp_submit")


@query("order_minute_stamps", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day, CAST(o_orderkey % 24 AS INT) AS hour_parsed,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 60 AS INT) END AS minute_parsed FROM orders
WHERE o_orderkey % 7 <> 0
UNION ALL SELECT o_orderkey, NULL, NULL, NULL FROM orders WHERE o_orderkey % 7 = 0""")
def order_minute_stamps(spark, sf):
    text = F.when(F.col("o_orderkey") % 7 == 0, "not a time").otherwise(F.concat(
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "),
        F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0")))
    stamp = D.minute_timestamp(text)
    return table(spark, sf, "orders").select(
        "o_orderkey", F.to_date(stamp).cast("string").alias("day"), F.hour(stamp).alias("hour_parsed"),
        F.minute(stamp).alias("minute_parsed"))


@query("email_features", f"""
SELECT app_id, lower(email) AS email, regexp_replace(lower(email), '[^\\w]', '', 'g') AS email_stripped,
       {_DOM} AS email_domain,
       CASE WHEN contains({_DOM}, '.') THEN split_part({_DOM}, '.', 2) END AS short_domain,
       coalesce({_LAST} IN {_words(K.FEATURE_DOMAIN_LIST)}, false) AS blacklisted_domain FROM applications""")
def email_features(spark, sf):
    return P.email_features(applications(spark, sf, "app_id", "email"))


@query("anonymous_email_features", f"""
SELECT app_id, email, lower(email) AS email_domain,
       CASE WHEN contains(email, '.') THEN split_part(lower(email), '.', 2) END AS short_domain
FROM (SELECT app_id, split_part(email, '@', 2) AS email FROM applications)""")
def anonymous_email_features(spark, sf):
    rows = applications(spark, sf, "app_id", "email").select("app_id", F.split_part("email", F.lit("@"), F.lit(2)).alias("email"))
    return P.email_features(rows, anonymized=True)


@query("page_host_labels", """
WITH h AS (SELECT page_id, split_part(split_part(url, '/', 3), ':', 1) AS host FROM pages)
SELECT page_id, host, CASE WHEN contains(host, '.') THEN split_part(host, '.', 2) END AS second_label,
       split_part(lower(host), '.', -1) AS last_label FROM h""")
def page_host_labels(spark, sf):
    host = F.split_part(F.split_part("url", F.lit("/"), F.lit(3)), F.lit(":"), F.lit(1))
    return table(spark, sf, "pages").select("page_id", host.alias("host")).select(
        "page_id", "host", I.short_domain(F.col("host")).alias("second_label"),
        I.last_label(F.col("host")).alias("last_label"))


_FLAGS = ", ".join(f"substr(race_ethnic, {i}, 1) = 'Y' AS {n}" for i, n in enumerate(K.RACE_FLAGS, 1))


@query("race_flag_columns", f"SELECT app_id, {_FLAGS} FROM applications")
def race_flag_columns(spark, sf):
    return applications(spark, sf, "app_id", "race_ethnic").select(
        "app_id", *C.flag_columns(F.col("race_ethnic"), K.RACE_FLAGS))


_recode = lambda c: f"CASE {c} WHEN 'Y' THEN 'true' WHEN 'N' THEN 'false' ELSE {c} END AS {c}"


@query("yes_no_recode", f"""
SELECT app_id, {_recode("firstname")}, {_recode("state")}, {_recode("lastname")} FROM applications""")
def yes_no_recode(spark, sf):
    return C.recode_frame(applications(spark, sf, "app_id", "firstname", "state", "lastname"))


@query("date_expansion", """
WITH d AS (SELECT app_id, TRY_CAST(hs_comp_date AS TIMESTAMP) AS t FROM applications)
SELECT app_id, CAST(CAST(t AS DATE) AS STRING) AS hs_comp_date, CAST(year(t) AS INT) AS hs_comp_date_y,
       CAST(month(t) AS INT) AS hs_comp_date_m, CAST(day(t) AS INT) AS hs_comp_date_d FROM d""")
def date_expansion(spark, sf):
    out = P.date_features(applications(spark, sf, "app_id", "hs_comp_date"))
    return out.withColumn("hs_comp_date", F.to_date("hs_comp_date").cast("string"))


_postal = lambda c: (f"TRY_CAST(regexp_replace(regexp_extract(coalesce({c}, 'nan'), '^[^.-]*'), "
                     f"'[a-zA-Z -,/:]', '0', 'g') AS DOUBLE) AS {c}")


@query("postal_numbers", f"SELECT app_id, {_postal('postalcode')}, {_postal('perm_postalcode')} FROM applications")
def postal_numbers(spark, sf):
    rows = applications(spark, sf, "app_id", "postalcode", "perm_postalcode")
    return rows.select("app_id", *(I.postal_number(F.col(c)).alias(c) for c in ("postalcode", "perm_postalcode")))


# Columns that the event table cannot stand for are missing at a pace of their own.
_HELD = ("birthdate", "firstname", "middlename", "lastname", "mainphone", "ssn")
_PACED = {c: f"CASE WHEN app_id % {i} = 0 THEN NULL ELSE 'x' END" for i, c in enumerate((c for c in K.PERSONAL_COLUMNS if c not in _HELD), 2)}
_PII_VIEW = f"(SELECT app_id, {', '.join(_HELD)}, {', '.join(f'{e} AS {c}' for c, e in _PACED.items())} FROM applications)"


@query("personal_missing_flags", f"""
SELECT app_id, {", ".join(f"{c} IS NULL AS {c}_isna" for c in K.PERSONAL_COLUMNS)},
       {" + ".join(f"CAST({c} IS NULL AS INT)" for c in K.PERSONAL_COLUMNS)} AS num_pii_na FROM {_PII_VIEW}""")
def personal_missing_flags(spark, sf):
    """Flags of all 18 personal columns and their number."""
    rows = applications(spark, sf, "app_id", *_HELD).selectExpr("*", *(f"{e} AS {c}" for c, e in _PACED.items()))
    return rows.select("app_id", *C.missing_flags(K.PERSONAL_COLUMNS))


_AGE = lambda end: f"CAST(floor(floor(date_diff('microsecond', b, {end}) / 86400e6) / 365) AS INT)"


@query("birthdate_and_ages", f"""
WITH s AS (SELECT app_id, tstmp_submit, TRY_CAST(hs_comp_date AS TIMESTAMP) AS hs,
             CASE WHEN TRY_CAST(split_part(birthdate, '-', 1) AS INT) <= {AS_OF.year} THEN TRY_CAST(birthdate AS TIMESTAMP) END AS b
      FROM applications)
SELECT app_id, CAST(day(b) AS INT) AS birth_day, CAST(month(b) AS INT) AS birth_month, CAST(year(b) AS INT) AS birth_year,
       {_AGE("tstmp_submit")} AS application_age, {_AGE("hs")} AS hs_comp_age FROM s""")
def birthdate_and_ages(spark, sf):
    rows = applications(spark, sf, "app_id", "birthdate", "hs_comp_date", "tstmp_submit")
    birth = D.guarded_birthdate(F.col("birthdate"), AS_OF)
    return rows.select(
        "app_id", F.dayofmonth(birth).alias("birth_day"), F.month(birth).alias("birth_month"),
        F.year(birth).alias("birth_year"), D.whole_years(birth, F.col("tstmp_submit")).alias("application_age"),
        D.whole_years(birth, D.parse_timestamp(F.col("hs_comp_date"))).alias("hs_comp_age"))


@query("name_phone_state_features", """
SELECT app_id, CAST(length(firstname) AS INT) AS firstname_length, CAST(length(middlename) AS INT) AS middlename_length,
       CAST(length(lastname) AS INT) AS lastname_length, split_part(mainphone, ' ', 1) AS area_code,
       state = 'CA' AS "in_CA" FROM applications""")
def name_phone_state_features(spark, sf):
    names = ("firstname", "middlename", "lastname")
    rows = applications(spark, sf, "app_id", *names, "mainphone", "state")
    return rows.select("app_id", *(F.length(c).alias(f"{c}_length") for c in names),
                       I.area_code(F.col("mainphone")).alias("area_code"), (F.col("state") == "CA").alias("in_CA"))


@query("submit_hour_copies", """
SELECT app_id, CAST(hour(tstmp_submit) AS INT) AS tstmp_submit_hour,
       CAST(isodow(tstmp_submit) - 1 AS INT) AS tstmp_submit_weekday FROM applications""")
def submit_hour_copies(spark, sf):
    return applications(spark, sf, "app_id", "tstmp_submit").select(
        "app_id", F.hour("tstmp_submit").alias("tstmp_submit_hour"),
        D.monday_weekday(F.col("tstmp_submit")).alias("tstmp_submit_weekday"))


_IP_NUMBER = " + ".join(f"TRY_CAST(string_split(ip, '.')[{-4 + i}] AS BIGINT) * {256 ** (3 - i)}" for i in range(4))
_IP_PARTS = ", ".join(f"string_split(ip, '.')[{i + 1}] AS ip{i}" for i in range(4))


@query("network_address_parts", f"""
WITH a AS (SELECT app_id, {_IP} AS ip FROM applications)
SELECT app_id, ip AS ip_address, {_IP_PARTS}, {_IP_NUMBER} AS ip_number FROM a""")
def network_address_parts(spark, sf):
    ip = I.known_address(F.col("ip_address"))
    return applications(spark, sf, "app_id", "ip_address").select(
        "app_id", ip.alias("ip_address"), *(I.address_part(ip, i).alias(f"ip{i}") for i in range(4)),
        I.address_number(ip).alias("ip_number"))


_COUNTRY = f"""
WITH a AS (SELECT app_id, {_IP} AS ip FROM applications), n AS (SELECT app_id, {_IP_NUMBER} AS x FROM a),
j AS (SELECT app_id, x, start, country FROM n ASOF LEFT JOIN ip_ranges ON x >= start)
SELECT app_id, CASE WHEN x IS NULL THEN 'ZZ' WHEN start IS NULL OR x >= (SELECT max(start) FROM ip_ranges) THEN '-'
                    ELSE coalesce(country, 'ZZ') END AS ip_country FROM j"""


def _countries(spark, sf, **kw):
    rows = applications(spark, sf, "app_id", "ip_address")
    x = I.address_number(I.known_address(F.col("ip_address")))
    return N.range_lookup(rows, x, ip_ranges(spark, sf), "ip_country", **kw).drop("ip_address")


@query("country_by_address_range", _COUNTRY)
def country_by_address_range(spark, sf):
    return _countries(spark, sf)


@query("country_by_large_range_table", _COUNTRY)
def country_by_large_range_table(spark, sf):
    """The path taken when the ranges are too many to broadcast."""
    return _countries(spark, sf, max_rows=0)


@query("area_code_states", """
WITH p AS (SELECT app_id, split_part(mainphone, ' ', 1) AS t FROM applications)
SELECT app_id, CASE WHEN t IS NULL OR length(t) <> 5 THEN 'na' WHEN code IS NULL THEN 'unknown'
                    WHEN state = 'CA' THEN 'CA' ELSE 'non-CA' END AS area_code_state
FROM p LEFT JOIN area_codes ON length(t) = 5 AND code = substr(t, 2, 3)""")
def area_code_states(spark, sf):
    rows = applications(spark, sf, "app_id", "mainphone").select(
        "app_id", I.area_code(F.col("mainphone")).alias("area_code"))
    return L.area_state(rows, area_codes(spark, sf)).drop("area_code")


_R1 = f"coalesce({_SECONDS} <= 90, false)"
_R3 = (f"coalesce(contains(split_part(lower(email), '@', 1), '.') AND {_DOM} IN {_words(K.PERIOD_DOMAIN_LIST)}, false)")
_R4 = f"coalesce({_DOM} IN {_words(K.ADDRESS_DOMAIN_LIST)}, false)"
_R5 = f"coalesce({_LAST} IN {_words(K.TOP_DOMAIN_LIST)}, false)"
_RULE_INPUT = ("app_id", "tstmp_create", "tstmp_submit", "email", "confirmed_fraud", "fraud_score")


def _rule_rows(spark, sf):
    return applications(spark, sf, *_RULE_INPUT).withColumn(
        "app_duration", D.seconds_between(F.col("tstmp_create"), F.col("tstmp_submit")))


@query("single_rules", f"""
SELECT app_id, {_R1} AS time_limit, {_R3} AS period, {_R4} AS address, {_R5} AS top_domain FROM applications""")
def single_rules(spark, sf):
    email = F.col("email")
    return _rule_rows(spark, sf).select(
        "app_id", R.time_limit_rule(F.col("app_duration")).alias("time_limit"), R.period_rule(email).alias("period"),
        R.address_rule(email).alias("address"), R.top_domain_rule(email).alias("top_domain"))


RULE_SQL = f"{_R1} OR {_R4} OR {_R5}"


@query("combined_rule_flag", f"SELECT app_id, CAST({RULE_SQL} AS INT) AS y_rule FROM applications")
def combined_rule_flag(spark, sf):
    return R.rule_flag(_rule_rows(spark, sf)).select("app_id", "y_rule")


@query("combined_rule_flag_with_periods", f"""
SELECT app_id, CAST({_R3} OR {_R4} OR {_R5} AS INT) AS y_rule FROM applications""")
def combined_rule_flag_with_periods(spark, sf):
    options = R.RuleOptions(time_limit=None, period_list=K.PERIOD_DOMAIN_LIST)
    return R.rule_flag(_rule_rows(spark, sf), options).select("app_id", "y_rule")


@query("rule_flag_from_list_files", f"SELECT app_id, CAST({_R1} OR {_R3} OR {_R4} OR {_R5} AS INT) AS y_rule FROM applications")
def rule_flag_from_list_files(spark, sf):
    """Rules whose lists are text files, with blank lines, repeats and other cases in them."""
    rows, files = _rule_rows(spark, sf), {}
    for name, words in (("period_list", K.PERIOD_DOMAIN_LIST), ("address_list", K.ADDRESS_DOMAIN_LIST), ("top_domain_list", K.TOP_DOMAIN_LIST)):
        files[name] = f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}"
        lines = [*words, "", " ", words[0].upper(), f" {words[0]} "]
        spark.createDataFrame([(w,) for w in lines], "value string").write.text(files[name])
    return R.rule_flag(rows, R.options_from_files(spark, **files)).select("app_id", "y_rule")


@query("label_overrides", f"""
SELECT app_id, CASE WHEN {_SECONDS} < 90 THEN true ELSE confirmed_fraud END AS short_label,
       confirmed_fraud OR {_R1} OR {_R4} OR {_R5} AS rule_label FROM applications""")
def label_overrides(spark, sf):
    rows = R.rule_flag(_rule_rows(spark, sf))
    label = F.col("confirmed_fraud")
    return rows.select("app_id", R.override_label(label, F.col("app_duration")).alias("short_label"),
                       R.merge_rule_label(label, F.col("y_rule")).alias("rule_label"))


@query("rule_model_blend", f"""
WITH r AS (SELECT app_id, fraud_score AS p, {_R4} OR {_R5} AS rule FROM applications),
b AS (SELECT app_id, CASE WHEN rule AND p <= 0.3 THEN 1.0::DOUBLE ELSE p END AS prob FROM r)
SELECT app_id, prob, CAST(prob > 0.3 AS INT) AS class_strict, CAST(prob >= 0.3 AS INT) AS class_at FROM b""")
def rule_model_blend(spark, sf):
    rows = R.rule_flag(_rule_rows(spark, sf), R.RuleOptions(time_limit=None))
    blended = rows.select("app_id", R.blend(F.col("fraud_score"), F.col("y_rule")).alias("prob"))
    return blended.select("*", R.decide(F.col("prob")).alias("class_strict"),
                          R.decide(F.col("prob"), strict=False).alias("class_at"))


@query("listed_market_customers", """
SELECT c_custkey, c_mktsegment IN (SELECT c_mktsegment FROM customer GROUP BY 1 HAVING avg(c_acctbal) > 4500) AS listed
FROM customer""")
def listed_market_customers(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    listed = rows.groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("b")).filter("b > 4500")
    return L.in_table(rows, F.col("c_mktsegment"), listed, "c_mktsegment", "listed").select("c_custkey", "listed")


@query("application_features", f"""
WITH a AS (SELECT *, {_SECONDS} AS secs, {_IP} AS ip FROM applications)
SELECT app_id, secs AS app_duration, {_DOM} AS email_domain, {_postal("postalcode")},
       coalesce({_LAST} IN {_words(K.FEATURE_DOMAIN_LIST)}, false) AS blacklisted_domain,
       CAST(length(firstname) AS INT) AS firstname_length,
       CASE state WHEN 'Y' THEN 'true' ELSE state END AS state, string_split(ip, '.')[1] AS ip0,
       CAST(year(TRY_CAST(hs_comp_date AS TIMESTAMP)) AS INT) AS hs_comp_date_y, state = 'CA' AS "in_CA",
       split_part(mainphone, ' ', 1) AS area_code, CAST(hour(tstmp_submit) AS INT) AS tstmp_submit_hour,
       CAST(isodow(tstmp_submit) - 1 AS INT) AS tstmp_submit_weekday, {_postal("perm_postalcode")},
       CAST(length(lastname) AS INT) AS lastname_length,
       {len(K.PERSONAL_COLUMNS) - len(_HELD)} + {" + ".join(f"CAST({c} IS NULL AS INT)" for c in _HELD if c != "birthdate")}
         + CAST(birthdate IS NULL AS INT) AS num_pii_na FROM a""")
def application_features(spark, sf):
    opts = P.FeatureOptions(as_of=AS_OF)
    out = P.add_features(applications(spark, sf), opts,
                         {"area_codes": area_codes(spark, sf), "ip_ranges": ip_ranges(spark, sf)})
    return out.select("app_id", "app_duration", "email_domain", "postalcode", "blacklisted_domain",
                      "firstname_length", "state", "ip0", "hs_comp_date_y", "in_CA", "area_code", "tstmp_submit_hour",
                      "tstmp_submit_weekday", "perm_postalcode", "lastname_length", "num_pii_na")
