"""The query list and the views that queries and their checks share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievepoint.runtime import spread

QUERIES, ORACLES = {}, {}

# One expression per column, valid in Spark and in ANSI engines alike.
_N = "event_id"
_SECS = (f"CASE {_N} % 50 WHEN 7 THEN 90 WHEN 8 THEN 89 WHEN 9 THEN 91 "
         "ELSE CAST(floor(value) AS BIGINT) END")
_DOMAIN = (f"CASE {_N} % 12 WHEN 0 THEN '@Gmail.com' WHEN 1 THEN '@mail.foo.co' WHEN 2 THEN '@yopmail.com' "
           f"WHEN 3 THEN '@ymail.com' WHEN 4 THEN '@Example.RU' WHEN 5 THEN '@x.tk' "
           f"WHEN 6 THEN '@googlemail.com' WHEN 7 THEN '' WHEN 9 THEN '@school.edu' "
           f"WHEN 10 THEN concat('@host', CAST(user_id % 40 AS STRING), '.org') ELSE '@mail.de' END")
_BIRTH_YEAR = f"CASE WHEN {_N} % 31 = 0 THEN 2090 ELSE 1940 + user_id % 70 END"
APPLICATION_COLUMNS = {
    "app_id": _N,
    "college_id": f"CASE WHEN {_N} % 101 = 0 THEN NULL ELSE concat('C', CAST(user_id AS STRING)) END",
    "confirmed_fraud": "event_type = 'error'",
    "fraud_status": f"CAST(3 + {_N} % 5 AS INT)",
    "fraud_score": f"CASE WHEN {_N} % 23 = 0 THEN NULL WHEN {_N} % 29 = 0 THEN CAST(0.3 AS DOUBLE) "
                   "ELSE least(value / CAST(100 AS DOUBLE), CAST(1 AS DOUBLE)) END",
    "email": f"CASE WHEN {_N} % 12 = 8 THEN NULL ELSE concat(CASE WHEN user_id % 3 = 0 THEN 'A.' ELSE 'b' END, "
             f"'User', CAST(user_id AS STRING), {_DOMAIN}) END",
    "ip_address": f"CASE {_N} % 20 WHEN 0 THEN 'unknown' WHEN 1 THEN NULL WHEN 2 THEN '2001:db8::1' "
                  f"ELSE concat(CAST({_N} * 37 % 224 AS STRING), '.', CAST(user_id % 256 AS STRING), '.', "
                  f"CAST({_N} * 7 % 256 AS STRING), '.', CAST({_N} * 3 % 256 AS STRING)) END",
    "mainphone": f"CASE {_N} % 9 WHEN 0 THEN '(916) 555-0100' WHEN 1 THEN '916 555' WHEN 2 THEN NULL "
                 f"ELSE concat('(', CAST(200 + user_id * 7 % 700 AS STRING), ') 555-', lpad(CAST({_N} % 10000 AS STRING), 4, '0')) END",
    "postalcode": f"CASE {_N} % 8 WHEN 0 THEN '95819-1234' WHEN 1 THEN 'K1A 0B1' WHEN 2 THEN '-12' "
                  f"WHEN 3 THEN '94,1' WHEN 4 THEN NULL ELSE lpad(CAST(user_id * 37 % 100000 AS STRING), 5, '0') END",
    "perm_postalcode": f"CASE WHEN {_N} % 3 = 0 THEN NULL ELSE lpad(CAST({_N} * 13 % 100000 AS STRING), 5, '0') END",
    "birthdate": f"CASE WHEN {_N} % 17 = 0 THEN NULL ELSE concat(CAST({_BIRTH_YEAR} AS STRING), '-', "
                 f"lpad(CAST(1 + {_N} % 12 AS STRING), 2, '0'), '-', lpad(CAST(1 + {_N} % 28 AS STRING), 2, '0')) END",
    "hs_comp_date": f"CASE WHEN {_N} % 19 = 0 THEN NULL WHEN {_N} % 37 = 0 THEN 'bad' ELSE "
                    f"concat(CAST(1938 + user_id % 70 + {_N} % 30 AS STRING), '-06-', lpad(CAST(1 + {_N} % 31 AS STRING), 2, '0')) END",
    "firstname": f"CASE {_N} % 13 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN NULL WHEN 3 THEN '' "
                 "ELSE concat('First', CAST(user_id AS STRING)) END",
    "middlename": f"CASE WHEN {_N} % 2 = 0 THEN NULL WHEN {_N} % 7 = 0 THEN 'None' ELSE '  ' END",
    "lastname": f"CASE WHEN {_N} % 43 = 0 THEN NULL ELSE event_type END",
    "ssn": f"CASE WHEN {_N} % 4 = 0 THEN NULL ELSE lpad(CAST({_N} AS STRING), 9, '0') END",
    "race_ethnic": f"translate(substr(md5(CAST({_N} AS STRING)), 1, 21), '0123456789abcdef', 'NNNNYNNNNYNNNNNY')",
    "city": f"CASE WHEN {_N} % 53 = 0 THEN NULL ELSE concat('City', CAST(user_id * 11 % 60 AS STRING)) END",
    "state": f"CASE {_N} % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'CA' WHEN 2 THEN 'NV' WHEN 3 THEN 'OR' WHEN 4 THEN NULL ELSE 'Y' END",
    "hispanic": f"CASE {_N} % 5 WHEN 0 THEN 't' WHEN 1 THEN 'F' WHEN 2 THEN NULL WHEN 3 THEN 'T' ELSE 'f' END",
    "college_count": f"CASE WHEN {_N} % 6 = 1 THEN NULL ELSE CAST({_N} % 6 AS INT) END",
    "campaign": "'spring'",
    "campaign1": f"CASE WHEN {_N} % 2 = 0 THEN 'a' ELSE NULL END",
    "col1_name": "concat('School', CAST(user_id % 10 AS STRING))",
    "integrity_fg_01": f"{_N} % 2 = 0",
}
_SPARK_TIMES = {
    "tstmp_submit": "CAST(ts AS TIMESTAMP)",
    "tstmp_create": f"CASE WHEN {_N} % 97 = 0 THEN NULL ELSE timestampadd(SECOND, -({_SECS}), CAST(ts AS TIMESTAMP)) END",
}
_SQL_TIMES = {
    "tstmp_submit": "ts",
    "tstmp_create": f"CASE WHEN {_N} % 97 = 0 THEN NULL ELSE ts - to_seconds({_SECS}) END",
}
_RANGE_START = "c_custkey * 2654435761 % 4294967296"
_RANGE_COUNTRY = ("CASE WHEN c_nationkey = 7 THEN NULL WHEN c_nationkey = 3 THEN 'US' "
                  "ELSE concat('C', CAST(c_nationkey AS STRING)) END")
_AREA_CODE = "CASE WHEN s_suppkey = 0 THEN '916' ELSE CAST(200 + s_suppkey * 7 % 700 AS STRING) END"
_AREA_STATE = "CASE WHEN s_suppkey = 0 OR s_nationkey % 4 = 0 THEN 'CA' ELSE 'NV' END"

_as_list = lambda columns: ", ".join(f"{e} AS {c}" for c, e in columns.items())
VIEWS = {
    "applications": f"SELECT {_as_list({**APPLICATION_COLUMNS, **_SQL_TIMES})} FROM events",
    "ip_ranges": f"SELECT {_RANGE_START} AS start, {_RANGE_COUNTRY} AS country FROM customer",
    "area_codes": f"SELECT {_AREA_CODE} AS code, min({_AREA_STATE}) AS state FROM supplier GROUP BY 1",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Read stamps as timestamps: a cast in the plan would keep their filters out of the scan.
    spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def applications(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Applications composed from the event table, with missing and malformed values."""
    rows = {**APPLICATION_COLUMNS, **_SPARK_TIMES}
    events = table(spark, sf_dir, "events")
    if not columns:  # the full feature step is long per row
        events = spread(events, "event_id")
    return events.selectExpr(*(f"{rows[c]} AS {c}" for c in (columns or rows)))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(f"{_RANGE_START} AS start", f"{_RANGE_COUNTRY} AS country")


def area_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "supplier").selectExpr(f"{_AREA_CODE} AS code", f"{_AREA_STATE} AS state")
            .groupBy("code").agg(F.min("state").alias("state")))


def query(name: str, oracle: str | None = None, **extra_views: str):
    """Register a query; its check sees the shared views it names."""
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            views = {**VIEWS, **extra_views}
            needed = [v for v in views if v in oracle or any(v in extra_views.get(w, "") for w in extra_views if w in oracle)]
            prefix = ", ".join(f"{v} AS ({views[v]})" for v in needed)
            if prefix:
                body = oracle.strip()
                joined = f"WITH {prefix}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {prefix} {body}"
            else:
                joined = oracle.strip()
            ORACLES[name] = joined
        return fn
    return register
