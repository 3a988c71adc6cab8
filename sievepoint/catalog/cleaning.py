"""Typed scans, missing values, column selection and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sievepoint import constants as V
from sievepoint.catalog.registry import applications, query, table
from sievepoint.functions import cleaning as C
from sievepoint.operators import sketches as K, trim as T
from sievepoint.operators.fitted import categorical_columns, numeric_columns, value_counts
from sievepoint.plans.stages import Stages
from sievepoint.runtime import state_dir
from sievepoint.sources import readers as S, sinks as W


def _folder(spark) -> str:
    return f"{state_dir(spark)}/sievepoint/{uuid.uuid4().hex}"


_blank = lambda c: f"CASE WHEN {c} = 'None' OR regexp_full_match({c}, ' *') THEN NULL ELSE {c} END"
_flag = lambda c: f"CASE lower({c}) WHEN 't' THEN true WHEN 'f' THEN false END"


@query("typed_csv_scan", f"""
SELECT CAST(app_id AS INT) AS app_id, CASE WHEN app_id % 41 = 0 THEN firstname || chr(10) || '"x", y' WHEN app_id % 59 = 0 OR app_id % 61 = 0 THEN NULL
            ELSE {_blank("firstname")} END AS firstname, {_blank("middlename")} AS middlename,
       {_flag("hispanic")} AS hispanic, college_count, hs_comp_date, fraud_score FROM applications""")
def typed_csv_scan(spark, sf):
    """Write applications as CSV, then scan them under the declared types; undeclared columns go.

    Half of the files have another order of columns; some names hold a line break, others a word for "missing".
    """
    path = _folder(spark)
    columns = ["app_id", "firstname", "middlename", "hispanic", "college_count", "hs_comp_date", "fraud_score", "lastname"]
    rows = applications(spark, sf, *columns).withColumn(
        "firstname", F.when(F.col("app_id") % 41 == 0, F.concat("firstname", F.lit("\n\"x\", y"))).when(F.col("app_id") % 59 == 0, "NA")
        .when(F.col("app_id") % 61 == 0, "n/a").otherwise(F.col("firstname")))
    W.write_csv(rows.filter("app_id % 2 = 0"), path)
    W.write_csv(rows.filter("app_id % 2 = 1").select(*reversed(columns)), path, "append")
    kinds = S.declared("app_id int\nfirstname str\nmiddlename str\nhispanic bool\ncollege_count int\nhs_comp_date datetime")
    return S.read_typed_csv(spark, path, kinds, {"fraud_score": "float"}, mixed_headers=True)


@query("inferred_csv_scan", """
SELECT CAST(c_custkey AS INT) AS c_custkey, c_name, c_nationkey, c_acctbal, c_custkey % 3 = 0 AS flag
FROM customer""")
def inferred_csv_scan(spark, sf):
    path = _folder(spark)
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.when(
        F.col("c_custkey") % 3 == 0, "t").otherwise("F").alias("flag"))
    W.write_csv(rows, path)
    return S.read_inferred_csv(spark, path)


@query("boolean_literals", f"""
SELECT app_id, {_flag("hispanic")} AS hispanic FROM applications""")
def boolean_literals(spark, sf):
    return applications(spark, sf, "app_id", "hispanic").select("app_id", C.parse_boolean(F.col("hispanic")).alias("hispanic"))


@query("missing_text_normalised", f"""
SELECT app_id, {_blank("firstname")} AS firstname, {_blank("middlename")} AS middlename FROM applications""")
def missing_text_normalised(spark, sf):
    return C.normalize_missing(applications(spark, sf, "app_id", "firstname", "middlename"))


@query("declared_columns", "SELECT l_orderkey, l_quantity, l_shipmode_missing FROM (SELECT l_orderkey, l_quantity, l_linenumber AS l_shipmode_missing FROM lineitem)")
def declared_columns(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_shipmode_missing", F.col("l_linenumber"))
    return T.declared_only(rows, {"l_orderkey": "int", "l_quantity": "float", "absent": "str"}, ("l_shipmode_missing",))


@query("clean_column_names", "SELECT s_suppkey AS suppkey, s_name AS suppname FROM supplier")
def clean_column_names(spark, sf):
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").alias(" supp key"), F.col("s_name").alias("supp name "))
    return T.clean_names(rows)


@query("json_record_scan", f"""
SELECT CAST(app_id AS INT) AS app_id, {_blank("firstname")} AS firstname, {_flag("hispanic")} AS hispanic, college_count
FROM applications
WHERE app_id % 7 <> 5
UNION ALL
SELECT CAST(app_id AS INT), 'twin', NULL, 3 FROM applications WHERE app_id % 3 = 0 AND app_id % 7 <> 5
UNION ALL
SELECT NULL, NULL, NULL, NULL FROM applications WHERE app_id % 7 = 5""")
def json_record_scan(spark, sf):
    """Every third text holds a list of two records, the others one record; every seventh is cut off."""
    rows = applications(spark, sf, "app_id", "firstname", "hispanic", "college_count")
    one = F.struct("app_id", "firstname", "hispanic", F.col("college_count").cast("double").alias("college_count"))
    two = F.struct("app_id", F.lit("twin").alias("firstname"), F.lit(None).cast("string").alias("hispanic"),
                   F.lit(3.0).alias("college_count"))
    text = F.when(F.col("app_id") % 3 == 0, F.to_json(F.array(one, two))).otherwise(F.to_json(one))
    text = F.when(F.col("app_id") % 7 == 5, F.substring(text, 1, 9)).otherwise(text)
    kinds = {"app_id": "int", "firstname": "str", "hispanic": "bool", "college_count": "int"}
    return S.json_records(rows.select(text.alias("body")), "body", kinds)


@query("word_list_scan", "SELECT DISTINCT lower(c_mktsegment) AS value FROM customer")
def word_list_scan(spark, sf):
    path = _folder(spark)
    table(spark, sf, "customer").select("c_mktsegment").write.text(path)
    return S.read_word_list(spark, path)


@query("saved_stage_reload", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def saved_stage_reload(spark, sf):
    path = _folder(spark)
    W.save_stage(table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), path)
    return W.load_stage(spark, path)


@query("result_dump", """
SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_linenumber AS INT) AS l_linenumber, l_returnflag = 'R' AS y,
       l_returnflag = 'R' AS y_actual, l_discount * 5 AS y_predicted FROM lineitem""")
def result_dump(spark, sf):
    path = _folder(spark)
    rows = table(spark, sf, "lineitem").select("l_quantity", "l_linenumber", (F.col("l_returnflag") == "R").alias("y"),
                                               (F.col("l_discount") * 5).alias("prob"))
    W.write_result_dump(rows, ["l_quantity", "l_linenumber"], path)
    kinds = {"l_quantity": "float", "l_linenumber": "int", "y": "bool", "y_actual": "bool", "y_predicted": "float"}
    return S.read_typed_csv(spark, path, kinds)


_STRONGEST = ", ".join(f"CASE WHEN scope = 'train' THEN (SELECT r_name FROM region WHERE r_regionkey = {i}) END AS feature{i}, "
                       f"CASE WHEN scope = 'train' THEN (SELECT 1 - r_regionkey / 10.0::DOUBLE FROM region WHERE r_regionkey = {i}) END AS feature{i}_score"
                       for i in range(10))


@query("run_history_rows", f"""
SELECT CAST(NULL AS VARCHAR) AS date, c_mktsegment AS tag, CAST(NULL AS VARCHAR) AS logfile, 'm' AS model, scope, CAST(NULL AS DOUBLE) AS "AUC",
       avg(CASE WHEN c_acctbal > 0 THEN 1.0::DOUBLE ELSE 0 END) AS "Accuracy", CAST(NULL AS DOUBLE) AS "Precision", CAST(NULL AS DOUBLE) AS "Recall",
       {_STRONGEST}, CAST(NULL AS VARCHAR) AS testset, 'customer' AS trainset
FROM customer, (SELECT unnest(['train', 'test']) AS scope) GROUP BY c_mktsegment, scope""")
def run_history_rows(spark, sf):
    """All columns of the history, train and test: training runs carry their strongest features, here the regions."""
    path = _folder(spark)
    results = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("tag")).agg(
        F.avg((F.col("c_acctbal") > 0).cast("double")).alias("Accuracy"))
    strongest = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("rank"), F.col("r_name").alias("feature"), (1 - F.col("r_regionkey") / 10.0).alias("score"))
    for scope in ("train", "test"):
        W.append_history(W.history_rows(results, strongest, scope, model="m", trainset="customer"), path)
    return W.load_stage(spark, path)


@query("without_personal_data", """
SELECT app_id, nullif(split_part(email, '@', 2), '') AS email, state, fraud_status FROM applications""")
def without_personal_data(spark, sf):
    return W.without_personal_data(applications(spark, sf), ["app_id", "email", "state", "fraud_status"])


@query("text_line_count", "SELECT count(*) AS n_lines FROM customer")
def text_line_count(spark, sf):
    path = _folder(spark)
    table(spark, sf, "customer").select("c_name").write.text(path)
    return S.line_count(spark, path)


_COUNTED = ("app_id", "college_count", "fraud_score", "confirmed_fraud", "integrity_fg_01", "firstname", "campaign1")


@query("zero_and_missing_counts", """
SELECT app_id, CAST((app_id = 0) AS INT) + coalesce(CAST(college_count = 0 AS INT), 0) + coalesce(CAST(fraud_score = 0 AS INT), 0)
       + CAST(NOT confirmed_fraud AS INT) + CAST(NOT integrity_fg_01 AS INT) + coalesce(CAST(firstname = 'N' AS INT), 0) AS zeros,
       CAST(college_count IS NULL AS INT) + CAST(fraud_score IS NULL AS INT) + CAST(firstname IS NULL AS INT)
       + CAST(campaign1 IS NULL AS INT) AS missing_values FROM applications""")
def zero_and_missing_counts(spark, sf):
    rows = C.recode_frame(applications(spark, sf, *_COUNTED))
    return rows.select("app_id", C.zero_count(rows, recoded=True).alias("zeros"), C.missing_count(rows).alias("missing_values"))


@query("trimmed_columns", """
SELECT app_id, college_id, confirmed_fraud, fraud_status, fraud_score, postalcode, perm_postalcode, race_ethnic, state,
       hispanic, college_count, campaign1 FROM applications""")
def trimmed_columns(spark, sf):
    return T.trim(applications(spark, sf))


@query("renamed_and_filled", """
SELECT app_id, coalesce(CAST(confirmed_fraud AS STRING), 'missing') AS y, coalesce(campaign1, 'missing') AS campaign1,
       coalesce(college_count, -100) AS college_count, coalesce(fraud_score, -100) AS fraud_score FROM applications""")
def renamed_and_filled(spark, sf):
    rows = applications(spark, sf, "app_id", "confirmed_fraud", "campaign1", "college_count", "fraud_score")
    return C.fill_missing(rows.withColumnRenamed("confirmed_fraud", "y"), V.FILL_TEXT, V.FILL_NUMBER)


@query("filled_unknown", "SELECT app_id, coalesce(lastname, 'Unknown') AS lastname FROM applications")
def filled_unknown(spark, sf):
    return applications(spark, sf, "app_id", "lastname").fillna("Unknown", subset=["lastname"])


@query("feature_matrix", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity, l_discount,
       CAST(coalesce(CASE WHEN l_linenumber > 3 THEN l_linenumber END, -100) AS DOUBLE) AS late_line,
       CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS returned FROM lineitem""")
def feature_matrix(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", (F.col("l_returnflag") == "R").alias("returned"),
        F.when(F.col("l_linenumber") > 3, F.col("l_linenumber")).alias("late_line"))
    return T.feature_matrix(rows, ["l_quantity", "l_discount", "late_line", "returned"], ("l_orderkey", "l_linenumber"))


@query("column_kinds_and_variety", """
SELECT 'categorical' AS kind, 'source' AS feature, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS n_values FROM documents
UNION ALL SELECT 'categorical', 'lang', count(DISTINCT lang) + max(CASE WHEN lang IS NULL THEN 1 ELSE 0 END) FROM documents
UNION ALL SELECT 'categorical', 'text', count(DISTINCT text) + max(CASE WHEN text IS NULL THEN 1 ELSE 0 END) FROM documents
UNION ALL SELECT 'numeric', 'n_chars', count(DISTINCT n_chars) FROM documents
UNION ALL SELECT 'numeric', 'doc_id', count(DISTINCT doc_id) FROM documents""")
def column_kinds_and_variety(spark, sf):
    rows = table(spark, sf, "documents")
    numbers = numeric_columns(rows)
    kind = F.when(F.col("feature").isin(numbers), "numeric").otherwise("categorical")
    return T.variety(rows, [*categorical_columns(rows), *numbers]).select(kind.alias("kind"), "feature", "n_values")


@query("low_variety_columns", "SELECT c_mktsegment, c_custkey, c_nationkey, c_acctbal FROM customer")
def low_variety_columns(spark, sf):
    """The name column has a value per row and goes."""
    return T.keep_low_variety(table(spark, sf, "customer"), 20)


_TEXTS = ("l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_partkey", "l_comment")
_AS_TEXT = {"l_shipdate": "CAST(CAST(l_shipdate AS DATE) AS STRING)", "l_orderkey": "CAST(l_orderkey AS STRING)", "l_partkey": "CAST(l_partkey AS STRING)",
            "l_comment": "CASE WHEN l_linenumber = 1 THEN NULL ELSE concat('c', CAST(l_linenumber AS STRING)) END"}


@query("low_variety_by_sketches", f"""
WITH t AS (SELECT {", ".join(f"{_AS_TEXT.get(c, c)} AS {c}" for c in _TEXTS)} FROM lineitem),
n AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n FROM t" for c in _TEXTS)})
SELECT feature FROM n WHERE n < (SELECT n FROM n WHERE feature = 'l_partkey')""")
def low_variety_by_sketches(spark, sf):
    """Columns of line items with fewer values than there are parts, from saved sketches of two parts of the data."""
    rows = table(spark, sf, "lineitem").selectExpr(*(f"{_AS_TEXT.get(c, c)} AS {c}" for c in _TEXTS), "l_linenumber % 2 = 0 AS even")
    path, texts = _folder(spark), list(_TEXTS)
    for part in (True, False):
        K.sketch_columns(rows.where(F.col("even") == part), texts, str(part)).write.mode("append").parquet(path)
    bound = rows.agg(F.count_distinct("l_partkey")).first()[0]
    few = K.low_variety(spark.read.parquet(path), bound, lambda near: T.variety(rows, near))
    return rows.select(F.explode(F.array(*map(F.lit, few))).alias("feature")).distinct()


@query("stage_row_counts", "SELECT 'applications' AS name, count(*) AS n_rows FROM applications UNION ALL SELECT 'unscored', count(*) FILTER (fraud_score IS NULL) FROM applications")
def stage_row_counts(spark, sf):
    """Rows of a saved stage's tables, counted by the pass that wrote them."""
    rows = applications(spark, sf, "app_id", "fraud_score")
    saved = Stages(spark, _folder(spark)).run("extract", "", lambda: ({"applications": rows, "unscored": rows.where("fraud_score IS NULL")}, {}))
    return spark.createDataFrame(list(saved.rows.items()), "name string, n_rows long")


@query("value_frequencies", """
SELECT 'lang' AS feature, lang AS value, count(*) AS n FROM documents GROUP BY 2
UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2""")
def value_frequencies(spark, sf):
    return value_counts(table(spark, sf, "documents"), ["lang", "source"])


@query("raw_row_counts", "SELECT count(*) AS n_rows, CAST(3 AS INT) AS n_cols, sum(CAST(fraud_score IS NULL AS INT))::BIGINT AS unscored FROM applications")
def raw_row_counts(spark, sf):
    rows = applications(spark, sf, "app_id", "fraud_score", "state")
    return S.raw_counts(rows, F.sum(F.col("fraud_score").isNull().cast("int")).alias("unscored"))
