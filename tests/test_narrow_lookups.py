"""Rows are looked up, and written, before their features make them wide; constant maps come ahead of shuffled lookups."""

from datetime import date

from conftest import values
from pyspark.sql import functions as F

from sievepoint.catalog import modelling as Q
from sievepoint.operators import fitted as T
from sievepoint.operators.lookup import Sized
from sievepoint.plans import features as P, state as S

SF = "/root/testdata/sf0.001"


def _written(monkeypatch):
    """The widths of the tables that the feature step writes."""
    widths, true = [], P.materialize

    def noted(df):
        widths.append(len(df.columns))
        return true(df)
    monkeypatch.setattr(P, "materialize", noted)
    return widths


def test_a_fit_writes_rows_before_their_features(spark, monkeypatch):
    lookups = S.ready_lookups(Q._lookups(spark, SF))
    rows = Q.marked(spark, SF)
    widths = _written(monkeypatch)
    P.transform(rows, Q.END_TO_END, lookups, None, Q.DECLARED_TEXT, "train")
    # The looked-up rows with two values beside them, then the counted rows.
    assert len(widths) == 2 and widths[0] == len(rows.columns) + 2


def test_lookups_see_recoded_text_and_are_not_recoded(spark, rows):
    """A phone "N" is recoded to "false", whose shape is that of an area code; a country "N" stays as it is."""
    cells = {"app_id": "long", "tstmp_create": "timestamp", "tstmp_submit": "timestamp", "email": "string", "race_ethnic": "string", "hs_comp_date": "string",
             "birthdate": "string", "state": "string", "mainphone": "string", "ip_address": "string"}
    data = [(i, None, None, None, None, None, None, "Y", phone, ip) for i, (phone, ip) in enumerate(
        [("N", "0.0.0.9"), ("(916) 1", "unknown"), (None, "N"), ("916", None), ("(777) 1", "0.0.0.30")])]
    df = rows(data, ", ".join(f"{c} {k}" for c, k in cells.items()))
    lookups = {"area_codes": rows([("als", "CA"), ("916", "NV")], "code string, state string"),
               "ip_ranges": rows([(5, "N"), (20, "Y"), (50, "US")], "start long, country string")}
    out = P.add_features(df, P.FeatureOptions(as_of=date(2024, 2, 8)), lookups)
    assert out.columns[-3:] == ["area_code_state", "ip_country", "ip_US"]
    assert values(out, "app_id", "state", "area_code_state", "ip_country") == [
        (0, "true", "CA", "N"), (1, "true", "non-CA", "-"), (2, "true", "na", "ZZ"), (3, "true", "na", "ZZ"), (4, "true", "unknown", "Y")]
    # Without the recode the phone is one letter.
    plain = P.add_features(df, P.FeatureOptions(as_of=date(2024, 2, 8), exclude_race_gender=True), lookups)
    assert values(plain, "app_id", "state", "area_code_state")[0] == (0, "Y", "na")


def test_constant_maps_come_ahead_of_shuffled_lookups(spark, rows):
    names = ["a", "b", "c"]
    df = rows([(1, "x", "p", "u"), (2, "y", None, "v"), (3, None, "q", "w"), (4, "z", "p", None)], "id int, a string, b string, c string")
    codes = rows([(f, v, i) for f, vs in (("a", "xy"), ("b", "pq"), ("c", "uv")) for i, v in enumerate(vs)], "feature string, value string, code long")
    ready = T.prepare(codes, "code")
    long = T.Fitted("code", {c: m for c, m in ready.constants.items() if c != "b"}, ready.kind,
                    {"b": Sized(codes.where("feature = 'b'").select(F.col("value").alias("_v"), F.col("code").alias("_found")), False)}, {})
    out = T.apply_codes(df, long, names)
    assert out.columns == df.columns and values(out) == values(T.apply_codes(df, ready, names)) == [
        (1, 0, 0, 0), (2, 1, -1, 1), (3, -1, 1, -1), (4, -1, 0, -1)]
    # The shuffled join meets codes in place of the texts a and c.
    plan, joins = out._jdf.queryExecution().analyzed(), []
    todo = [plan]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Join":
            joins.append({f.name(): f.dataType().simpleString() for f in (node.output().apply(i) for i in range(node.output().size()))})
    assert any(j.get("a") == j.get("c") == "bigint" and j.get("b") == "string" for j in joins)


def test_wide_steps_are_cut_in_a_session_of_default_settings(spark):
    session = spark.newSession()
    P.transform(Q.marked(session, SF).limit(5), Q.END_TO_END, None, None, Q.DECLARED_TEXT, "train")
    assert session.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
