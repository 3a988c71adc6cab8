"""Hand-made rows for the cleaning and feature rules that are easy to get wrong."""

from datetime import date, datetime

from conftest import values
from pyspark.sql import functions as F

from sievepoint import constants as K
from sievepoint.functions import cleaning as C, hashing as H, identity as I, temporal as D
from sievepoint.operators import rules as R, trim as T
from sievepoint.sources import readers as S


def one(df, column):
    return [r[0] for r in df.select(column.alias("x")).collect()]


def test_postal_numbers(rows):
    df = rows([("95819-1234",), ("K1A 0B1",), ("-12",), ("94,1",), (None,), ("12.5",)], "z string")
    assert one(df, I.postal_number(F.col("z"))) == [95819.0, 100001.0, None, 9401.0, 0.0, 12.0]


def test_email_parts(rows):
    df = rows([("A.b@Gmail.com",), ("X@Mail.Foo.CO",), ("noat",), (None,)], "e string")
    e = F.col("e")
    assert one(df, I.email_domain(e)) == ["gmail.com", "mail.foo.co", None, None]
    assert one(df, I.short_domain(I.email_domain(e))) == ["com", "foo", None, None]
    assert one(df, I.last_label(e)) == ["com", "co", "noat", None]
    assert one(df, I.email_stripped(e)) == ["abgmailcom", "xmailfooco", "noat", None]


def test_address_number(rows):
    df = rows([("1.2.3.4",), ("9.1.2.3.4",), ("2001:db8::1",), ("a.b.c.d",), (None,), ("1.2.3",)], "ip string")
    assert one(df, I.address_number(F.col("ip"))) == [16909060, 16909060, None, None, None, None]


def test_negative_age_floors(rows):
    df = rows([(datetime(2000, 6, 1), datetime(2000, 1, 1)), (datetime(1990, 1, 1), datetime(2020, 1, 1)), (None, datetime(2020, 1, 1))],
              "b timestamp, t timestamp")
    assert one(df, D.whole_years(F.col("b"), F.col("t"))) == [-1, 30, None]


def test_birthdate_guard(rows):
    df = rows([("2090-01-01",), ("1880-02-03",), (None,), ("x",)], "b string")
    assert one(df, F.year(D.guarded_birthdate(F.col("b"), date(2024, 1, 1)))) == [None, 1880, None, None]


def test_duration_and_blocks(rows):
    df = rows([(datetime(2024, 1, 1, 3, 59), datetime(2024, 1, 1, 4, 0, 30)), (None, datetime(2024, 1, 7))], "a timestamp, b timestamp")
    assert one(df, D.seconds_between(F.col("a"), F.col("b"))) == [90.0, None]
    assert one(df, D.four_hour_block(F.col("b"))) == [4, 0]
    assert one(df, D.monday_weekday(F.col("b"))) == [0, 6]


def test_missing_and_boolean_text(rows):
    df = rows([("None",), ("  ",), ("",), ("None of it",), ("t",), ("F",), (None,)], "s string")
    assert one(df, C.blank_to_null(F.col("s"))) == [None, None, None, "None of it", "t", "F", None]
    assert one(df, C.parse_boolean(F.col("s"))) == [None, None, None, None, True, False, None]


def test_row_counts_see_false_as_zero(rows):
    df = rows([(0, 0.0, False, "0", None, True)], "i int, d double, b boolean, s string, n int, y boolean")
    assert one(df, C.zero_count(df)) == [3]
    assert one(df, C.missing_count(df)) == [1]


def test_nan_never_beats_a_threshold(rows):
    df = C.nan_to_null(rows([(float("nan"),), (0.5,)], "p double"))
    assert one(df, R.decide(F.col("p"))) == [None, 1]


def test_flag_columns_and_recode(rows):
    df = rows([("YN" * 10 + "Y", "Y", "No")], "r string, a string, b string")
    flags = df.select(*C.flag_columns(F.col("r"), K.RACE_FLAGS)).first()
    assert list(flags) == [True, False] * 10 + [True] and len(flags) == 21
    assert C.recode_frame(df.select("a", "b")).first() == ("true", "No")


def test_categorical_filler(rows):
    df = rows([(None, None)], "s string, b boolean")
    assert C.categorical_text(df, ["s", "b"], {"s"}).first() == ("nan", "missing")


def test_trim_rules():
    names = ["campaign", "campaign1", "tstmp_create", "x_date", "col1_name", "email", "keep"]
    assert T.trimmed_names(names) == ["campaign", "tstmp_create", "x_date", "col1_name", "email"]
    assert T.trimmed_names(names, patterns=()) == []
    assert T.trimmed_names(names, exceptions=("email",)) == ["campaign", "tstmp_create", "x_date", "col1_name"]


def test_low_variety_counts_null(rows):
    df = rows([("a", "x", 1), ("b", None, 2), ("c", "x", 3)], "s string, t string, n int")
    assert T.keep_low_variety(df, 3).columns == ["t", "n"]
    assert T.keep_low_variety(df, 2).columns == ["n"]


def test_rules_and_blend(rows):
    df = rows([(1, 90.0, "a.b@gmail.com", False), (2, 89.0, "x@YOPMAIL.com", None), (3, None, "q@a.tk", True), (4, 91.0, None, False)],
              "app_id int, app_duration double, email string, y boolean")
    flagged = R.rule_flag(df, R.RuleOptions(period_list=K.PERIOD_DOMAIN_LIST))
    assert values(flagged, "app_id", "y_rule") == [(1, 1), (2, 1), (3, 1), (4, 0)]
    assert R.rule_flag(df, R.RuleOptions(override=False)).first().y_rule is None
    assert one(df, R.override_label(F.col("y"), F.col("app_duration"))) == [False, True, True, False]
    scored = rows([(0.3, 1), (0.31, 1), (0.3, 0), (0.1, None)], "p double, r int")
    assert one(scored, R.blend(F.col("p"), F.col("r"))) == [1.0, 0.31, 0.3, 0.1]
    assert one(scored, R.decide(F.col("p"), 0.3)) == [0, 1, 0, 0]
    assert one(scored, R.decide(F.col("p"), 0.3, strict=False)) == [1, 1, 1, 0]


def test_declared_kinds():
    assert S.declared("a int  # note\ncol1_name: str\n\nfg_08 bool") == {"a": "int", "col1_name": "str", "fg_08": "bool"}


def test_json_records(rows):
    df = rows([('{"a": 1, "b": "t"}',), ('[{"a": "2.0", "b": null}, {"a": "x", "c": 9}]',)], "j string")
    assert values(S.json_records(df, "j", {"a": "int", "b": "bool"}).fillna(-1, ["a"]), "a") == [(-1,), (1,), (2,)]


def test_md5_modulus(rows):
    import hashlib
    words = ["a", "bb", "", "ünï"]
    df = rows([(w,) for w in words], "s string")
    for n in (8, 7, 1000):
        assert one(df, H.md5_mod(F.col("s"), n)) == [int(hashlib.md5(w.encode()).hexdigest(), 16) % n for w in words]


def test_uniform_and_normal(spark):
    got = spark.range(20000).select(H.uniform(F.col("id"), 1).alias("u"), H.normal(F.col("id"), 1).alias("z")).agg(
        F.avg("u").alias("u"), F.avg("z").alias("m"), F.stddev("z").alias("s")).first()
    assert abs(got.u - 0.5) < 0.01 and abs(got.m) < 0.03 and abs(got.s - 1) < 0.03
