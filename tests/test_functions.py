"""Literal cases for the scalar and privacy Column functions (FIXTURES §3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wapspark.functions import privacy as P
from wapspark.functions import scalar as S
from wapspark.plans.staging import stg_raw_transactions


def one(spark, col, value, schema):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_pseudonym_golden(spark):
    assert one(spark, P.pseudonymize("x"), 42, "x int") == "U_960523de2a2630bf"
    assert one(spark, P.pseudonymize("x"), None, "x int") is None
    assert one(spark, P.pseudonymize("x", ""), 42, "x int") == "U_960523de2a2630bf"


def test_pseudonym_sql_function(spark):
    P.register_sql_functions(spark)
    assert spark.sql("SELECT pseudonymize_user(42) AS p").first()["p"] == "U_960523de2a2630bf"


@pytest.mark.parametrize("value,strict,expected", [
    (None, True, None), ("a@b.c", True, "***"), ("ana@x.org", True, "an***@x.org"),
    ("abcdefgh", True, "ab***"), ("abcdefgh", False, "ab***abcdefgh"),
])
def test_mask_email(spark, value, strict, expected):
    assert one(spark, P.mask_email("x", strict), value, "x string") == expected


@pytest.mark.parametrize("value,expected", [("12345678", "****"), ("123456789", "12****6789"),
                                            (None, None)])
def test_mask_id(spark, value, expected):
    assert one(spark, P.mask_id("x"), value, "x string") == expected


def test_mask_name(spark):
    assert one(spark, P.mask_name("x"), "Ana", "x string") == "A***"
    assert one(spark, P.mask_name("x"), None, "x string") is None


@pytest.mark.parametrize("value,expected", [("123456", "**3456"), ("12", "12"), (None, None)])
def test_rule_masking(spark, value, expected):
    df = spark.createDataFrame([(value,)], "transaction_id string")
    rules = {"fields": {"transaction_id": {"type": "mask_transaction_id",
                                           "params": {"visible_digits": 4, "mask_char": "*"}}}}
    assert P.apply_masking(df, rules).first()[0] == expected


def test_rule_masking_unknown_type(spark):
    df = spark.createDataFrame([("123456",)], "transaction_id string")
    rules = {"fields": {"transaction_id": {"type": "mask_transacion_id", "params": {}}},
             "default_action": "keep_original"}
    with pytest.raises(ValueError):
        P.apply_masking(df, rules)
    assert P.apply_masking(df, rules, on_unknown="keep").first()[0] == "123456"
    # fields absent from the frame are skipped
    assert P.apply_masking(df, {"fields": {"nope": {"type": "mask_id"}}}).first()[0] == "123456"


def test_md5_tags(spark):
    assert one(spark, P.md5_user_tag("x"), None, "x int") == "user_"
    assert one(spark, P.md5_short_tag("x"), 1, "x int").startswith("U")


def test_tiers_and_dow(spark):
    rows = [("t1", 1, "cat", Decimal("999.996"), "usd", dt.datetime(2024, 1, 7, 10), "completed",
             dt.datetime(2024, 1, 8), Decimal("0.900")),
            ("t2", 2, "cat", Decimal("50.000"), "EUR", dt.datetime(2024, 1, 8, 10), "PENDING",
             dt.datetime(2024, 1, 9), Decimal("0.895")),
            ("t3", 3, "cat", None, "GBP", dt.datetime(2024, 1, 9, 10), "FAILED",
             dt.datetime(2024, 1, 9), None)]
    df = spark.createDataFrame(rows, "transaction_id string, user_id int, product_category string, "
                                     "amount decimal(12,3), currency string, "
                                     "transaction_date timestamp_ntz, status string, "
                                     "processed_at timestamp_ntz, data_quality_score decimal(4,3)")
    out = {r.transaction_id: r for r in stg_raw_transactions(df, as_of=dt.datetime(2024, 2, 1)).collect()}
    assert out["t1"].data_quality_tier == "high"
    assert out["t2"].data_quality_tier == "medium"  # 0.895 unrounded, though it rounds to 0.90
    assert out["t3"].data_quality_tier == "low"
    assert out["t1"].amount == Decimal("1000.00")
    assert out["t1"].transaction_value_tier == "medium_value"  # tier on the unrounded amount
    assert out["t1"].transaction_day_of_week == 0 and out["t1"].is_weekend is True
    assert out["t2"].transaction_day_of_week == 1 and out["t2"].is_weekend is False
    assert out["t1"].status == "COMPLETED" and out["t1"].currency == "usd"[:3]
    assert out["t3"].is_anomaly is False


def test_composite_and_deviation(spark):
    df = spark.createDataFrame([(Decimal("0.80"), 11, Decimal("10.00"), 5.0),
                                (None, 3, Decimal("1.00"), 5.0),
                                (Decimal("0.50"), None, Decimal("1.00"), None)],
                               "dq decimal(3,2), n long, amount decimal(10,2), avg double")
    r = df.select(S.composite_score("dq", "n", "amount", "avg").alias("c"),
                  S.deviation_pct("amount", "avg").alias("d")).collect()
    assert [float(x.c) if x.c is not None else None for x in r] == [0.92, None, 0.4]
    assert r[0].d == 100.0 and r[2].d is None


def test_labels(spark):
    df = spark.range(0, 8).withColumnRenamed("id", "dow")
    names = [r[0] for r in df.select(S.day_name("dow")).collect()]
    assert names[:7] == S.DAY_NAMES and names[7] is None
    months = spark.range(1, 13).select(S.quarter_label("id"), S.semester_label("id")).collect()
    assert [m[0] for m in months] == ["Q1"] * 3 + ["Q2"] * 3 + ["Q3"] * 3 + ["Q4"] * 3
    assert [m[1] for m in months] == ["H1"] * 6 + ["H2"] * 6


def test_pg_concat_and_varchar(spark):
    df = spark.createDataFrame([("USDX", None)], "a string, b string")
    r = df.select(S.varchar("a", 3).alias("v"), S.pg_concat(F.lit("x"), "b").alias("c")).first()
    assert r.v == "USD" and r.c == "x"


def test_uuid_if_falsy(spark):
    df = spark.createDataFrame([("abc",), ("",), ("0",), (None,)], "id string")
    out = [r[0] for r in df.select(S.uuid_if_falsy("id")).collect()]
    assert out[0] == "abc" and all(len(x) == 36 for x in out[1:])


def test_ms_to_kmh(spark):
    assert one(spark, S.ms_to_kmh("x"), 10.0, "x double") == Decimal("36.00")
