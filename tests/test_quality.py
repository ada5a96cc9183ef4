"""Rule semantics, gate, row verdicts and the quarantine split."""

import pytest
from pyspark.sql import functions as F

from wapspark.operators import quality as Q

SCHEMA = "transaction_id string, user_id int, amount double, currency string, status string"


def results(df, suite):
    return {r.rule_index: r for r in Q.run_suite(df, suite).collect()}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    res = results(df, Q.CRITICAL_SUITE)
    assert res[0].success is False  # row count ≥ 1
    assert all(r.success for i, r in res.items() if i != 0)


def test_mostly_limit_passes(spark):
    rows = [(f"id{i}", 1, 5.0, "USD", "COMPLETED") for i in range(99)] + [("x", 1, -1.0, "USD", "PENDING")]
    df = spark.createDataFrame(rows, SCHEMA)
    suite = Q.Suite("s", (Q.Rule("expect_column_values_to_be_between",
                                 {"column": "amount", "min_value": 0.01, "max_value": 100000,
                                  "mostly": 0.99}),))
    assert results(df, suite)[0].success is True  # exactly 99 %
    rows.append(("y", 1, -2.0, "USD", "PENDING"))
    assert results(spark.createDataFrame(rows, SCHEMA), suite)[0].success is False


def test_unique_counts_every_member_and_ignores_nulls(spark):
    df = spark.createDataFrame([("a", 1, 1.0, "USD", "COMPLETED"), ("a", 2, 1.0, "USD", "COMPLETED"),
                                ("b", 3, 1.0, "USD", "COMPLETED"), (None, 4, 1.0, "USD", "COMPLETED"),
                                (None, 5, 1.0, "USD", "COMPLETED")], SCHEMA)
    suite = Q.Suite("s", (Q.Rule("expect_column_values_to_be_unique", {"column": "transaction_id"}),))
    r = results(df, suite)[0]
    assert r.unexpected_count == 2 and r.nonnull_count == 3 and r.success is False


def test_column_rules_ignore_nulls(spark):
    df = spark.createDataFrame([("a", None, None, None, None)], SCHEMA)
    suite = Q.Suite("s", (
        Q.Rule("expect_column_values_to_be_in_set", {"column": "currency", "value_set": ["USD"]}),
        Q.Rule("expect_column_values_to_match_regex", {"column": "status", "regex": "^X$"}),
        Q.Rule("expect_column_values_to_not_be_null", {"column": "user_id"}),
    ))
    res = results(df, suite)
    assert res[0].success and res[1].success and not res[2].success


def test_gate_blocks_on_blocking_suite(spark):
    df = spark.createDataFrame([("a", None, 1.0, "USD", "COMPLETED")], SCHEMA)
    with pytest.raises(Q.QualityGateError):
        Q.gate(Q.run_suite(df, Q.CRITICAL_SUITE))
    summary = Q.gate(Q.run_suite(df, Q.WARNING_SUITE))
    assert summary["blocking_triggered"] is False


def test_split_conserves_rows(spark):
    rows = [("a", 1, 1.0, "USD", "COMPLETED"), ("a", 1, 1.0, "USD", "COMPLETED"),
            ("b", None, 2.0, "EUR", "PENDING"), ("c", 3, 3.0, "JPY", "FAILED"),
            ("d", 4, 4.0, "GBP", "COMPLETED")]
    df = spark.createDataFrame(rows, SCHEMA)
    clean, quarantine = Q.split_clean_quarantine(df, Q.CRITICAL_SUITE)
    assert clean.count() + quarantine.count() == len(rows)
    assert sorted(r.transaction_id for r in clean.collect()) == ["d"]
    errs = {r.transaction_id: r.gx_validation_errors for r in quarantine.collect()}
    assert errs["c"] == ["expect_column_values_to_be_in_set:currency"]


def test_validation_metrics_row(spark):
    df = spark.createDataFrame([("a", None, -1.0, "USD", "COMPLETED"), ("b", 1, 2.0, "USD", "COMPLETED")],
                               SCHEMA)
    r = Q.validation_metrics(df, "raw_transactions").first()
    assert r.total_records == 2 and r.failed_records == 2 and r.success_rate == 0.0
    assert r.critical_failures == [Q.NEGATIVE_LABEL, Q.NULL_USER_LABEL] and r.blocking_triggered
    empty = Q.validation_metrics(spark.createDataFrame([], SCHEMA), "t").first()
    assert empty.success_rate == 100.0 and empty.critical_failures == []


def test_model_tests(spark):
    df = spark.createDataFrame([("a", 1, 1.0, "USD", "COMPLETED"), ("a", None, 0.0, "XXX", None)], SCHEMA)
    tests = (Q.ModelTest("transaction_id", "unique"), Q.ModelTest("user_id", "not_null"),
             Q.ModelTest("currency", "accepted_values", {"values": ["USD"]}),
             Q.ModelTest("amount", "accepted_range", {"min_value": 0, "inclusive": False}))
    out = {r.test_index: r.failures for r in Q.run_model_tests(df, "m", tests).collect()}
    assert out == {0: 1, 1: 1, 2: 1, 3: 1}


def test_suite_file_round_trip(spark, tmp_path):
    import json
    doc = {"expectation_suite_name": "x", "meta": {"blocking": True},
           "expectations": [{"expectation_type": "expect_column_values_to_not_be_null",
                             "kwargs": {"column": "user_id"}, "meta": {"severity": "CRITICAL"}}]}
    p = tmp_path / "s.json"
    p.write_text(json.dumps(doc))
    s = Q.load_suite(str(p))
    assert s.blocking and s.rules[0].severity == "CRITICAL" and s.rules[0].column == "user_id"


def test_custom_rule(spark):
    Q.register_rule("expect_even", lambda r: F.col(r.column) % 2 != 0)
    df = spark.createDataFrame([(1,), (2,)], "x int")
    r = Q.run_suite(df, Q.Suite("s", (Q.Rule("expect_even", {"column": "x"}),))).first()
    assert r.unexpected_count == 1


def test_row_verdicts_with_hot_duplicate(spark):
    from wapspark.operators.joins import hot_keys
    rows = [("hot", i, 1.0, "USD", "COMPLETED") for i in range(50)]
    rows += [(f"id{i}", i, 1.0, "USD", "COMPLETED") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert hot_keys(df, "transaction_id") == ["hot"]
    suite = Q.Suite("s", (Q.Rule("expect_column_values_to_be_unique", {"column": "transaction_id"}),))
    out = Q.annotate_rows(df, suite).collect()
    assert len(out) == 90
    failed = [r for r in out if r.gx_validation_status == "FAILED"]
    assert len(failed) == 50 and all(r.transaction_id == "hot" for r in failed)


def test_check_lists(spark):
    from wapspark.operators import quality as Q
    df = spark.createDataFrame([("deletion", "pending"), ("erase", "done"), (None, None)],
                               "request_type string, status string")
    got = [r.reject_reasons for r in Q.check_violations(df, "deletion_requests").collect()]
    assert got == [[], ["bad_request_type", "bad_status"], []]


def test_identical_copies_of_a_key_are_refused_but_one(spark):
    import datetime as dt
    from wapspark.operators import quality as Q
    t = dt.datetime(2024, 1, 1)
    rows = [("k", "COMPLETED", "a", "USD", "1.00", t)] * 3 + [("x", "bad", "a", "USD", "1.00", t)] + [
        ("x", "PENDING", "a", "USD", "1e12", t), ("x", "PENDING", "a", "USD", "2.00", t), (None, None, "a", "USD", "1", t)]
    df = spark.createDataFrame(rows, "transaction_id string, status string, product_category string, "
                                     "currency string, amount string, ingested_at timestamp_ntz")
    got = sorted((str(r.transaction_id), r.reject_reasons) for r in Q.constraint_violations(df).collect())
    assert got == [("None", ["null_key"]), ("k", []), ("k", ["duplicate_key"]), ("k", ["duplicate_key"]),
                   ("x", []), ("x", ["amount_overflow"]), ("x", ["bad_status"])]


def test_only_rows_that_may_be_copies_are_joined(spark, monkeypatch):
    from wapspark.operators import quality
    joined = []
    join = quality.skew_aware_join

    def counted(big, *args, **kwargs):
        joined.append(big.count())
        return join(big, *args, **kwargs)
    monkeypatch.setattr(quality, "skew_aware_join", counted)
    suite = quality.Suite("s", (quality.Rule("expect_column_values_to_be_unique", {"column": "k"}),))
    rows = [(str(i),) for i in range(500)] + [("7",), ("7",), ("9",), (None,), (None,)]
    out = quality.annotate_rows(spark.createDataFrame(rows, "k string"), suite).collect()
    failed = sorted(r["k"] for r in out if r["gx_validation_status"] == "FAILED")
    assert len(out) == 505 and failed == ["7", "7", "7", "9", "9"] and joined == [5]


def test_constraints_compare_only_repeated_keys(spark):
    from decimal import Decimal
    schema = ("transaction_id string, user_id int, product_category string, amount decimal(10,2), "
              "currency string, status string, ingested_at timestamp_ntz")
    rows = [(k, u, "c", Decimal("1.00"), "USD", "COMPLETED", None) for k, u in
            [("a", 1), ("b", 2), ("b", 1), ("b", 1), ("c", 3), (None, 4), ("d", 5), ("d", 5)]]
    df = spark.createDataFrame(rows, schema)
    flagged = Q.constraint_violations(df, df.filter("user_id = 3"))
    # One row of content is compared by no aggregate over all rows.
    assert "Aggregate" not in flagged._jdf.queryExecution().executedPlan().toString()
    got = sorted((str(r.transaction_id), r.user_id, tuple(r.reject_reasons)) for r in flagged.collect())
    again = ("duplicate_key",)
    assert got == [("None", 4, ("null_key",)), ("a", 1, ()), ("b", 1, ()), ("b", 1, again), ("b", 2, again),
                   ("c", 3, again), ("d", 5, ()), ("d", 5, again)]
