"""Data-quality rules, suites, gates and row verdicts (Q1–Q15).

Semantics follow the public expectation conventions: column rules ignore
NULLs (except not-null); ``mostly = m`` passes when the share of matching
non-NULL values is ≥ m (exactly at the limit passes); ``unique`` counts every
member of a duplicated group; a table row-count rule checks the total.

Execution: every row-level rule of a suite is one ``count_if`` in a single
aggregate (one scan, map-side combined). Each ``unique`` column is one
``groupBy(column).count()`` (pre-aggregated before the shuffle, so a
duplicated hot value cannot overload a task). The result is a small frame —
one row per rule — the only thing a gate ever collects.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wapspark.operators.joins import bounded_broadcast, hot_keys, materialize, skew_aware_join, stored_with
from wapspark.session import ensure_checkpoint_dir, pinned


@dataclass(frozen=True)
class Rule:
    expectation_type: str
    kwargs: dict = field(default_factory=dict)
    severity: str | None = None
    description: str | None = None

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")


@dataclass(frozen=True)
class Suite:
    name: str
    rules: tuple[Rule, ...]
    blocking: bool = False


def suite_from_dict(doc: dict) -> Suite:
    rules = tuple(
        Rule(e["expectation_type"], dict(e.get("kwargs") or {}),
             (e.get("meta") or {}).get("severity"), (e.get("meta") or {}).get("description"))
        for e in doc.get("expectations", []))
    return Suite(doc.get("expectation_suite_name", "suite"), rules,
                 bool((doc.get("meta") or {}).get("blocking", False)))


def load_suite(path: str) -> Suite:
    """Read a suite JSON document (small driver-side config file)."""
    with open(path, encoding="utf-8") as fh:
        return suite_from_dict(json.load(fh))


# ---------------------------------------------------------------------------
# The reference's rule suites, restated as configuration.
VALID_CURRENCIES = ["USD", "EUR", "GBP"]
VALID_STATUSES = ["COMPLETED", "PENDING", "FAILED"]
UUID_REGEX = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"

CRITICAL_SUITE = Suite("transactions_critical_suite", (
    Rule("expect_table_row_count_to_be_between", {"min_value": 1, "strict_max": False}, "CRITICAL"),
    Rule("expect_column_values_to_not_be_null", {"column": "user_id"}, "CRITICAL"),
    Rule("expect_column_values_to_not_be_null", {"column": "transaction_id"}, "CRITICAL"),
    Rule("expect_column_values_to_be_unique", {"column": "transaction_id"}, "CRITICAL"),
    Rule("expect_column_values_to_be_in_set", {"column": "currency", "value_set": VALID_CURRENCIES}, "CRITICAL"),
    Rule("expect_column_values_to_be_in_set", {"column": "status", "value_set": VALID_STATUSES}, "CRITICAL"),
), blocking=True)

QUALITY_SUITE = Suite("transactions_quality_suite", (
    Rule("expect_table_row_count_to_be_between", {"min_value": 1, "strict_max": False}),
    Rule("expect_column_values_to_not_be_null", {"column": "user_id"}),
    Rule("expect_column_values_to_not_be_null", {"column": "transaction_id"}),
    Rule("expect_column_values_to_be_unique", {"column": "transaction_id"}),
    Rule("expect_column_values_to_be_between",
         {"column": "amount", "min_value": 0.01, "max_value": 100000, "mostly": 0.99}),
    Rule("expect_column_values_to_be_in_set",
         {"column": "currency", "value_set": VALID_CURRENCIES, "mostly": 1.0}),
    Rule("expect_column_values_to_be_in_set", {"column": "status", "value_set": VALID_STATUSES}),
    Rule("expect_column_values_to_match_regex", {"column": "transaction_id", "regex": UUID_REGEX}),
))

WARNING_SUITE = Suite("transactions_warning_suite", (
    Rule("expect_column_values_to_be_between",
         {"column": "amount", "min_value": 0.01, "max_value": 100000, "mostly": 0.99}, "WARNING"),
    Rule("expect_column_values_to_match_regex",
         {"column": "transaction_id", "regex": UUID_REGEX}, "WARNING"),
), blocking=False)

BASIC_SUITE = Suite("transactions_suite", (
    Rule("expect_column_values_to_not_be_null", {"column": "transaction_id"}),
    Rule("expect_column_values_to_not_be_null", {"column": "amount"}),
    Rule("expect_column_values_to_be_between", {"column": "amount", "min_value": 0}),
))

# The script gate's six rules (blocking: any failure stops the pipeline).
SCRIPT_SUITE = Suite("script_quality_gate", (
    Rule("expect_column_values_to_not_be_null", {"column": "transaction_id"}),
    Rule("expect_column_values_to_not_be_null", {"column": "user_id"}),
    Rule("expect_column_values_to_not_be_null", {"column": "amount"}),
    Rule("expect_column_values_to_be_in_set", {"column": "status", "value_set": VALID_STATUSES}),
    Rule("expect_column_values_to_be_between", {"column": "amount", "min_value": 0, "max_value": 100000}),
    Rule("expect_column_values_to_be_unique", {"column": "transaction_id"}),
), blocking=True)

SUITES = {s.name: s for s in (CRITICAL_SUITE, QUALITY_SUITE, WARNING_SUITE, BASIC_SUITE, SCRIPT_SUITE)}
# ---------------------------------------------------------------------------


def _between_ok(c: Column, kw: dict) -> Column:
    ok = F.lit(True)
    lo, hi = kw.get("min_value"), kw.get("max_value")
    if lo is not None:
        ok = ok & ((c > F.lit(lo)) if kw.get("strict_min") else (c >= F.lit(lo)))
    if hi is not None:
        ok = ok & ((c < F.lit(hi)) if kw.get("strict_max") else (c <= F.lit(hi)))
    return ok


def row_failure(rule: Rule) -> Column | None:
    """Boolean Column: this row violates the rule (NULL-skipping where the
    rule ignores NULLs). ``None`` for table-level / unique rules."""
    t, kw = rule.expectation_type, rule.kwargs
    c = F.col(kw["column"]) if "column" in kw else None
    if t == "expect_column_values_to_not_be_null":
        return c.isNull()
    if t == "expect_column_values_to_be_null":
        return c.isNotNull()
    if t == "expect_column_values_to_be_between":
        return c.isNotNull() & ~_between_ok(c, kw)
    if t == "expect_column_values_to_be_in_set":
        return c.isNotNull() & ~c.isin(list(kw["value_set"]))
    if t == "expect_column_values_to_not_be_in_set":
        return c.isNotNull() & c.isin(list(kw["value_set"]))
    if t == "expect_column_values_to_match_regex":
        return c.isNotNull() & ~c.cast("string").rlike(kw["regex"])
    if t == "expect_column_values_to_not_match_regex":
        return c.isNotNull() & c.cast("string").rlike(kw["regex"])
    if t == "expect_column_value_lengths_to_be_between":
        return c.isNotNull() & ~_between_ok(F.length(c), kw)
    if t in ("expect_table_row_count_to_be_between", "expect_column_values_to_be_unique"):
        return None
    if t in _CUSTOM:
        return _CUSTOM[t](rule)
    raise ValueError(f"unsupported expectation {t}")


_CUSTOM: dict = {}


def register_rule(name: str, fn) -> None:
    """Extension point: ``fn(rule) -> Column`` flagging failing rows."""
    _CUSTOM[name] = fn


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """Evaluate a suite; one result row per rule:
    suite, rule_index, expectation_type, column, severity, blocking,
    element_count, nonnull_count, unexpected_count, observed_value, success."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, r in enumerate(suite.rules):
        fail = row_failure(r)
        if fail is not None:
            aggs.append(F.count_if(fail).alias(f"_u{i}"))
            aggs.append(F.count(F.col(r.column)).alias(f"_nn{i}"))
    main = df.agg(*aggs)

    # Unpivot the single aggregate row into one row per rule.
    structs = []
    for i, r in enumerate(suite.rules):
        t = r.expectation_type
        if t == "expect_column_values_to_be_unique":
            continue
        if t == "expect_table_row_count_to_be_between":
            nn, bad, obs = F.col("_total"), F.lit(0).cast("long"), F.col("_total")
        else:
            nn, bad, obs = F.col(f"_nn{i}"), F.col(f"_u{i}"), F.lit(None).cast("long")
        structs.append(F.struct(F.lit(i).alias("rule_index"), F.col("_total").alias("element_count"),
                                nn.alias("nonnull_count"), bad.alias("unexpected_count"),
                                obs.alias("observed_value")))
    parts = [main.select(F.inline(F.array(*structs)))] if structs else []
    for i, r in enumerate(suite.rules):
        if r.expectation_type == "expect_column_values_to_be_unique":
            parts.append(_unique_counts(df, r.column).select(
                F.lit(i).alias("rule_index"), "element_count", "nonnull_count",
                "unexpected_count", F.lit(None).cast("long").alias("observed_value")))
    counts = reduce(DataFrame.unionByName, parts)

    meta = df.sparkSession.createDataFrame(
        [(i, r.expectation_type, r.column, r.severity, r.description,
          _opt_float(r.kwargs.get("mostly")), _opt_float(r.kwargs.get("min_value")),
          _opt_float(r.kwargs.get("max_value")))
         for i, r in enumerate(suite.rules)],
        "rule_index int, expectation_type string, column string, severity string, "
        "description string, mostly double, min_value double, max_value double")
    # ``meta`` has one row per rule: a fixed, tiny side.
    res = counts.join(F.broadcast(meta), "rule_index")
    return res.select(
        F.lit(suite.name).alias("suite"), F.col("rule_index").cast("long").alias("rule_index"),
        "expectation_type", "column", "severity", F.lit(suite.blocking).alias("blocking"),
        F.col("element_count").cast("long").alias("element_count"),
        F.col("nonnull_count").cast("long").alias("nonnull_count"),
        F.col("unexpected_count").cast("long").alias("unexpected_count"),
        _success().alias("success"))


def _opt_float(v):
    return None if v is None else float(v)


def _success() -> Column:
    t = F.col("expectation_type")
    total, nn, bad = F.col("element_count"), F.col("nonnull_count"), F.col("unexpected_count")
    mostly = F.col("mostly")
    rowcount_ok = (F.when(F.col("min_value").isNull(), True).otherwise(total >= F.col("min_value"))
                   & F.when(F.col("max_value").isNull(), True).otherwise(total <= F.col("max_value")))
    # Null rules measure over all rows; other column rules over non-NULL ones.
    base = F.when(t.isin("expect_column_values_to_not_be_null", "expect_column_values_to_be_null"),
                  total).otherwise(nn)
    # Exact decimal comparison: matching ≥ mostly · base (the limit passes).
    share_ok = ((base - bad).cast("decimal(38,6)")
                >= mostly.cast("decimal(10,6)") * base.cast("decimal(28,0)"))
    col_ok = F.when(mostly.isNull(), bad == 0).otherwise((base == 0) | share_ok)
    return F.when(t == "expect_table_row_count_to_be_between", rowcount_ok).otherwise(col_ok)


def _unique_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: element_count, nonnull_count, unexpected_count (= rows whose
    non-NULL value occurs more than once)."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return per_value.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("element_count"),
        F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col("_n"))), F.lit(0)).alias("nonnull_count"),
        F.coalesce(F.sum(F.when(F.col(column).isNotNull() & (F.col("_n") > 1), F.col("_n"))),
                   F.lit(0)).alias("unexpected_count"))


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame, raise_on_block: bool = True) -> dict:
    """Q8: collect the small per-rule result; a failing rule of a blocking
    suite (or a CRITICAL rule) blocks. Returns a summary dict."""
    rows = results.collect()  # one row per rule: bounded by the suite size
    failed = [r for r in rows if not r["success"]]
    blocking = [r for r in failed if r["blocking"] or (r["severity"] or "").upper() == "CRITICAL"]
    summary = {
        "success": not failed,
        "blocking_triggered": bool(blocking),
        "critical_failures": [f"{r['expectation_type']}({r['column']})" for r in blocking],
        "warning_messages": [f"{r['expectation_type']}({r['column']})" for r in failed if r not in blocking],
        "failed_rules": len(failed),
        "rules": len(rows),
    }
    if blocking and raise_on_block:
        raise QualityGateError(f"quality gate failed: {summary['critical_failures']}")
    return summary


# Labels the validation script records for its two checks.
NEGATIVE_LABEL, NULL_USER_LABEL = "amount negativos", "user_id nulos"


def validation_metrics(df: DataFrame, table_name: str, as_of: Column | None = None,
                       suite_name: str | None = None,
                       warnings: list[str] | None = None) -> DataFrame:
    """Q9: one log row — total, failed (negative amounts + NULL users; a row
    failing both counts twice), success rate (100 when empty), failure labels,
    blocking flag, the suite's name and the warnings of its run. Ready to append
    to the validation log (A9)."""
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(F.col("amount") < 0).alias("neg"),
                 F.count_if(F.col("user_id").isNull()).alias("nulls"))
    failed = F.col("neg") + F.col("nulls")
    return agg.select(
        (as_of if as_of is not None else F.current_timestamp().cast("timestamp_ntz"))
        .alias("validation_timestamp"),
        F.lit(table_name).alias("table_name"),
        F.lit(suite_name).cast("string").alias("expectation_suite_name"),
        F.col("total").alias("total_records"),
        failed.alias("failed_records"),
        F.when(F.col("total") > 0,
               F.round((F.col("total") - failed) / F.col("total") * 100, 2))
         .otherwise(F.lit(100.0)).alias("success_rate"),
        F.array_compact(F.array(F.when(F.col("neg") > 0, F.lit(NEGATIVE_LABEL)),
                                F.when(F.col("nulls") > 0, F.lit(NULL_USER_LABEL))))
         .alias("critical_failures"),
        F.array(*[F.lit(w) for w in warnings or []]).cast("array<string>").alias("warning_messages"),
        (failed > 0).alias("blocking_triggered"))


def quality_check(df: DataFrame) -> DataFrame:
    """Negative and NULL-user counts in one pass."""
    return df.agg(F.count_if(F.col("amount") < 0).alias("negativos"),
                  F.count_if(F.col("user_id").isNull()).alias("nulos"))


def annotate_rows(df: DataFrame, suite: Suite) -> DataFrame:
    """Q11: per-row verdict columns ``gx_validation_status`` (PASSED / FAILED)
    and ``gx_validation_errors`` (array of failed rule labels). Unique rules
    mark every member of a duplicated group: hashes of the values are counted
    (map-side combined), the rows with a repeated one are counted by value, and
    these rows join the repeated values; hot values are known from the same counts and salted
    (``joins.skew_aware_join``). With such a rule the rows are read twice, so they
    are written to the shared checkpoint folder first: give the columns that are
    needed."""
    ensure_checkpoint_dir(df.sparkSession)
    if any(r.expectation_type == "expect_column_values_to_be_unique" for r in suite.rules):
        df = materialize(df, "annotated")
    out = df
    labels = []
    for i, r in enumerate(suite.rules):
        label = f"{r.expectation_type}:{r.column}" if r.column else r.expectation_type
        if r.expectation_type == "expect_column_values_to_be_unique":
            flag = f"_dup{i}"
            seen = Observation(flag)
            # Hashes that come more than once: only rows with such a one can be
            # copies; the others need no shuffle.
            hashed = F.xxhash64(r.column)
            twice = bounded_broadcast(
                df.filter(F.col(r.column).isNotNull())
                  .groupBy(hashed.alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
                  .observe(seen, F.sum("_n").alias("total"))
                  .filter(F.col("_n") > 1).select("_h", F.lit(True).alias("_may")))
            maybe = df.withColumn("_h", hashed).join(twice, "_h", "left_semi")
            dups = (maybe.filter(F.col(r.column).isNotNull())
                         .groupBy(r.column).agg(F.count(F.lit(1)).alias("_n"))
                         .filter(F.col("_n") > 1).checkpoint(eager=True))
            hot = hot_keys(df, r.column, counts=dups, total=seen.get["total"])
            small = dups.select(r.column, F.lit(True).alias(flag))
            own = out.columns
            marked = out.withColumn("_h", F.when(F.col(r.column).isNotNull(), hashed)).join(twice, "_h", "left")
            alone = marked.filter("_may is null").select(*own, F.lit(None).cast("boolean").alias(flag))
            rest = skew_aware_join(marked.filter("_may").select(*own), small, r.column, "left", hot=hot)
            out = alone.unionByName(rest.select(*own, flag))
            labels.append(F.when(F.coalesce(F.col(flag), F.lit(False)), F.lit(label)))
        else:
            fail = row_failure(r)
            if fail is not None:
                labels.append(F.when(F.coalesce(fail, F.lit(False)), F.lit(label)))
    errs = F.array_compact(F.array(*labels)) if labels else F.array().cast("array<string>")
    out = out.withColumn("gx_validation_errors", errs)
    out = out.withColumn("gx_validation_status",
                         F.when(F.size("gx_validation_errors") > 0, "FAILED").otherwise("PASSED"))
    return out.drop(*[c for c in out.columns if c.startswith("_dup")])


def split_clean_quarantine(df: DataFrame, suite: Suite) -> tuple[DataFrame, DataFrame]:
    """Annotate once (in the shared checkpoint folder), then two filters: rows
    that pass every rule, and the quarantined rest.
    clean ∪ quarantine = input."""
    annotated = annotate_rows(df, suite).checkpoint(eager=True)
    return (annotated.filter(F.col("gx_validation_status") == "PASSED"),
            annotated.filter(F.col("gx_validation_status") == "FAILED"))


# --- model tests (Q12–Q14): failing rows, pass when empty ---------------

def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """One row per duplicated non-NULL value with its count."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


@dataclass(frozen=True)
class ModelTest:
    column: str
    test: str  # not_null | unique | accepted_values | accepted_range
    args: dict = field(default_factory=dict)


# The model tests declared for the staging, enriched, fact and
# user-dimension models.
STG_TESTS = (
    ModelTest("transaction_id", "unique"), ModelTest("transaction_id", "not_null"),
    ModelTest("user_id", "not_null"), ModelTest("product_category", "not_null"),
    ModelTest("amount", "not_null"),
    ModelTest("amount", "accepted_range", {"min_value": 0, "inclusive": False}),
    ModelTest("currency", "accepted_values", {"values": ["USD", "EUR", "GBP"]}),
    ModelTest("status", "accepted_values", {"values": ["COMPLETED", "PENDING", "FAILED"]}),
    ModelTest("data_quality_score", "accepted_range", {"min_value": 0, "max_value": 1}),
    ModelTest("data_quality_tier", "accepted_values", {"values": ["high", "medium", "low"]}),
    ModelTest("transaction_value_tier", "accepted_values",
              {"values": ["high_value", "medium_value", "low_value"]}),
)
ENRICHED_TESTS = (
    ModelTest("transaction_id", "unique"), ModelTest("transaction_id", "not_null"),
    ModelTest("composite_reliability_score", "accepted_range", {"min_value": 0, "max_value": 1}),
)
FCT_TESTS = (
    ModelTest("transaction_id", "unique"), ModelTest("transaction_id", "not_null"),
    ModelTest("amount", "not_null"), ModelTest("amount", "accepted_range", {"min_value": 0}),
    ModelTest("data_quality_score", "accepted_range", {"min_value": 0.7}),
    ModelTest("is_anomaly", "accepted_values", {"values": [True, False]}),
)
DIM_USERS_TESTS = (
    ModelTest("user_id", "unique"), ModelTest("user_id", "not_null"),
    ModelTest("lifetime_value", "not_null"),
    ModelTest("is_active_user", "accepted_values", {"values": [True, False]}),
    ModelTest("is_churned_user", "accepted_values", {"values": [True, False]}),
    ModelTest("rfm_score", "accepted_range", {"min_value": 1, "max_value": 5}),
)


def run_model_tests(df: DataFrame, model: str, tests) -> DataFrame:
    """Q12–Q14 summary: one row per test with its failure count (failing rows;
    for ``unique``, duplicated values). Row tests share one aggregate.
    ``unique`` needs a pass of its own, so the tested columns are then written
    to the shared checkpoint folder first and the model is evaluated once."""
    df = df.select(*dict.fromkeys(t.column for t in tests))
    if len({t.test == "unique" for t in tests}) > 1:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    row_aggs, parts = [], []
    for i, t in enumerate(tests):
        c = F.col(t.column)
        if t.test == "not_null":
            row_aggs.append(F.count_if(c.isNull()).alias(f"_f{i}"))
        elif t.test == "accepted_values":
            row_aggs.append(F.count_if(c.isNotNull() & ~c.isin(list(t.args["values"]))).alias(f"_f{i}"))
        elif t.test == "accepted_range":
            a = t.args
            ok = F.lit(True)
            inc = a.get("inclusive", True)
            if a.get("min_value") is not None:
                ok = ok & ((c >= F.lit(a["min_value"])) if inc else (c > F.lit(a["min_value"])))
            if a.get("max_value") is not None:
                ok = ok & ((c <= F.lit(a["max_value"])) if inc else (c < F.lit(a["max_value"])))
            row_aggs.append(F.count_if(~ok).alias(f"_f{i}"))
    if row_aggs:
        main = df.agg(*row_aggs)
        structs = [F.struct(F.lit(i).alias("test_index"), F.col(f"_f{i}").alias("failures"))
                   for i, t in enumerate(tests) if t.test != "unique"]
        parts.append(main.select(F.inline(F.array(*structs))))
    for i, t in enumerate(tests):
        if t.test == "unique":
            parts.append(unique_failures(df, t.column).agg(F.count(F.lit(1)).alias("failures"))
                         .select(F.lit(i).alias("test_index"), "failures"))
    counts = reduce(DataFrame.unionByName, parts)
    meta = df.sparkSession.createDataFrame(
        [(i, t.column, t.test) for i, t in enumerate(tests)],
        "test_index int, column_name string, test_name string")
    return (counts.join(F.broadcast(meta), "test_index")
                  .select(F.lit(model).alias("model"), F.col("test_index").cast("long"),
                          "column_name", "test_name", F.col("failures").cast("long"),
                          (F.col("failures") == 0).alias("passed")))


# --- table constraints (Q15): the tables' DDL as rules --------------------

# CHECK lists of the other tables (fixed values); a NULL passes a CHECK.
TABLE_CHECKS = {
    "freshness_log": {"status": ["FRESH", "STALE", "MISSING"]},
    "data_lineage": {"lineage_type": ["node", "edge"]},
    "pii_catalog": {"pii_sensitivity": ["low", "medium", "high", "critical"]},
    "deletion_requests": {"request_type": ["deletion", "access", "rectification"],
                          "status": ["pending", "processing", "completed", "rejected"]},
}


def check_violations(df: DataFrame, table: str) -> DataFrame:
    """``reject_reasons`` by the CHECK lists of one of ``TABLE_CHECKS``."""
    reasons = [F.when(F.col(c).isNotNull() & ~F.col(c).isin(allowed), F.lit(f"bad_{c}"))
               for c, allowed in TABLE_CHECKS[table].items()]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*reasons)))


def row_reasons():
    """Reasons (array) why the quarantine table's constraints refuse a row for
    its own values, other rows apart."""
    key = F.col("transaction_id")
    # Tested on the value as it came; a column that is NUMERIC(10,2) already
    # can't overflow.
    amount = F.col("amount")
    return F.array_compact(F.array(
        F.when(key.isNull(), F.lit("null_key")),
        F.when(F.length(key) > 50, F.lit("key_too_long")),
        F.when(F.col("status").isNotNull() & ~F.col("status").isin(VALID_STATUSES), F.lit("bad_status")),
        F.when(F.length("product_category") > 50, F.lit("category_too_long")),
        F.when(F.length("currency") > 10, F.lit("currency_too_long")),
        F.when(amount.isNotNull() & amount.try_cast("decimal(10,2)").isNull(), F.lit("amount_overflow"))))


def constraint_violations(df: DataFrame, existing_keys: DataFrame | None = None,
                          prior: str | None = None) -> DataFrame:
    """Add ``reject_reasons`` (array) for rows the quarantine table's
    constraints would refuse: NULL / over-long key, status outside the CHECK
    list, over-long text columns, amount beyond NUMERIC(10,2), a key that is
    stored already, and every further copy of a key in the batch. ``prior``
    names an array column of reasons found before; its rows are refused, too.

    The copy that stays is the first by ``ingested_at``, then by content, of
    those that nothing else refuses. Keys are counted first; only rows of a key
    that comes more than once are compared. The first is picked by a minimum
    (combined map-side, no window over a key) over rows that carry a number of
    their own, and the further copies are marked by a join on that number, so
    identical copies are told apart and a hot key's rows are never gathered.
    Known keys and further copies are broadcast within the bound of
    ``joins.bounded_broadcast``, and joined by a shuffle beyond it.

    The rows are stored once, before anything is counted, so values that are
    drawn anew at each run (``uuid()``) are the same everywhere; once the result
    has been used, ``joins.discard`` drops them."""
    ensure_checkpoint_dir(df.sparkSession)
    found = row_reasons()
    if prior:
        found = F.array_union(F.coalesce(prior, F.array().cast("array<string>")), found)
    out = df.withColumn("reject_reasons", found)
    if existing_keys is not None:
        known = bounded_broadcast(existing_keys.select("transaction_id").distinct().withColumn(
            "_known", F.lit(True)))
        out = out.join(known, "transaction_id", "left").withColumn("reject_reasons", F.when(
            F.coalesce("_known", F.lit(False)),
            F.array_append("reject_reasons", F.lit("duplicate_key")))
            .otherwise(F.col("reject_reasons"))).select(*df.columns, "reject_reasons")
    out = materialize(out.withColumn("_row", F.monotonically_increasing_id()), "constrained")
    sound = out.filter(F.size("reject_reasons") == 0)
    twice = bounded_broadcast(sound.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("_n"))
                              .filter("_n > 1").select("transaction_id"))
    content = [c for c in ("ingested_at",) if c in df.columns] + [
        c for c in df.columns if c not in ("ingested_at", "transaction_id", prior)]
    copies = pinned(sound.join(twice, "transaction_id", "left_semi"))
    first = (copies.groupBy("transaction_id")
             .agg(F.min(F.struct(*content, "_row")).alias("_first"))
             .select(F.col("_first._row").alias("_row")))
    further = bounded_broadcast(copies.select("_row").join(first, "_row", "left_anti")
                                .withColumn("_further", F.lit(True)))
    return stored_with(out.join(further, "_row", "left").withColumn("reject_reasons", F.when(
        F.col("_further"), F.array(F.lit("duplicate_key"))).otherwise(F.col("reject_reasons"))).select(
        *df.columns, "reject_reasons"), out)
