"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the ``tx`` adapter or
directly) over whole tables, so its work grows with them.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wapspark.functions.privacy import apply_masking
from wapspark.functions.scalar import as_of_lit
from wapspark.operators import observability as obs
from wapspark.operators import publish, quality, reports, shredding, sketches
from wapspark.operators.file_schemas import file_schema_drift, file_schemas
from wapspark.operators.incremental import MetricState
from wapspark.operators.joins import discard, materialize, stored_part
from wapspark.operators.key_index import KeyIndex
from wapspark.operators.key_store import KeyStore
from wapspark.operators.ranking import (exact_percentile_cont, ntile_from_position,
                                        rank_positions)
from wapspark.plans import marts, staging, views
from wapspark.plans.outputs import comparable
from wapspark.session import drop_unused, path_bytes, scratch_path
from wapspark.sources import bronze, sinks
from wapspark.sources.clustered import ClusteredTable
from wapspark.sources.tables import (AS_OF, AUDIT_COLUMNS, EVENTS_AS_OF, read_table,
                                     transactions)
from wapspark.streaming.bronze_stream import ingest_bronze_stream
from wapspark.streaming.freshness_stream import watch_freshness

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The staging test feeds lower-case status so UPPER is exercised.
    return staging.stg_raw_transactions(
        transactions(spark, sf_dir, "prod", status_case="lower"), as_of=AS_OF)


# The wide steps over all transactions go in so many parts, one after another:
# one for each STEP_BYTES of line items, MOST_STEPS at most.
STEP_BYTES, MOST_STEPS = 8 << 20, 16


def _steps(spark: SparkSession, sf_dir: str) -> int:
    size = path_bytes(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return max(1, min(MOST_STEPS, size // STEP_BYTES))


def _stg_shares(spark: SparkSession, sf_dir: str, n: int) -> list[DataFrame]:
    """``_stg`` in ``n`` frames, by a hash of the order."""
    return [staging.stg_raw_transactions(
        transactions(spark, sf_dir, "prod", status_case="lower", share=(k, n) if n > 1 else None),
        as_of=AS_OF) for k in range(n)]


def _enriched(spark: SparkSession, sf_dir: str, include_median: bool = True) -> DataFrame:
    n = _steps(spark, sf_dir)
    return marts.int_transactions_enriched(_stg_shares(spark, sf_dir, n), include_median=include_median,
                                           parts=n)


def _fct(spark: SparkSession, sf_dir: str, **leave_out) -> DataFrame:
    return marts.fct_transactions(marts.int_transactions_enriched(
        _stg(spark, sf_dir), include_median=False, completed_only=True, **leave_out))


@query("m1_stg_raw_transactions")
def q_stg(spark, sf_dir):
    return comparable(_stg(spark, sf_dir))


@query("m2_int_transactions_enriched")
def q_enriched(spark, sf_dir):
    return comparable(_enriched(spark, sf_dir),
                      round_cols={"user_stddev_transaction_amount": 4,
                                  "user_median_transaction_amount": 4})


@query("m2_enriched_by_increments")
def q_enriched_by_increments(spark, sf_dir):
    """M2 from metrics kept by three changes: two thirds of the rows, with some
    wrong ones among them; the rest; and the wrong ones taken back."""
    n = _steps(spark, sf_dir)
    stg = materialize([f.select("*", marts.user_part(n)) for f in _stg_shares(spark, sf_dir, n)],
                      "stg", by=marts.USER_PART)
    state = MetricState(spark, scratch_path(spark, "metrics"), buckets=4)
    third = F.pmod(F.xxhash64("transaction_id", F.lit("change")), F.lit(3))
    wrong = stg.filter(third == 0).withColumns({
        "status": F.lit("COMPLETED"), "amount": (F.col("amount") + 1).cast("decimal(10,2)"),
        "user_id": F.col("user_id") + 7, "product_category": F.lit("mistaken")})
    state.apply(stg.filter(third < 2).unionByName(wrong), "first")
    state.apply(stg.filter(third == 2), "second")
    state.apply(wrong.withColumn("sign", F.lit(-1)), "third", "sign")
    out = marts.enrich_by_parts(stg, marts.with_quartiles(state.users()), state.categories(),
                                marts.with_moving_average(state.days()), parts=n)
    return comparable(out, round_cols={"user_stddev_transaction_amount": 4,
                                       "user_median_transaction_amount": 4})


def _completed(spark, sf_dir) -> DataFrame:
    return materialize(_stg(spark, sf_dir).filter(F.col("status") == "COMPLETED"), "completed")


def _sketched(spark, rows: DataFrame) -> DataFrame:
    """The rows' daily sketches by currency, stored by two batches of days."""
    table = sketches.DailySketches(spark, scratch_path(spark, "sketches"), "currency")
    early = F.year("transaction_day") < 1996
    table.store(rows.filter(early))
    table.store(rows.filter(~early))
    return table.read()


@query("g2_quartiles_by_daily_sketches")
def q_sketched_quartiles(spark, sf_dir):
    """Quartiles of the amounts by currency: exact, and whether those of the
    merged days lie within the sketch's bound (in rank)."""
    rows = _completed(spark, sf_dir)
    points = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    merged = sketches.merged_quantiles(_sketched(spark, rows), ["class"], points)
    out = merged.drop("ranks")
    # Shares of the rows below, and up to, what the sketch gives: one pass.
    at = rows.select("currency", F.col("amount").cast("double").alias("v")).filter("v is not null").join(
        F.broadcast(out), F.col("currency").eqNullSafe(F.col("class")))  # a row a currency
    share = at.groupBy("currency").agg(*[f(F.when(c, 1).otherwise(0)).alias(f"{name}_{side}") for name in points
                                         for side, f, c in (("lo", F.avg, F.col("v") < F.col(name)),
                                                            ("hi", F.avg, F.col("v") <= F.col(name)))])
    exact = [exact_percentile_cont(rows, ["currency"], "amount", f"exact_{name}", p)
             for name, p in points.items()]
    joined = reduce(lambda a, b: a.join(b, "currency"), [share, *exact])
    return joined.select("currency", *[F.round(f"exact_{name}", 4).alias(f"exact_{name}") for name in points],
                         *[((F.col(f"{name}_lo") - sketches.RANK_ERROR <= p)
                            & (F.col(f"{name}_hi") + sketches.RANK_ERROR >= p)).alias(f"{name}_within")
                           for name, p in points.items()])


@query("w1_quartiles_by_sketch")
def q_ntile_by_sketch(spark, sf_dir):
    """Value quartile of each user: exact, and whether the bucket between the
    edges of a rank sketch is the same or its edge is within the bound."""
    um = marts.user_metrics(_completed(spark, sf_dir), include_median=False, include_ranks=False)
    um = um.select("user_id", "total_amount").checkpoint()
    total = F.col("total_amount").cast("double")
    parts = um.groupBy(F.pmod(F.xxhash64("user_id"), F.lit(4)).alias("part")).agg(
        F.kll_sketch_agg_double(total, F.lit(sketches.RANK_K)).alias("ranks"))
    edges = sketches.merged_quantiles(parts, [], {"e1": 0.75, "e2": 0.5, "e3": 0.25}).drop("ranks")
    placed = rank_positions(um, [F.col("total_amount").desc_nulls_first(),
                                 F.col("user_id").asc_nulls_first()])
    near = placed.crossJoin(F.broadcast(edges)).select(  # one row
        "user_id", ntile_from_position(F.col("_rk_before") + 1, F.col("_rk_n"), 4).alias("value_quartile"),
        sketches.ntile_by_edges([F.col("e1"), F.col("e2"), F.col("e3")], total).alias("guess"),
        (4 * F.col("_rk_before") / F.col("_rk_n")).alias("place"), F.col("_rk_n").alias("n"))
    at_edge = F.abs(F.col("place") - F.round("place")) <= 4 * (sketches.RANK_ERROR + 1 / F.col("n"))
    return near.select(F.col("user_id").cast("long"), "value_quartile", (
        (F.col("guess") == F.col("value_quartile"))
        | (at_edge & (F.abs(F.col("guess") - F.col("value_quartile")) <= 1))).alias("within"))


@query("g6_weekly_users_by_daily_sketches")
def q_weekly_users(spark, sf_dir):
    """Users of each seven days, and those new among them: exact, and whether
    the merged daily sketches are within their bound."""
    rows = _completed(spark, sf_dir)
    got = sketches.rolling_users(_sketched(spark, rows)).withColumnsRenamed(
        {"users": "est", "new_users": "est_new"})
    exact = sketches.rolling_users_exact(rows)
    off = lambda a, b: F.abs(F.col(a) - F.col(b)) <= sketches.SET_ERROR * F.col("both_spans")
    return comparable(exact.join(got, "day", "left").select(
        F.col("day").cast("timestamp_ntz").alias("day"), "users", "new_users",
        F.coalesce(off("est", "users"), F.lit(False)).alias("users_within"),
        F.coalesce(off("est_new", "new_users"), F.lit(False)).alias("new_users_within")))


@query("m3_fct_transactions")
def q_fct(spark, sf_dir):
    return comparable(_fct(spark, sf_dir))


@query("m4_analytics_transactions")
def q_analytics(spark, sf_dir):
    # The view has none of the daily columns.
    fct = _fct(spark, sf_dir, include_daily=False)
    return comparable(marts.analytics_transactions(fct))


@query("s1_clustered_read")
def q_clustered_read(spark, sf_dir):
    """The staged transactions laid out along (date, user, category), and what a
    filter on the date and the user reads: by status, rows and their sum."""
    n = _steps(spark, sf_dir)
    stg = materialize(_stg_shares(spark, sf_dir, n), "stg")
    table = ClusteredTable(spark, scratch_path(spark, "clustered"))
    table.write(stg, ["transaction_date", "user_id", "product_category"], files=64, steps=n,
                spent=lambda: discard(stg))
    got = table.read({"transaction_date": (_dt.datetime(1994, 1, 1), _dt.datetime(1995, 6, 30)),
                      "user_id": (20, 60)})
    return comparable(got.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"),
                                                F.sum("amount").alias("total")))


# --- quality (Q*) -----------------------------------------------------------


def _audit(spark, sf_dir):
    return transactions(spark, sf_dir, "audit")


def _audit_dup(spark, sf_dir):
    # The quarantine table as loaded, with repeated records (for uniqueness).
    return transactions(spark, sf_dir, "dup").select(*AUDIT_COLUMNS)


def _suite_query(suite):
    def q(spark, sf_dir):
        return comparable(quality.run_suite(_audit_dup(spark, sf_dir), suite))
    return q


for _key, _suite in (("q7_suite_critical", quality.CRITICAL_SUITE),
                     ("q7_suite_quality", quality.QUALITY_SUITE),
                     ("q7_suite_warning", quality.WARNING_SUITE),
                     ("q7_suite_basic", quality.BASIC_SUITE),
                     ("q7_suite_script_gate", quality.SCRIPT_SUITE)):
    QUERIES[_key] = _suite_query(_suite)


@query("q9_validation_metrics")
def q_validation_metrics(spark, sf_dir):
    m = quality.validation_metrics(_audit(spark, sf_dir), "raw_transactions", as_of_lit(AS_OF),
                                   quality.CRITICAL_SUITE.name)
    return comparable(m.withColumn("critical_failures", F.array_join("critical_failures", ", "))
                       .withColumn("warning_messages", F.array_join("warning_messages", ", ")))


@query("q10_quality_check")
def q_quality_check(spark, sf_dir):
    return comparable(quality.quality_check(_audit(spark, sf_dir)))


@query("q11_row_verdicts")
def q_row_verdicts(spark, sf_dir):
    rows = _audit_dup(spark, sf_dir)
    needed = {"transaction_id", "user_id", *(r.column for r in quality.CRITICAL_SUITE.rules)}
    a = quality.annotate_rows(rows.select(*[c for c in rows.columns if c in needed]), quality.CRITICAL_SUITE)
    return comparable(a.select("transaction_id", "user_id", "gx_validation_status",
                               F.array_join("gx_validation_errors", ",").alias("gx_validation_errors")))


@query("q12_model_tests_stg")
def q_tests_stg(spark, sf_dir):
    return quality.run_model_tests(_stg(spark, sf_dir), "stg_raw_transactions", quality.STG_TESTS)


@query("q12_model_tests_fct")
def q_tests_fct(spark, sf_dir):
    # The tested columns need neither the quartiles nor the days.
    fct = _fct(spark, sf_dir, include_daily=False, include_ranks=False)
    return quality.run_model_tests(fct, "fct_transactions", quality.FCT_TESTS)


# --- publish (M10, M11, U4, B6/B7, O8, G11) and dimensions (M5–M8) --------

@query("b6b7_repair")
def q_repair(spark, sf_dir):
    return comparable(publish.repair(_audit(spark, sf_dir)))


@query("m10_publish_clean")
def q_publish_clean(spark, sf_dir):
    return comparable(publish.publish_clean(_audit(spark, sf_dir)))


@query("m11_publish_incremental")
def q_publish_incremental(spark, sf_dir):
    prod = transactions(spark, sf_dir, "published")
    return comparable(publish.publish_incremental(_audit_dup(spark, sf_dir), prod, as_of=AS_OF))


def _moved_audit(spark, sf_dir):
    """A batch where dates have moved since or are missing, and some new rows
    have no key."""
    return _audit_dup(spark, sf_dir).withColumns({
        "transaction_date": F.when(F.dayofmonth("ingested_at") % 5 != 0, F.col("transaction_date")),
        "transaction_id": F.when(F.col("user_id") % 17 == 0, F.lit(None))
                           .otherwise(F.col("transaction_id"))})


@query("m11_publish_incremental_by_day")
def q_publish_by_day(spark, sf_dir):
    """Publishing into a table stored by day."""
    audit = _moved_audit(spark, sf_dir)
    moved = F.to_date("transaction_date") + F.expr("INTERVAL 1 DAY")
    prod = transactions(spark, sf_dir, "published").withColumn(publish.PROD_DAY, moved)
    new = publish.publish_incremental(audit, prod, as_of=AS_OF)
    return comparable(new.withColumn(publish.PROD_DAY, F.col(publish.PROD_DAY).cast("timestamp_ntz")))


def _key_index(spark, prod) -> KeyIndex:
    """An index that holds prod's keys, published by two runs."""
    prod = materialize(prod.select("transaction_id"), "published")  # counted and read by each run
    index = KeyIndex.create(spark, scratch_path(spark, "keys"), ["transaction_id"],
                            expected_keys=max(1, prod.count()), buckets=16)
    half = F.pmod(F.xxhash64("transaction_id", F.lit("run")), F.lit(2))
    for run in (0, 1):
        index.add(prod.filter(half == run), f"run-{run}")
        index.commit(f"run-{run}")
    return index


@query("m11_publish_indexed")
def q_publish_indexed(spark, sf_dir):
    index = _key_index(spark, transactions(spark, sf_dir, "published"))
    return comparable(publish.publish_indexed(_audit_dup(spark, sf_dir), index, as_of=AS_OF))


@query("m11_publish_indexed_by_day")
def q_publish_indexed_by_day(spark, sf_dir):
    index = _key_index(spark, transactions(spark, sf_dir, "published"))
    new = publish.publish_indexed(_moved_audit(spark, sf_dir), index, as_of=AS_OF, by_day=True)
    return comparable(new.withColumn(publish.PROD_DAY, F.col(publish.PROD_DAY).cast("timestamp_ntz")))


@query("u4_dedup_latest")
def q_dedup(spark, sf_dir):
    return comparable(publish.dedup_latest(transactions(spark, sf_dir, "dup")))


@query("o8_reconciliation")
def q_reconciliation(spark, sf_dir):
    audit = _audit(spark, sf_dir)
    return publish.reconciliation(audit, publish.publish_clean(audit))


@query("g11_prod_summary")
def q_prod_summary(spark, sf_dir):
    return comparable(publish.prod_summary(transactions(spark, sf_dir, "prod")))


def _cleaned(spark, sf_dir):
    # Pipeline order: repair the quarantine, then publish the clean table.
    return publish.publish_clean(publish.repair(_audit(spark, sf_dir)))


@query("m5_stg_masked_transactions")
def q_stg_masked(spark, sf_dir):
    return comparable(staging.stg_masked_transactions(_stg(spark, sf_dir)))


@query("m6_fact_transactions")
def q_fact(spark, sf_dir):
    return comparable(staging.fact_transactions(_cleaned(spark, sf_dir)))


@query("m7_dim_users")
def q_dim_users(spark, sf_dir):
    return comparable(marts.dim_users(_cleaned(spark, sf_dir)))


@query("m8_dim_product_category")
def q_dim_category(spark, sf_dir):
    return comparable(marts.dim_product_category(_cleaned(spark, sf_dir)))


# --- privacy views (M16–M18, P1–P3, P7) ---------------------------------------


@query("m16_audit_masked_transactions")
def q_audit_masked(spark, sf_dir):
    return comparable(views.audit_masked_transactions(_audit(spark, sf_dir)))


@query("m17_prod_masked_transactions")
def q_prod_masked(spark, sf_dir):
    return comparable(views.prod_masked_transactions(transactions(spark, sf_dir, "prod")))


@query("m18_analytics_view")
def q_analytics_view(spark, sf_dir):
    return comparable(views.analytics_view(transactions(spark, sf_dir, "prod")))


@query("p1_p3_masked_contacts")
def q_masked_contacts(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    return comparable(views.masked_contacts(views.customer_contacts(cust)))


# Masking configuration as the rule masker understands it (the shipped file
# misspells the rule type; unknown types fail by default).
MASKING_RULES = {"fields": {"transaction_id": {"type": "mask_transaction_id",
                                               "params": {"visible_digits": 4, "mask_char": "*"}}},
                 "default_action": "keep_original"}


@query("p7_rule_masking")
def q_rule_masking(spark, sf_dir):
    return comparable(apply_masking(_audit(spark, sf_dir), MASKING_RULES))


# --- observability (O1, M12, M13) ---------------------------------------------

def _monitor(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_type", "ts"])
    return ev.select(F.col("event_type").alias("table_name"), F.col("ts").alias("actual_arrival_time"))


FRESHNESS_INSTANTS = [EVENTS_AS_OF + _dt.timedelta(hours=h) for h in (0, 4, 8, 24)]


@query("o1_freshness_record")
def q_freshness_record(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", ["event_type", "ts"])
    return comparable(obs.freshness_record(ev, "event_type", "ts", as_of=EVENTS_AS_OF))


@query("o1_freshness_changes_stream")
def q_freshness_changes(spark, sf_dir):
    """Changes of class of each feed (kind of event and user), from the events
    as files that land in four extracts, each followed by a run of the stream."""
    events = read_table(spark, sf_dir, "events", ["event_type", "user_id", "ts"]).select(
        F.concat_ws("/", "event_type", "user_id").alias("feed"), "ts")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    base = scratch_path(spark, "freshness")
    quarter = (last - first) / 4
    for k in range(4):
        low, high = F.lit(first + k * quarter), F.lit(first + (k + 1) * quarter)
        part = events.filter((F.col("ts") >= low) & ((F.col("ts") < high) | F.lit(k == 3)))
        part.write.parquet(f"{base}/in/{k}")
        run = watch_freshness(spark, f"{base}/in", "feed string, ts timestamp_ntz", "feed", "ts",
                              f"{base}/out", f"{base}/state")
        run.awaitTermination()
        if run.exception() is not None:
            raise run.exception()
    return spark.read.parquet(f"{base}/out").select("feed", "status", "changed_at")


@query("m12_freshness_dashboard")
def q_freshness_dashboard(spark, sf_dir):
    return comparable(obs.freshness_dashboard(_monitor(spark, sf_dir), FRESHNESS_INSTANTS))


@query("m13_quality_dashboard")
def q_quality_dashboard(spark, sf_dir):
    return comparable(obs.quality_dashboard(_audit(spark, sf_dir)))


def _order_edges(spark, sf_dir) -> DataFrame:
    """Each order is derived from the customer's one before; the first of a
    customer with several is checked against the last, which closes a cycle."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    by_date = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    own = orders.withColumns({"after": F.lead("o_orderkey").over(by_date),
                              "first": F.first("o_orderkey").over(by_date)})
    return own.select(F.col("o_orderkey").alias("source_id"), F.coalesce("after", F.when(
        F.col("first") != F.col("o_orderkey"), F.col("first"))).alias("target_id"))


@query("o7_lineage_closure")
def q_lineage_closure(spark, sf_dir):
    """What each order feeds within four hops."""
    return obs.lineage_closure(_order_edges(spark, sf_dir), max_hops=4)


@query("o7_lineage_impact")
def q_lineage_impact(spark, sf_dir):
    """Orders downstream of each, all hops, and how far the farthest is."""
    return obs.lineage_closure(_order_edges(spark, sf_dir)).groupBy("node").agg(
        F.count(F.lit(1)).alias("downstream"), F.max("hops").alias("farthest"))


@query("o5_file_schema_drift")
def q_file_schema_drift(spark, sf_dir):
    """Orders written by three versions of a writer, by the order's year: the
    paths whose schema differs between the files, and the rows on either side."""
    orders = read_table(spark, sf_dir, "orders")
    path, year = scratch_path(spark, "mixed-orders"), F.year("o_orderdate")
    key, priority = F.col("o_orderkey"), F.col("o_orderpriority")
    who = F.col("o_custkey").alias("id")
    first = orders.filter(year < 1997).select(
        key.cast("int").alias("o_orderkey"), F.struct(F.col("o_custkey").cast("int").alias("id")).alias("customer"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), "o_orderstatus",
        priority.alias("o_orderpriority"))
    second = orders.filter((year >= 1997) & (year < 1999)).select(
        key, F.struct(who, priority.alias("class")).alias("customer"),
        F.col("o_totalprice").cast("decimal(18,4)").alias("o_totalprice"), "o_orderstatus",
        priority.alias("o_orderpriority"))
    third = orders.filter((year >= 1999) | year.isNull()).select(
        key, F.struct(who, priority.alias("class")).alias("customer"),
        F.col("o_totalprice").cast("decimal(18,4)").alias("o_totalprice"), "o_orderstatus",
        F.substring(priority, 1, 1).cast("int").alias("o_orderpriority"), "o_orderdate")
    for version in (first, second, third):
        version.write.mode("append").parquet(path)
    # The number of files is the cluster's.
    return file_schema_drift(file_schemas(spark, path)).select(
        "path", "change", "types", "merged_type", "n_rows", "lacking_rows")


# --- crypto-shredding (P8–P12) over the customer table ------------------------

KEY_SEED = "k"  # repeatable test keys: sha256('k' || id)


def _customers(spark, sf_dir):
    return read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"]) \
        .withColumn("user_id", F.col("c_custkey").cast("int"))


@query("p8_p11_shred_readback")
def q_shred_readback(spark, sf_dir):
    cust = _customers(spark, sf_dir)
    keys = shredding.issue_keys(cust, as_of=AS_OF, test_seed=KEY_SEED)
    enc, _missing = shredding.encrypt_column(cust, "user_id", "c_name", keys, "name_enc")
    requests = cust.filter(F.col("c_custkey") % 50 == 0).select("user_id")
    next_keys, _done = shredding.process_deletions(requests, keys, as_of=AS_OF)
    back = shredding.decrypt_column(enc, "user_id", "name_enc", next_keys, "c_name")
    active = next_keys.select("user_id", F.col("is_active").alias("key_active"))
    return comparable(back.join(active, "user_id", "left")
                          .select("c_custkey", "c_name", "key_active"))


@query("p11_key_store_rotation")
def q_key_store(spark, sf_dir):
    """Keys wrapped in buckets; a master key that changes, deletions that rewrite
    their buckets, and what can still be read."""
    cust = _customers(spark, sf_dir)
    store = KeyStore(spark, scratch_path(spark, "key-store"), "m1", b"0123456789abcdef", buckets=16)
    store.issue(cust, as_of=AS_OF, test_seed=KEY_SEED)
    enc, _missing = shredding.encrypt_column(cust, "user_id", "c_name", store.keys(), "name_enc")
    enc = enc.checkpoint()
    store.rotate_master("m2", b"fedcba9876543210")
    store.delete(cust.filter(F.col("c_custkey") % 50 == 0).select("user_id"), as_of=AS_OF)
    keys = store.keys()
    back = shredding.decrypt_column(enc, "user_id", "name_enc", keys, "c_name")
    active = keys.select("user_id", F.col("is_active").alias("key_active"))
    return comparable(back.join(active, "user_id", "left").select("c_custkey", "c_name", "key_active"))


@query("p12_deletion_status")
def q_deletion_status(spark, sf_dir):
    cust = _customers(spark, sf_dir)
    keys = shredding.issue_keys(cust.filter(F.col("c_custkey") % 7 != 0), as_of=AS_OF,
                                test_seed=KEY_SEED)
    requests = cust.filter(F.col("c_custkey") % 50 == 0).select("user_id")
    next_keys, done = shredding.process_deletions(requests, keys, as_of=AS_OF)
    return comparable(shredding.deletion_status(cust.select("user_id"), next_keys, done))


# --- RFM user dimension (M9) ---------------------------------------------------

def _rfm(spark, sf_dir):
    return marts.dim_users_rfm(_stg(spark, sf_dir), as_of=AS_OF)


@query("m9_dim_users_rfm")
def q_rfm(spark, sf_dir):
    return comparable(_rfm(spark, sf_dir))


@query("q12_model_tests_dim_users")
def q_tests_dim_users(spark, sf_dir):
    return quality.run_model_tests(_rfm(spark, sf_dir), "dim_users", quality.DIM_USERS_TESTS)


@query("q12_model_tests_enriched")
def q_tests_enriched(spark, sf_dir):
    # The tested columns need neither the median, the quartiles nor the days.
    enriched = marts.int_transactions_enriched(_stg(spark, sf_dir), include_median=False,
                                               include_ranks=False, include_daily=False)
    return quality.run_model_tests(enriched, "int_transactions_enriched",
                                   quality.ENRICHED_TESTS)


# --- bronze landing → quarantine load (A1, A5, A6) ------------------------------


def tx_bronze(spark, sf_dir, share: tuple[int, int] | None = None) -> DataFrame:
    """The transactions as raw records, with repeated ones and some empty ids."""
    tx = transactions(spark, sf_dir, "dup", share=share)
    return tx.select(
        F.when(F.col("user_id") % 13 == 0, F.lit("")).otherwise(F.col("transaction_id")).alias("id"),
        "user_id", F.col("amount").cast("string").alias("amount"),
        as_of_lit(AS_OF).alias("landed_at"))


def land_tx_bronze(spark, sf_dir) -> str:
    """Land them as bronze JSON lines under the extraction date; the path."""
    path = scratch_path(spark, "bronze")
    # Extracts land under their extraction date, as the landing zone does.
    sinks.land_bronze(tx_bronze(spark, sf_dir), path, "landed_at")
    return path


@query("a6_load_quarantine_counts")
def q_load_quarantine(spark, sf_dir):
    path = land_tx_bronze(spark, sf_dir)
    rows = bronze.to_quarantine_rows(bronze.read_bronze(spark, path), as_of=AS_OF)
    accepted, rejected = bronze.load_to_quarantine(rows)
    return bronze.load_counts(accepted, rejected)


@query("x1_stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Extracts that land one after another are ingested by three runs of the
    stream; copies of a record reach different runs. Rows by outcome."""
    base = scratch_path(spark, "stream")
    paths = [f"{base}/{d}" for d in ("bronze", "accepted", "rejected", "state")]
    n = _steps(spark, sf_dir)
    records = materialize([tx_bronze(spark, sf_dir, (k, n) if n > 1 else None).withColumn("extract", F.pmod(
        F.xxhash64("id", "amount"), F.lit(3)).cast("int")) for k in range(n)], "records", by="extract")
    for extract in range(3):
        sinks.land_bronze(stored_part(records, extract), paths[0], "landed_at", extract_id=str(extract),
                          compression="gzip")
        discard(records, extract)
        run = ingest_bronze_stream(spark, *paths, as_of=AS_OF)
        run.awaitTermination()
        if run.exception() is not None:
            raise run.exception()
        del run
        drop_unused(spark)
    accepted = spark.read.parquet(paths[1]).select(F.lit("accepted").alias("outcome"))
    rejected = spark.read.parquet(paths[2]).select(F.col("reject_reasons").alias("outcome"))
    return accepted.unionByName(rejected).groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))


# --- top-k reports (S4) --------------------------------------------------------


@query("s4_top_users_by_lifetime_value")
def q_top_users(spark, sf_dir):
    return comparable(reports.top_users_by_lifetime_value(_rfm(spark, sf_dir), 10))


@query("s4_newest_facts")
def q_newest_facts(spark, sf_dir):
    fct = _fct(spark, sf_dir, include_ranks=False, include_daily=False)
    return comparable(reports.newest_facts(fct, 10).select(
        "transaction_id", "user_id", "product_category", "amount", "transaction_quarter",
        "transaction_semester", "transaction_day_name", "data_quality_score",
        "composite_reliability_score", "is_anomaly"))


@query("s4_newest_quality_days")
def q_newest_quality_days(spark, sf_dir):
    return comparable(reports.newest_quality_days(obs.quality_dashboard(
        _audit(spark, sf_dir), ordered=False), 7))


@query("q15_constraint_violations")
def q_constraints(spark, sf_dir):
    """Quarantine-table constraints over the loaded batch (repeated records,
    an invalid status spelling, keys already published): rows per reason."""
    audit = _audit_dup(spark, sf_dir).withColumn(
        "status", F.when(F.col("user_id") % 11 == 0, F.lower("status")).otherwise(F.col("status")))
    flagged = quality.constraint_violations(audit, transactions(spark, sf_dir, "published"))
    return (flagged.select(F.explode("reject_reasons").alias("reason"))
                   .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))
