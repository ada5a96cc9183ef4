"""The write–audit–publish run as one Spark application.

Step order follows the reference DAG — load → quality → fix → recheck →
publish → models → lineage — in one session, passing DataFrames between
steps. Each table is written under ``warehouse`` (``audit/``, ``prod/``,
``analytics/``, ``ops/``); every written table is read back for the next
step, which cuts lineage and lets the next scan prune columns. Tables that a
run replaces are versioned (``sources.versioned``; read them with
``read_current``): readers see the last run's or this one's. Prod and the logs
are appended to.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wapspark.functions.scalar import as_of_lit
from wapspark.operators import observability as obs
from wapspark.operators import publish, quality
from wapspark.operators.key_index import KeyIndex
from wapspark.plans import marts, staging, views
from wapspark.sources import bronze, sinks
from wapspark.sources.tables import PROD_COLUMNS
from wapspark.sources.versioned import VersionedTable, read_current, replace_table


@dataclass
class PipelineConfig:
    warehouse: str
    as_of: dt.datetime
    salt: str | None = None
    critical_suite: quality.Suite = quality.CRITICAL_SUITE
    warning_suite: quality.Suite = quality.WARNING_SUITE
    run_id: str = field(default_factory=lambda: f"run-{uuid.uuid4().hex}")
    raise_on_block: bool = True  # False: publish although a blocking rule failed
    metrics: dict = field(default_factory=dict)


def _path(cfg: PipelineConfig, *parts: str) -> str:
    return "/".join([cfg.warehouse.rstrip("/"), *parts])


def load_bronze_step(spark: SparkSession, bronze_path: str, cfg: PipelineConfig,
                     newest_only: bool = True) -> DataFrame:
    """Landing zone → quarantine (truncate-and-load, rejects kept aside)."""
    rows = bronze.to_quarantine_rows(bronze.read_bronze(spark, bronze_path, newest_only), cfg.as_of)
    accepted, rejected = bronze.load_to_quarantine(rows)
    rejected = rejected.withColumn("reject_reasons", F.array_join("reject_reasons", ","))
    acc_path, rej_path = _path(cfg, "audit", "raw_transactions"), _path(cfg, "audit", "rejected_records")
    replace_table(accepted, acc_path)
    replace_table(rejected, rej_path)
    acc, rej = read_current(spark, acc_path), read_current(spark, rej_path)
    counts = bronze.load_counts(acc, rej).first()
    cfg.metrics["load"] = {"inserted": counts.inserted, "discarded": counts.discarded}
    return acc


def check_schema(spark: SparkSession, audit: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """This run's columns against the last run's, then onto the history.
    One row per table: new and removed columns, type changes, drift flag."""
    current = obs.schema_snapshot(spark, {("audit", "raw_transactions"): audit}, cfg.as_of)
    path = _path(cfg, "ops", "schema_history")
    drift = obs.detect_schema_drift(current, sinks.read_if_present(spark, path)).withColumns({
        "check_timestamp": as_of_lit(cfg.as_of), "run_id": F.lit(cfg.run_id)}).checkpoint(eager=True)
    sinks.append(current, path)
    sinks.append(drift, _path(cfg, "ops", "schema_drift"))
    return drift


def published_keys(spark: SparkSession, prod: DataFrame, cfg: PipelineConfig) -> KeyIndex:
    """The index of prod's keys: made from prod by the first run that finds
    none, settled with prod after a run that died while publishing."""
    path = _path(cfg, "ops", "published_keys")
    if not sinks.path_exists(spark, f"{path}/meta/_SUCCESS"):
        held = prod.count()
        index = KeyIndex.create(spark, path, ["transaction_id"], max(1 << 20, 4 * held), buckets=64)
        index.add(prod, "made from prod")
        index.commit("made from prod")
        return index
    index = KeyIndex(spark, path)
    index.recover(prod)
    return index


def register_pii_columns(spark: SparkSession, audit: DataFrame, prod: DataFrame, stg: DataFrame,
                         cfg: PipelineConfig) -> DataFrame:
    """The catalogue with what the run's tables hold. The initial entries
    and the columns' own tags are inserted where they are absent."""
    path = _path(cfg, "ops", "pii_catalog")
    known = read_current(spark, path)
    if known is None:
        known = obs.pii_catalog_seed(spark)
    tagged = obs.pii_catalog_from_schema(spark, {
        ("audit", "raw_transactions"): audit, ("prod", "raw_transactions"): prod,
        ("staging", "stg_raw_transactions"): stg})
    replace_table(obs.register_pii(known, tagged), path)
    return read_current(spark, path)


def run_pipeline(spark: SparkSession, audit: DataFrame, cfg: PipelineConfig) -> dict:
    """Run audit → publish → models over a quarantine-shaped frame.
    Returns the gate summaries, counts and output paths.

    A failed blocking rule raises ``QualityGateError`` after the results and
    the log row are stored and before anything is written to ``prod`` or
    ``analytics``, unless the configuration says to go on."""
    out: dict = {"paths": {}}
    w = lambda *p: _path(cfg, *p)
    as_of_col = as_of_lit(cfg.as_of)

    # Audit: one-pass suites, written once; this run's rows decide.
    res = quality.run_suite(audit, cfg.critical_suite).unionByName(
        quality.run_suite(audit, cfg.warning_suite)).checkpoint(eager=True)
    sinks.append(res.withColumn("run_id", F.lit(cfg.run_id)), w("ops", "validation_results"))
    out["gate"] = quality.gate(res, raise_on_block=False)
    log = quality.validation_metrics(audit, "raw_transactions", as_of_col, cfg.critical_suite.name,
                                     out["gate"]["warning_messages"])
    sinks.append(log, w("ops", "gx_validation_logs"))
    sinks.append(obs.freshness_record(audit.withColumn("_table", F.lit("raw_transactions")), "_table",
                                      "ingested_at", as_of=cfg.as_of), w("ops", "freshness_log"))
    out["schema_drift"] = check_schema(spark, audit, cfg).first().asDict(recursive=True)
    if cfg.raise_on_block and out["gate"]["blocking_triggered"]:
        raise quality.QualityGateError(f"quality gate failed: {out['gate']['critical_failures']}")
    out["pre_check"] = quality.quality_check(audit).first().asDict()

    # Fix, then recheck.
    fixed = publish.repair(audit)
    out["post_check"] = quality.quality_check(fixed).first().asDict()

    # Publish: the cleaned table (replaced) and the incremental prod append.
    replace_table(publish.publish_clean(fixed), w("analytics", "cleaned_transactions"))
    cleaned = read_current(spark, w("analytics", "cleaned_transactions"))
    prod_path = w("prod", "raw_transactions")
    prod_now = sinks.read_if_present(spark, prod_path)
    if prod_now is None:
        prod_now = spark.createDataFrame([], cleaned.schema).withColumns({
            "processed_at": F.lit(None).cast("timestamp_ntz"),
            "data_quality_score": F.lit(None).cast("decimal(3,2)"),
            publish.PROD_DAY: F.lit(None).cast("date")})
    index = published_keys(spark, prod_now, cfg)
    new_rows = publish.publish_indexed(audit, index, as_of=cfg.as_of, by_day=True)
    to_write = new_rows.select(*PROD_COLUMNS, publish.PROD_DAY).checkpoint(eager=True)
    index.add(to_write, cfg.run_id)
    out["published"] = obs.observed_write(to_write, prod_path, partition_by=[publish.PROD_DAY])
    index.commit(cfg.run_id)
    # With the known schema, an empty prod (nothing published yet) reads fine.
    prod = spark.read.schema(to_write.schema).parquet(prod_path).drop(publish.PROD_DAY)
    out["reconciliation"] = publish.reconciliation(audit, prod).first().asDict()

    # Models.
    stg = staging.stg_raw_transactions(prod, as_of=cfg.as_of)
    enriched = marts.int_transactions_enriched(stg, materialize_stage=False,
                                               include_median=False)
    fct = marts.fct_transactions(enriched)
    marts.write_fct(fct, w("analytics", "fct_transactions"))
    fct = read_current(spark, w("analytics", "fct_transactions"))
    replace_table(marts.analytics_transactions(fct, cfg.salt), w("analytics", "analytics_transactions"))
    replace_table(staging.fact_transactions(cleaned), w("analytics", "fact_transactions"))
    replace_table(marts.dim_users(cleaned), w("analytics", "dim_users"))
    replace_table(marts.dim_product_category(cleaned), w("analytics", "dim_product_category"))
    replace_table(marts.dim_users_rfm(stg, cfg.as_of), w("analytics", "dim_users_rfm"))
    replace_table(views.analytics_view(prod, cfg.salt), w("analytics", "v_analytics_transactions"))
    replace_table(obs.quality_dashboard(audit, ordered=False), w("ops", "quality_dashboard"))

    # Model tests over what was written.
    tested = {"stg_raw_transactions": (stg, quality.STG_TESTS),
              "fct_transactions": (fct, quality.FCT_TESTS),
              "dim_users": (read_current(spark, w("analytics", "dim_users_rfm")),
                            quality.DIM_USERS_TESTS)}
    parts = [quality.run_model_tests(df, name, tests) for name, (df, tests) in tested.items()]
    results = reduce(DataFrame.unionByName, parts).withColumn("run_id", F.lit(cfg.run_id)).checkpoint()
    sinks.append(results, w("ops", "model_tests"))
    out["model_tests_failed"] = results.filter(~F.col("passed")).count()

    # Lineage of this run (always recorded) and metrics.
    nodes = [{"node_id": n, "node_name": n, "node_type": "table"} for n in (
        "audit.raw_transactions", "prod.raw_transactions", "analytics.cleaned_transactions",
        "analytics.fct_transactions", "analytics.analytics_transactions")]
    edges = [{"source_id": "audit.raw_transactions", "target_id": "analytics.cleaned_transactions",
              "transformation": "repair+publish_clean"},
             {"source_id": "audit.raw_transactions", "target_id": "prod.raw_transactions",
              "transformation": "publish_incremental"},
             {"source_id": "prod.raw_transactions", "target_id": "analytics.fct_transactions",
              "transformation": "staging+enrichment+fact"},
             {"source_id": "analytics.fct_transactions", "target_id": "analytics.analytics_transactions",
              "transformation": "pseudonymise"}]
    sinks.append(obs.lineage_records(spark, nodes, edges, cfg.run_id, cfg.as_of), w("ops", "data_lineage"))
    metrics = {f"published_{k}": v for k, v in out["published"].items()}
    metrics.update({f"load_{k}": v for k, v in cfg.metrics.get("load", {}).items()})
    sinks.append(obs.pipeline_metric_rows(spark, "publish", metrics, cfg.as_of), w("ops", "pipeline_metrics"))
    out["pii_columns"] = register_pii_columns(spark, audit, prod, stg, cfg).count()
    # The version before stays for readers that have begun on it.
    for name in REPLACED:
        VersionedTable(spark, w(*name)).vacuum(keep=2)
    return out


# Tables that a run replaces.
REPLACED = [*[("analytics", t) for t in (
    "cleaned_transactions", "fct_transactions", "analytics_transactions", "fact_transactions",
    "dim_users", "dim_product_category", "dim_users_rfm", "v_analytics_transactions")],
    ("ops", "quality_dashboard"), ("ops", "pii_catalog")]


def create_views(spark: SparkSession, prod: DataFrame, audit: DataFrame,
                 as_of: dt.datetime | None = None, salt: str | None = None) -> list[str]:
    """Register the models as temporary views for Spark SQL users."""
    from wapspark.functions.privacy import register_sql_functions
    register_sql_functions(spark, salt)
    stg = staging.stg_raw_transactions(prod, as_of=as_of)
    enriched = marts.int_transactions_enriched(stg)
    fct = marts.fct_transactions(enriched)
    frames = {
        "stg_raw_transactions": stg,
        "stg_masked_transactions": staging.stg_masked_transactions(stg),
        "int_transactions_enriched": enriched,
        "fct_transactions": fct,
        "analytics_transactions": marts.analytics_transactions(fct, salt),
        "dim_users_rfm": marts.dim_users_rfm(stg, as_of),
        "v_masked_transactions_audit": views.audit_masked_transactions(audit),
        "v_masked_transactions_prod": views.prod_masked_transactions(prod),
        "v_analytics_transactions": views.analytics_view(prod, salt),
        "vw_data_quality_dashboard": obs.quality_dashboard(audit),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)
