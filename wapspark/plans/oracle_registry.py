"""Registered oracle SQL, keyed like ``registry.QUERIES``."""

from __future__ import annotations

from wapspark.operators import quality as Q
from wapspark.plans import oracle as O

_DUP_AUDIT = O.tx_cte("dup")

ORACLE_SQL: dict[str, str] = {
    "m1_stg_raw_transactions": O.sql_stg_raw_transactions(),
    "m2_int_transactions_enriched": O.sql_int_transactions_enriched(),
    "m2_enriched_by_increments": O.sql_int_transactions_enriched(),
    "m3_fct_transactions": O.sql_fct_transactions(),
    "m4_analytics_transactions": O.sql_analytics_transactions(),
    "q7_suite_critical": O.suite_sql(Q.CRITICAL_SUITE, _DUP_AUDIT, "tx"),
    "q7_suite_quality": O.suite_sql(Q.QUALITY_SUITE, _DUP_AUDIT, "tx"),
    "q7_suite_warning": O.suite_sql(Q.WARNING_SUITE, _DUP_AUDIT, "tx"),
    "q7_suite_basic": O.suite_sql(Q.BASIC_SUITE, _DUP_AUDIT, "tx"),
    "q7_suite_script_gate": O.suite_sql(Q.SCRIPT_SUITE, _DUP_AUDIT, "tx"),
    "q9_validation_metrics": O.sql_validation_metrics(),
    "q10_quality_check": O.sql_quality_check(),
    "q11_row_verdicts": O.sql_row_verdicts(Q.CRITICAL_SUITE),
    "q12_model_tests_stg": O.model_tests_sql("stg_raw_transactions", Q.STG_TESTS,
                                             O.stg_ctes("lower"), "stg"),
    "q12_model_tests_fct": O.model_tests_sql("fct_transactions", Q.FCT_TESTS, O.fct_ctes(), "fct"),
    "b6b7_repair": O.sql_repair(),
    "m10_publish_clean": O.sql_publish_clean(),
    "m11_publish_incremental": O.sql_publish_incremental(),
    "m11_publish_incremental_by_day": O.sql_publish_incremental_by_day(),
    "m11_publish_indexed": O.sql_publish_incremental(),
    "m11_publish_indexed_by_day": O.sql_publish_incremental_by_day(),
    "s1_clustered_read": O.sql_clustered_read(),
    "g2_quartiles_by_daily_sketches": O.sql_sketched_quartiles(),
    "w1_quartiles_by_sketch": O.sql_ntile_by_sketch(),
    "g6_weekly_users_by_daily_sketches": O.sql_weekly_users(),
    "x1_stream_ingest": O.sql_stream_ingest(),
    "s4_newest_quality_days": O.sql_newest_quality_days(),
    "u4_dedup_latest": O.sql_dedup(),
    "o8_reconciliation": O.sql_reconciliation(),
    "g11_prod_summary": O.sql_prod_summary(),
    "m5_stg_masked_transactions": O.sql_stg_masked(),
    "m6_fact_transactions": O.sql_fact_transactions(),
    "m7_dim_users": O.sql_dim_users(),
    "m8_dim_product_category": O.sql_dim_product_category(),
    "m16_audit_masked_transactions": O.sql_audit_masked(),
    "m17_prod_masked_transactions": O.sql_prod_masked(),
    "m18_analytics_view": O.sql_analytics_view(),
    "p1_p3_masked_contacts": O.sql_masked_contacts(),
    "p7_rule_masking": O.sql_rule_masking(),
    "o1_freshness_record": O.sql_freshness_record(),
    "o1_freshness_changes_stream": O.sql_freshness_changes(),
    "o5_file_schema_drift": O.sql_file_schema_drift(),
    "o7_lineage_closure": O.sql_lineage_closure(),
    "o7_lineage_impact": O.sql_lineage_impact(),
    "m12_freshness_dashboard": O.sql_freshness_dashboard(),
    "m13_quality_dashboard": O.sql_quality_dashboard(),
    "p8_p11_shred_readback": O.sql_shred_readback(),
    "p11_key_store_rotation": O.sql_shred_readback(),
    "p12_deletion_status": O.sql_deletion_status(),
    "m9_dim_users_rfm": O.sql_rfm(),
    "q12_model_tests_dim_users": O.model_tests_sql("dim_users", Q.DIM_USERS_TESTS, O.rfm_ctes(), "dim_users"),
    "q12_model_tests_enriched": O.model_tests_sql("int_transactions_enriched", Q.ENRICHED_TESTS,
                                                  O.enriched_ctes(), "enriched"),
    "a6_load_quarantine_counts": O.sql_load_quarantine_counts(),
    "s4_top_users_by_lifetime_value": O.sql_top_users(),
    "s4_newest_facts": O.sql_newest_facts(),
    "q15_constraint_violations": O.sql_constraint_violations(),
}
