"""wapspark: write–audit–publish analytics on Spark.

Main entry points:

* ``sources.tables.transactions`` — the transactions table from the driver's data
* ``plans.staging`` / ``plans.marts`` / ``plans.views`` — the models
* ``operators.quality`` — rule suites, gate, verdicts, model tests
* ``operators.publish`` — repair, publish, dedup, reconciliation
* ``operators.shredding`` — per-user keys and deletion
* ``operators.observability`` — freshness, dashboards, drift, lineage, catalogue
* ``operators.ranking`` — exact distributed NTILE / percentile_cont
* ``plans.pipeline.run_pipeline`` — the whole run
* ``streaming.bronze_stream.ingest_bronze_stream`` — incremental ingest
"""

from wapspark.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
