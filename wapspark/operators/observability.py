"""Freshness, dashboards, schema drift, lineage, metrics, PII catalogue
(O1–O8, M12–M15, P13, A14)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wapspark.functions.scalar import as_of_lit, micros_between, minutes_since
from wapspark.operators.joins import materialize

# Fixed thresholds of the freshness classes.
FRESH_HOURS, STALE_HOURS = 2, 6


def _freshness_status(last: Column, as_of: Column) -> Column:
    return (F.when(last > as_of - F.expr(f"INTERVAL {FRESH_HOURS} HOURS"), "FRESH")
             .when(last > as_of - F.expr(f"INTERVAL {STALE_HOURS} HOURS"), "STALE")
             .otherwise("MISSING"))


def freshness_record(df: DataFrame, table_col: str, ts_col: str,
                     as_of: dt.datetime | None = None, lookback_hours: int = 24,
                     threshold_minutes: int = FRESH_HOURS * 60) -> DataFrame:
    """O1: one monitor row per table: newest arrival within the look-back
    window, lag in seconds, class (FRESH < 2 h, STALE < 6 h, else MISSING).
    Tables with nothing in the window still appear (MISSING)."""
    now = as_of_lit(as_of)
    ts = F.col(ts_col)
    in_window = (ts > now - F.expr(f"INTERVAL {lookback_hours} HOURS")) & (ts <= now)
    last = F.max(F.when(in_window, ts))
    agg = df.groupBy(F.col(table_col).alias("table_name")).agg(last.alias("actual_arrival_time"))
    a = F.col("actual_arrival_time")
    return agg.select(
        "table_name", a,
        micros_between(a, now).alias("_lag_us"),
        _freshness_status(a, now).alias("status"),
        now.alias("check_timestamp"),
        F.lit(threshold_minutes).alias("threshold_minutes"),
    ).withColumn("freshness_lag_seconds", F.col("_lag_us") / F.lit(1e6)).drop("_lag_us")


def freshness_dashboard(monitor: DataFrame, as_of=None) -> DataFrame:
    """Per table, latest arrival, minutes since, class (NULL → MISSING).

    ``as_of`` is one instant or a list of instants (one output row per table
    and instant, with an ``as_of`` column); the aggregate runs once and the
    instants are applied to its per-table rows."""
    last = monitor.groupBy("table_name").agg(F.max("actual_arrival_time").alias("last_data_arrival"))
    if isinstance(as_of, (list, tuple)):
        last = last.withColumn("as_of", F.explode(F.array(*[as_of_lit(t) for t in as_of])))
        now, extra = F.col("as_of"), ["as_of"]
    else:
        now, extra = (as_of if isinstance(as_of, Column) else as_of_lit(as_of)), []
    return last.select(
        "table_name", *extra, "last_data_arrival",
        minutes_since(now, F.col("last_data_arrival")).alias("minutes_since_last_update"),
        _freshness_status(F.col("last_data_arrival"), now).alias("freshness_status"))


def quality_dashboard(audit: DataFrame, ordered: bool = True) -> DataFrame:
    """Daily counts of negative / NULL amounts and NULL users, and
    the share of valid amounts (``ROUND(100.0·n / NULLIF(total, 0), 2)``,
    decimal-exact). One row per ingestion day; newest first."""
    a = F.col("amount")
    out = audit.groupBy(F.to_date("ingested_at").alias("fecha")).agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_if(a < 0).alias("registros_monto_negativo"),
        F.count_if(a.isNull()).alias("registros_monto_nulo"),
        F.count_if(F.col("user_id").isNull()).alias("registros_user_nulo"),
        F.count_if((a >= 0) & a.isNotNull()).alias("_ok"))
    pct = F.round(F.lit(100).cast("decimal(4,1)") * F.col("_ok")
                  / F.nullif(F.col("total_registros"), F.lit(0)), 2)
    out = out.select("fecha", "total_registros", "registros_monto_negativo",
                     "registros_monto_nulo", "registros_user_nulo",
                     pct.alias("porcentaje_calidad"))
    return out.orderBy(F.col("fecha").desc()) if ordered else out


# --- pipeline metrics (O4) ---------------------------------------------------

def observed_write(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet",
                   partition_by: list[str] | None = None) -> dict:
    """Write ``df`` and count rows / NULL users / negative amounts during the
    same job (``Observation``), without a second pass."""
    obs = Observation("write_metrics")
    cols = set(df.columns)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if "user_id" in cols:
        metrics.append(F.count_if(F.col("user_id").isNull()).alias("null_users"))
    if "amount" in cols:
        metrics.append(F.count_if(F.col("amount") < 0).alias("negative_amounts"))
    w = df.observe(obs, *metrics).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return dict(obs.get)


def pipeline_metric_rows(spark: SparkSession, task_name: str, metrics: dict,
                         execution_date: dt.datetime, metadata: dict | None = None) -> DataFrame:
    """Rows for the pipeline-metrics log (one per named value)."""
    import json
    meta = json.dumps(metadata or {}, sort_keys=True)
    rows = [(execution_date, task_name, k, float(v), "count", meta) for k, v in sorted(metrics.items())]
    return spark.createDataFrame(rows, "execution_date timestamp_ntz, task_name string, "
                                       "metric_name string, metric_value double, "
                                       "metric_type string, metadata string")


# --- schema catalogue and drift (A14, O5) ----------------------------------

SNAPSHOT_SCHEMA = ("schema_name string, table_name string, column_name string, "
                   "data_type string, is_nullable boolean, ordinal long, check_timestamp timestamp_ntz")


def schema_snapshot(spark: SparkSession, tables: dict[tuple[str, str], T.StructType | DataFrame],
                    check_timestamp: dt.datetime) -> DataFrame:
    """One row per column of each table (order kept). Input is table
    metadata (``df.schema``), not data."""
    rows = []
    for (schema_name, table_name), s in tables.items():
        st = s.schema if isinstance(s, DataFrame) else s
        for i, f in enumerate(st.fields):
            rows.append((schema_name, table_name, f.name, f.dataType.simpleString(),
                         f.nullable, i, check_timestamp))
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def detect_schema_drift(current: DataFrame, history: DataFrame | None) -> DataFrame:
    """Compare the current snapshot with the latest stored snapshot of
    each table: new columns, removed columns, type changes, drift flag. A
    table without history has no drift. Nullability is recorded, not compared.
    Runs for every table at once; the latest snapshot per table is a
    ``max`` aggregate joined back, not a per-table query."""
    key = ["schema_name", "table_name"]
    cur = current.select(*key, "column_name", F.col("data_type").alias("cur_type"))
    if history is None:
        prev = cur.limit(0).select(*key, "column_name", F.col("cur_type").alias("prev_type"))
        known = prev.select(*key).distinct()
    else:
        latest = history.groupBy(*key).agg(F.max("check_timestamp").alias("check_timestamp"))
        prev = (history.join(latest, key + ["check_timestamp"])
                       .select(*key, "column_name", F.col("data_type").alias("prev_type")))
        known = latest.select(*key)
    both = cur.join(prev, key + ["column_name"], "full_outer")
    per_table = both.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.when(F.col("prev_type").isNull(), F.col("column_name"))))
         .alias("new_columns"),
        F.array_sort(F.collect_list(F.when(F.col("cur_type").isNull(), F.col("column_name"))))
         .alias("removed_columns"),
        F.array_sort(F.collect_list(F.when(
            F.col("cur_type").isNotNull() & F.col("prev_type").isNotNull()
            & (F.col("cur_type") != F.col("prev_type")),
            F.struct(F.col("column_name").alias("column"), F.col("prev_type").alias("old"),
                     F.col("cur_type").alias("new"))))).alias("type_changes"))
    # Tables seen for the first time: no drift.
    flagged = per_table.join(known.withColumn("_seen", F.lit(True)), key, "left")
    seen = F.coalesce(F.col("_seen"), F.lit(False))
    empty_s = F.array().cast("array<string>")
    return flagged.select(
        *key,
        F.when(seen, F.col("new_columns")).otherwise(empty_s).alias("new_columns"),
        F.when(seen, F.col("removed_columns")).otherwise(empty_s).alias("removed_columns"),
        F.when(seen, F.col("type_changes")).otherwise(F.array().cast(
            "array<struct<column:string,old:string,new:string>>")).alias("type_changes"),
    ).withColumn("drift_detected",
                 (F.size("new_columns") + F.size("removed_columns") + F.size("type_changes")) > 0)


# --- lineage (O6, O7, M14) ----------------------------------------------------

LINEAGE_SCHEMA = ("lineage_type string, node_id string, node_name string, node_type string, "
                  "schema_name string, table_name string, description string, source_id string, "
                  "target_id string, transformation string, dag_execution_id string, "
                  "created_at timestamp_ntz")


def lineage_records(spark: SparkSession, nodes: list[dict], edges: list[dict], run_id: str,
                    created_at: dt.datetime) -> DataFrame:
    """Node and edge rows of one run (small, run metadata)."""
    rows = [("node", n["node_id"], n.get("node_name"), n.get("node_type"), n.get("schema_name"),
             n.get("table_name"), n.get("description"), None, None, None, run_id, created_at)
            for n in nodes]
    rows += [("edge", None, None, None, None, None, None, e["source_id"], e["target_id"],
              e.get("transformation"), run_id, created_at) for e in edges]
    return spark.createDataFrame(rows, LINEAGE_SCHEMA)


def lineage_view(lineage: DataFrame) -> DataFrame:
    """Edge ⋈ source node ⋈ target node (inner: edges to unknown
    nodes drop)."""
    e = lineage.filter(F.col("lineage_type") == "edge").alias("e")
    n1 = lineage.filter(F.col("node_id").isNotNull()).alias("n1")
    n2 = lineage.filter(F.col("node_id").isNotNull()).alias("n2")
    return (e.join(n1, F.col("e.source_id") == F.col("n1.node_id"))
             .join(n2, F.col("e.target_id") == F.col("n2.node_id"))
             .select(F.col("n1.node_name").alias("source"), F.col("e.transformation"),
                     F.col("n2.node_name").alias("target"),
                     F.col("n1.node_type").alias("source_type"),
                     F.col("n2.node_type").alias("target_type")))


def lineage_closure(edges: DataFrame, source: str = "source_id", target: str = "target_id",
                    max_hops: int | None = None) -> DataFrame:
    """O7 over all hops: every node that ``node`` feeds, directly or not
    (``reaches``), with the least number of ``hops``. Upstream impact is the
    same frame read the other way round.

    A fixpoint by doubling. Once all pairs of up to k hops are known, a shortest
    path of k + 1 to 2k hops is one of k hops and one of the known: only the pairs
    of exactly k hops are joined, each with what its end reaches, so along a chain
    or a cycle a pair is found once. What is known never changes; each round
    writes the pairs that it adds. It ends when no pair has k hops or none is new,
    after as many rounds as the logarithm of the longest shortest path. A node on
    a cycle reaches itself. ``max_hops`` stops at so many hops. NULL ends are no
    edges."""
    known = edges.select(F.col(source).alias("node"), F.col(target).alias("reaches")).dropna().distinct()
    known = materialize(known.withColumn("hops", F.lit(1).cast("long")), "closure")
    if max_hops is not None and max_hops < 1:
        return known.limit(0)
    k = 1
    while max_hops is None or k < max_hops:
        front = known.filter(F.col("hops") == k)
        if front.isEmpty():
            break
        found = front.alias("a").join(known.alias("b"), F.col("a.reaches") == F.col("b.node")).select(
            F.col("a.node"), F.col("b.reaches"), (F.col("a.hops") + F.col("b.hops")).alias("hops"))
        if max_hops is not None:
            found = found.filter(F.col("hops") <= max_hops)
        # Met by grouping: a pair that is known has fewer hops than any found.
        new = found.unionByName(known).groupBy("node", "reaches").agg(
            F.min("hops").alias("hops")).filter(F.col("hops") > k)
        new = materialize(new, "closure")
        if new.isEmpty():
            break
        known, k = known.unionByName(new), 2 * k
    return known


# --- PII catalogue (P13, M15) -------------------------------------------------

PII_SCHEMA = ("schema_name string, table_name string, column_name string, pii_category string, "
              "pii_sensitivity string, protection_method string, access_restriction string, "
              "retention_days int, legal_basis string")


def tag_pii(df: DataFrame, column: str, **tags) -> DataFrame:
    """Attach PII tags to a column's metadata (category, sensitivity, …)."""
    return df.withMetadata(column, {"pii": True, **tags})


def pii_catalog_from_schema(spark: SparkSession, tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Catalogue rows from column metadata tags."""
    rows = []
    for (schema_name, table_name), df in tables.items():
        for f in df.schema.fields:
            m = f.metadata or {}
            if m.get("pii"):
                rows.append((schema_name, table_name, f.name, m.get("pii_category"),
                             m.get("pii_sensitivity"), m.get("protection_method"),
                             m.get("access_restriction"), m.get("retention_days"),
                             m.get("legal_basis")))
    return spark.createDataFrame(rows, PII_SCHEMA)


# The catalogue's initial entries (user ids in the quarantine,
# published and staging tables).
PII_SEED = [
    ("audit", "raw_transactions", "user_id", "direct_identifier", "high", "hash_salting",
     "production_only", 365, "Consentimiento del usuario - LDPD Art. 8"),
    ("prod", "raw_transactions", "user_id", "direct_identifier", "high", "hash_salting",
     "production_only", 365, "Consentimiento del usuario - LDPD Art. 8"),
    ("staging", "stg_raw_transactions", "user_id", "direct_identifier", "high", "hash_salting",
     "production_only", 365, "Consentimiento del usuario - LDPD Art. 8"),
]


def pii_catalog_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PII_SEED, PII_SCHEMA)


def register_pii(catalog: DataFrame, new: DataFrame) -> DataFrame:
    """Insert-if-absent on (schema, table, column); returns the union."""
    keys = ["schema_name", "table_name", "column_name"]
    fresh = new.dropDuplicates(keys).join(catalog.select(*keys), keys, "left_anti")
    return catalog.unionByName(fresh)


# Fixed value: severity order for the optional severity sort of the view.
SENSITIVITY_ORDER = ["critical", "high", "medium", "low"]


def pii_catalog_view(catalog: DataFrame, by_severity: bool = False) -> DataFrame:
    """Catalogue view. The SQL view orders sensitivity DESC *lexically*
    (medium, low, high, critical); ``by_severity=True`` orders by severity."""
    out = catalog.select(
        F.concat_ws(".", "schema_name", "table_name").alias("full_table"), "column_name",
        "pii_category", "pii_sensitivity", "protection_method", "access_restriction",
        "retention_days", "legal_basis", "schema_name", "table_name")
    if by_severity:
        rank = F.array_position(F.array(*[F.lit(s) for s in SENSITIVITY_ORDER]), F.col("pii_sensitivity"))
        out = out.orderBy(rank.asc(), "schema_name", "table_name")
    else:
        out = out.orderBy(F.col("pii_sensitivity").desc(), "schema_name", "table_name")
    return out.drop("schema_name", "table_name")
