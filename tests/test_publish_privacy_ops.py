"""Publish idempotence, repair, dedup, shredding round trip, drift, lineage,
catalogue, freshness classes, bronze load."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from wapspark.operators import observability as O
from wapspark.operators import publish, shredding
from wapspark.sources import bronze, sinks

AUDIT = ("transaction_id string, user_id int, product_category string, amount decimal(10,2), "
         "currency string, transaction_date timestamp_ntz, status string, ingested_at timestamp_ntz, "
         "source_file string, gx_validation_status string, gx_validation_errors string")
T0 = dt.datetime(2024, 1, 1)


def audit_rows(spark):
    rows = [("a", 1, "c", Decimal("5.00"), "USD", T0, "COMPLETED", T0, "f", "PENDING", None),
            ("a", 1, "c", Decimal("5.00"), "USD", T0, "COMPLETED", T0, "f", "PENDING", None),
            ("b", None, "c", Decimal("5.00"), "USD", T0, "COMPLETED", T0, "f", "PENDING", None),
            ("c", 2, "c", Decimal("-3.00"), "USD", T0, "COMPLETED", T0, "f", "PENDING", None),
            ("d", 3, "c", None, "USD", T0, "PENDING", T0, "f", "PENDING", None)]
    return spark.createDataFrame(rows, AUDIT)


def test_repair(spark):
    out = {r.transaction_id: r for r in publish.repair(audit_rows(spark)).collect()}
    assert out["b"].user_id == 0 and out["c"].amount == Decimal("0.00") and out["d"].amount is None


def test_publish_twice_is_once(spark):
    base = tempfile.mkdtemp(prefix="wap-prod-")
    prod_path = f"{base}/prod"
    audit = audit_rows(spark)
    empty = spark.createDataFrame([], audit.schema).withColumns(
        {"processed_at": F.lit(None).cast("timestamp_ntz"),
         "data_quality_score": F.lit(None).cast("decimal(3,2)")})
    first = publish.publish_incremental(audit, empty, as_of=T0)
    sinks.append(first, prod_path)
    assert spark.read.parquet(prod_path).count() == 1  # only "a", once
    second = publish.publish_incremental(audit, spark.read.parquet(prod_path), as_of=T0)
    assert second.count() == 0


def test_dedup_keeps_newest(spark):
    df = spark.createDataFrame([("a", 1, T0), ("a", 2, T0 + dt.timedelta(days=1)), ("b", 3, T0)],
                               "transaction_id string, v int, ingested_at timestamp_ntz")
    out = {r.transaction_id: r.v for r in publish.dedup_latest(df).collect()}
    assert out == {"a": 2, "b": 3}


def test_reconciliation(spark):
    audit = audit_rows(spark)
    r = publish.reconciliation(audit, publish.publish_clean(audit)).first()
    assert (r.total_audit, r.total_prod, r.registros_filtrados) == (5, 3, 2)


def test_shredding_round_trip(spark):
    users = spark.createDataFrame([(1, "Ana"), (2, "Luis"), (3, "Eva")], "user_id int, name string")
    keys = shredding.issue_keys(users, as_of=T0)
    keys = spark.createDataFrame(keys.collect(), keys.schema)  # random keys: materialise once
    assert all(len(k.encryption_key) == 32 for k in keys.collect())
    enc, missing = shredding.encrypt_column(users, "user_id", "name", keys)
    assert missing.count() == 0
    enc = spark.createDataFrame(enc.collect(), enc.schema)
    back = {r.user_id: r.name for r in shredding.decrypt_column(enc, "user_id", "ciphertext", keys, "name").collect()}
    assert back == {1: "Ana", 2: "Luis", 3: "Eva"}
    req = spark.createDataFrame([(2, "gdpr"), (9, None)], "user_id int, reason string")
    next_keys, done = shredding.process_deletions(req, keys, as_of=T0)
    back = {r.user_id: r.name for r in shredding.decrypt_column(enc, "user_id", "ciphertext", next_keys, "name").collect()}
    assert back == {1: "Ana", 2: None, 3: "Eva"}
    revoked = next_keys.filter("user_id = 2").first()
    assert revoked.encryption_key is None and revoked.revoke_reason == "gdpr" and not revoked.is_active
    assert done.count() == 2 and {r.status for r in done.collect()} == {"completed"}
    status = {r.user_id: r for r in shredding.deletion_status(
        spark.createDataFrame([(1,), (2,), (9,)], "user_id int"), next_keys, done).collect()}
    assert status[9].found is False and status[2].deletion_status == "completed"
    assert status[1].key_active is True and status[1].deletion_status is None
    # keyless users are reported, not silently encrypted
    _, missing = shredding.encrypt_column(spark.createDataFrame([(7, "x")], "user_id int, name string"),
                                          "user_id", "name", next_keys)
    assert missing.count() == 1
    # re-issuing gives revoked users a new version
    again = shredding.issue_keys(users, next_keys, as_of=T0, test_seed="k")
    assert [(r.user_id, r.key_version) for r in again.collect()] == [(2, 2)]


def test_schema_drift(spark):
    t1 = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([], "x int, y string, z double")
    b = spark.createDataFrame([], "x long, y string, w int")
    snap1 = O.schema_snapshot(spark, {("prod", "t"): a}, t1)
    first = O.detect_schema_drift(snap1, None).first()
    assert first.drift_detected is False
    snap2 = O.schema_snapshot(spark, {("prod", "t"): b, ("prod", "new"): a}, t1 + dt.timedelta(days=1))
    res = {r.table_name: r for r in O.detect_schema_drift(snap2, snap1).collect()}
    assert res["t"].new_columns == ["w"] and res["t"].removed_columns == ["z"]
    assert [(c.column, c.old, c.new) for c in res["t"].type_changes] == [("x", "int", "bigint")]
    assert res["t"].drift_detected and res["new"].drift_detected is False


def test_lineage_view(spark):
    nodes = [{"node_id": f"n{i}", "node_name": f"t{i}", "node_type": "table"} for i in range(4)]
    edges = [{"source_id": "n0", "target_id": "n1", "transformation": "load"},
             {"source_id": "n1", "target_id": "n2", "transformation": "spark"},
             {"source_id": "n2", "target_id": "missing", "transformation": "dbt"}]
    lin = O.lineage_records(spark, nodes, edges, "run1", T0)
    out = sorted(tuple(r) for r in O.lineage_view(lin).collect())
    assert out == [("t0", "load", "t1", "table", "table"), ("t1", "spark", "t2", "table", "table")]


def test_pii_catalog(spark):
    df = spark.createDataFrame([], "user_id int, email string")
    df = O.tag_pii(df, "user_id", pii_category="direct_identifier", pii_sensitivity="high",
                   protection_method="hash_salting", access_restriction="production_only",
                   retention_days=365, legal_basis="consent")
    df = O.tag_pii(df, "email", pii_category="contact", pii_sensitivity="medium")
    cat = O.pii_catalog_from_schema(spark, {("prod", "t"): df, ("audit", "t"): df})
    cat = O.register_pii(cat, cat)  # insert-if-absent: no duplicates
    assert cat.count() == 4
    view = O.pii_catalog_view(cat).collect()
    assert [r.pii_sensitivity for r in view] == ["medium", "medium", "high", "high"]  # lexical DESC
    assert [r.pii_sensitivity for r in O.pii_catalog_view(cat, by_severity=True).collect()][:2] == ["high", "high"]


def test_freshness_classes(spark):
    now = dt.datetime(2024, 1, 31)
    mon = spark.createDataFrame([("a", now - dt.timedelta(hours=1)), ("b", now - dt.timedelta(hours=3)),
                                 ("c", now - dt.timedelta(hours=30))], "table_name string, actual_arrival_time timestamp_ntz")
    out = {r.table_name: r.freshness_status for r in O.freshness_dashboard(mon, now).collect()}
    assert out == {"a": "FRESH", "b": "STALE", "c": "MISSING"}
    rec = {r.table_name: r.status for r in O.freshness_record(
        mon, "table_name", "actual_arrival_time", as_of=now).collect()}
    assert rec == {"a": "FRESH", "b": "STALE", "c": "MISSING"}


def test_observed_write(spark):
    path = tempfile.mkdtemp(prefix="wap-obs-") + "/t"
    m = O.observed_write(audit_rows(spark), path)
    assert m["rows"] == 5 and m["null_users"] == 1 and m["negative_amounts"] == 1
    rows = O.pipeline_metric_rows(spark, "load", m, T0, {"pages": 1})
    assert rows.count() == 3


def test_bronze_load(spark):
    base = tempfile.mkdtemp(prefix="wap-bronze-")
    os.makedirs(f"{base}/src")
    with open(f"{base}/src/a.json", "w") as fh:
        fh.write('{"id": "t1", "user_id": 1, "amount": "1.00"}\n\n{"id": "t1", "user_id": 1, "amount": "1.00"}\n'
                 '{"user_id": 2, "amount": "2.00"}\n{"id": "t3", "user_id": 3, "amount": "99999999999"}\n'
                 '{"id": "t4", "user_id": "x", "amount": "1"}\nnot json\n')
    raw = bronze.read_bronze(spark, f"{base}/src", newest_only=True)
    acc, rej = bronze.load_to_quarantine(bronze.to_quarantine_rows(raw, as_of=T0))
    assert acc.count() == 2  # t1 once, the id-less row with a fresh UUID
    reasons = sorted(",".join(r.reject_reasons) for r in rej.collect())
    assert reasons == ["bad_amount", "bad_user_id", "duplicate_key", "malformed_record"]
    c = bronze.load_counts(acc, rej).first()
    assert (c.inserted, c.discarded) == (2, 4)


def test_pii_seed_insert_if_absent(spark):
    seed = O.pii_catalog_seed(spark)
    again = O.register_pii(seed, seed.unionByName(seed))
    assert again.count() == 3
    assert {r.full_table for r in O.pii_catalog_view(again).collect()} == {
        "audit.raw_transactions", "prod.raw_transactions", "staging.stg_raw_transactions"}


def test_stddev_of_one_row_is_null(spark):
    from wapspark.plans.marts import user_metrics
    df = spark.createDataFrame([(1, Decimal("5.00"), T0, "a"), (2, Decimal("1.00"), T0, "a"),
                                (2, Decimal("3.00"), T0, "b")],
                               "user_id int, amount decimal(10,2), transaction_date timestamp_ntz, "
                               "product_category string")
    out = {r.user_id: r for r in user_metrics(df).collect()}
    assert out[1].stddev_transaction_amount is None
    assert out[2].stddev_transaction_amount == pytest.approx(1.4142135623730951)
    assert out[2].unique_categories == 2 and out[2].active_days == 1


def test_key_table_versions(spark):
    base = tempfile.mkdtemp(prefix="wap-keys-") + "/keys"
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    keys = shredding.issue_keys(users, as_of=T0, test_seed="k")
    shredding.write_keys_version(keys, base, 1)
    current = shredding.read_current_keys(spark, base)
    nxt, _ = shredding.process_deletions(spark.createDataFrame([(1,)], "user_id int"), current, as_of=T0)
    shredding.write_keys_version(nxt, base, 2)
    now = {r.user_id: r.is_active for r in shredding.read_current_keys(spark, base).collect()}
    assert now == {1: False, 2: True}
    # the version before is gone with the key it still held
    assert {r.version for r in spark.read.parquet(base).select("version").collect()} == {2}


def test_newest_extract_only(spark):
    import time
    base = tempfile.mkdtemp(prefix="wap-land-") + "/bronze"
    first = spark.createDataFrame([(f"a{i}", i, "1.00", T0) for i in range(50)],
                                  "id string, user_id int, amount string, ts timestamp_ntz").repartition(4)
    second = spark.createDataFrame([(f"b{i}", i, "2.00", T0) for i in range(30)],
                                   "id string, user_id int, amount string, ts timestamp_ntz").repartition(3)
    assert sinks.land_bronze(first, base, "ts", extract_id="e1")
    time.sleep(1.1)
    assert sinks.land_bronze(second, base, "ts", extract_id="e2")
    assert not sinks.land_bronze(second.limit(0), base, "ts")  # empty extract: nothing written
    newest = bronze.read_bronze(spark, base, newest_only=True)
    assert sorted(r.id for r in newest.collect()) == sorted(f"b{i}" for i in range(30))
    assert bronze.read_bronze(spark, base).count() == 80


def test_rows_without_a_key_are_no_copies(spark):
    from wapspark.operators.publish import dedup_latest
    df = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), ("k", 1, "a"), ("k", 2, "b")],
                               "transaction_id string, ingested_at int, v string")
    got = sorted(map(str, dedup_latest(df).collect()))
    want = spark.createDataFrame([(None, 1, "a"), (None, 1, "a"), ("k", 2, "b")], df.schema).collect()
    assert got == sorted(map(str, want))


def test_deletion_leaves_no_key_bytes(spark, tmp_path):
    import glob
    from wapspark.operators import shredding
    base = str(tmp_path / "keys")
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id int")
    issued = shredding.issue_keys(users, as_of=T0)
    scratch = {f.rsplit("/", 1)[0].replace("file://", "") for f in issued.inputFiles()}
    shredding.write_keys_version(issued, base, 1)
    keys = shredding.read_current_keys(spark, base)
    secret = {r.user_id: bytes(r.encryption_key) for r in keys.collect()}
    later, _ = shredding.process_deletions(spark.createDataFrame([(2,)], "user_id int"), keys, as_of=T0)
    shredding.write_keys_version(later, base, 2)
    files = [f for d in (*scratch, base) for f in glob.glob(f"{d}/**", recursive=True)]
    held = b"".join(open(f, "rb").read() for f in files if os.path.isfile(f))
    assert secret[2] not in held and secret[1] in held
    # a version without its marker isn't read
    os.makedirs(f"{base}/version=9")
    assert {r.user_id for r in shredding.read_current_keys(spark, base).filter("is_active").collect()} == {1, 3}


def test_random_keys_need_no_package_on_workers():
    import inspect
    from wapspark.operators import shredding
    assert "def draw(" in inspect.getsource(shredding.issue_keys)
