"""Wide steps that go part by part, and leave no shuffle files or stages behind."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from wapspark.operators.incremental import MetricState
from wapspark.operators.joins import discard, materialize, stored_part
from wapspark.plans import marts, registry
from wapspark.session import pinned, scratch_path
from wapspark.sources import sinks
from wapspark.sources.tables import transactions
from wapspark.streaming.bronze_stream import ingest_bronze_stream


def shuffle_files(spark) -> set:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders of one hot customer, of others and of none; keys that come twice."""
    base, day = str(tmp_path_factory.mktemp("tables")), dt.datetime(1995, 3, 1)
    orders = [(k if k % 11 else 1, None if k % 7 == 0 else 5 if k % 3 == 0 else k % 13, day) for k in range(1, 121)]
    lines = [(k if k % 17 else None, k % 4 + 1, k % 9, n, float(k % 50), 100.0 * n + k, 0.05, "ANR"[(k + n) % 3],
              day + dt.timedelta(days=k % 20)) for k in range(1, 121) for n in (1, 2, 7)]
    made = {
        "part": ([(k, f"TYPE {k}") for k in range(1, 6)], "p_partkey long, p_type string"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                            "l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz")}
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{base}/{name}.parquet")
    return base


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


def test_a_stored_stage_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    out = materialize(spark.range(5000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "stage")
    kept = pinned(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count())
    assert shuffle_files(spark) <= before
    assert out.count() == 7 and kept.count() == 7 and kept.agg(F.sum("count")).first()[0] == 5000


def test_shares_are_the_table(spark, tables):
    for variant in ("prod", "dup"):
        shares = [transactions(spark, tables, variant, share=(k, 2)) for k in range(2)]
        assert shares[0].count()
        same(transactions(spark, tables, variant), shares[0].unionByName(shares[1]))


def test_the_model_by_parts_equals_the_model(spark, tables):
    def rounded(df):  # a sum of doubles in any order
        return df.withColumn("user_stddev_transaction_amount", F.round("user_stddev_transaction_amount", 4))
    whole = marts.int_transactions_enriched(registry._stg(spark, tables))
    got = marts.int_transactions_enriched(registry._stg_shares(spark, tables, 2), parts=3)
    assert got.columns == whole.columns and got.filter("user_id is null").count() > 0
    same(rounded(whole), rounded(got))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # the last join is done, part by part


def test_a_part_is_read_and_dropped_by_itself(spark):
    df = materialize([spark.range(10).selectExpr("id", "cast(id % 3 as int) as p"),
                      spark.range(10, 20).selectExpr("id", "cast(id % 3 as int) as p")], "parts", by="p")
    assert df.count() == 20 and sorted(r.id for r in stored_part(df, 1).collect()) == list(range(1, 20, 3))
    at = df._stored_at.removeprefix("file:")
    assert os.path.isdir(f"{at}/p=1")
    discard(df, 1)
    assert not os.path.exists(f"{at}/p=1") and stored_part(df, 2).count() == 6
    discard(df)
    assert not os.path.exists(at)
    assert materialize([spark.range(0).selectExpr("id", "0 as p")], "none", by="p").count() == 0


def test_queries_take_parts_by_the_size_of_their_table(spark, tables, monkeypatch):
    assert registry._steps(spark, tables) == 1
    monkeypatch.setattr(registry, "STEP_BYTES", 1000)
    assert 1 < registry._steps(spark, tables) <= registry.MOST_STEPS


def scratch(spark) -> set:
    at = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    return set(os.listdir(at))


def test_a_change_of_the_metrics_leaves_no_scratch_behind(spark, tmp_path):
    rows = spark.createDataFrame(
        [(k % 5 or None, dt.datetime(1995, 1, 1 + k % 3), "ab"[k % 2], Decimal(k), "COMPLETED") for k in range(40)],
        "user_id int, transaction_day timestamp_ntz, product_category string, amount decimal(10,2), status string")
    state = MetricState(spark, str(tmp_path / "state"), buckets=2)
    before, shuffled = scratch(spark), shuffle_files(spark)
    assert state.apply(rows, "first") and scratch(spark) == before
    assert shuffle_files(spark) <= shuffled
    with pytest.raises(ValueError, match="takes back rows"):
        state.apply(rows.withColumns({"amount": (F.col("amount") + 1000).cast("decimal(10,2)"),
                                      "sign": F.lit(-1)}), "second", "sign")
    assert scratch(spark) == before
    assert {(r.user_id, r.total_transactions) for r in state.users().collect()} == {(u, 8) for u in (None, 1, 2, 3, 4)}


def test_the_stream_stores_a_batch_compressed_and_drops_it(spark, tmp_path):
    paths = [str(tmp_path / d) for d in ("bronze", "accepted", "rejected", "state")]
    before = scratch(spark)
    for extract, ids in enumerate((["a", "a", "b", ""], ["b", "c", "0"])):
        df = spark.createDataFrame([(i, str(n), "1.50", dt.datetime(2020, 1, 1)) for n, i in enumerate(ids)],
                                   "id string, user_id string, amount string, landed_at timestamp")
        assert sinks.land_bronze(df, paths[0], "landed_at", extract_id=str(extract), compression="gzip")
        run = ingest_bronze_stream(spark, *paths, as_of=dt.datetime(2020, 1, 2))
        run.awaitTermination()
        assert run.exception() is None
    assert scratch(spark) == before
    assert all(f.endswith(".json.gz") for _, _, fs in os.walk(paths[0]) for f in fs if f.startswith("part-"))
    accepted, rejected = spark.read.parquet(paths[1]), spark.read.parquet(paths[2])
    assert sorted(r.transaction_id for r in accepted.filter("length(transaction_id) = 1").collect()) == ["a", "b", "c"]
    assert accepted.count() == 5 and accepted.select("transaction_id").distinct().count() == 5
    assert [(r.transaction_id, r.reject_reasons) for r in rejected.orderBy("transaction_id").collect()] == [
        ("a", "duplicate_key"), ("b", "duplicate_key")]
