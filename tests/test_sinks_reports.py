"""Sinks and report helpers."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from wapspark.functions.scalar import as_of_lit
from wapspark.operators import reports
from wapspark.sources import sinks


def test_overwrite_replaces_whole_or_not_at_all(spark):
    path = tempfile.mkdtemp(prefix="wap-sink-") + "/t"
    spark.range(5).write.parquet(path)
    df = spark.read.parquet(path)
    # a job that fails leaves the table as it was
    with pytest.raises(Exception):
        sinks.overwrite(df.select(F.raise_error(F.lit("stop")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    # a frame may read the table that it replaces, and a table beside it
    sinks.overwrite(df.filter("id > 1"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3, 4]
    sinks.overwrite(spark.read.parquet(path), path + "_more")
    assert spark.read.parquet(path + "_more").count() == 3
    df = spark.range(5)
    other = tempfile.mkdtemp(prefix="wap-sink-") + "/u"
    sinks.overwrite(df.withColumn("p", F.col("id") % 2), other, partition_by=["p"])
    sinks.overwrite(spark.range(10, 12).withColumn("p", F.lit(0)), other, partition_by=["p"])
    back = sorted(r.id for r in spark.read.parquet(other).collect())
    assert back == [1, 3, 10, 11]  # only partition p=0 was replaced


def test_insert_if_absent(spark):
    path = tempfile.mkdtemp(prefix="wap-sink-") + "/t"
    existing = spark.createDataFrame([(1, "a")], "k int, v string")
    existing.write.parquet(path)
    new = spark.createDataFrame([(1, "x"), (2, "b"), (2, "b")], "k int, v string")
    added = sinks.insert_if_absent(new, spark.read.parquet(path), ["k"], path)
    assert [tuple(r) for r in added.collect()] == [(2, "b")]
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]


def test_last_days_and_preview(spark):
    now = dt.datetime(2024, 1, 31)
    df = spark.createDataFrame([(now - dt.timedelta(days=d),) for d in range(0, 10)], "d timestamp_ntz")
    assert reports.last_days(df, "d", as_of_lit(now), 7).count() == 7
    assert reports.preview(df, 5).count() == 5
    top = reports.top_k(df, [F.col("d").desc()], 3).collect()
    assert [r.d for r in top] == [now, now - dt.timedelta(days=1), now - dt.timedelta(days=2)]
