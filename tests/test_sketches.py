"""Merged daily sketches against exact answers, in estimation mode too."""

import datetime as dt
import random

from pyspark.sql import functions as F

from wapspark.operators import sketches as S


def rows_of(spark, seed, n, users, days=30):
    day = F.expr(f"date_add(date'2024-01-01', cast(pmod(hash(id, {seed}), {days}) as int))")
    return spark.range(n).select(
        day.cast("timestamp_ntz").alias("transaction_day"),
        F.pmod(F.hash("id", F.lit(seed + 1)), F.lit(users)).alias("user_id"),
        (F.pmod(F.hash("id", F.lit(seed + 2)), F.lit(1000000)) / 100).alias("amount"),
        F.when(F.pmod(F.hash("id", F.lit(seed + 3)), F.lit(10)) < 9, "hot").alias("class"))


def test_bounds_over_many_merged_days(spark, tmp_path):
    rows = rows_of(spark, 3, 200_000, 40_000).checkpoint()
    table = S.DailySketches(spark, str(tmp_path / "t"), "class")
    table.store(rows)
    points = {f"p{i}": i / 20 for i in range(1, 20)}
    for r in S.merged_quantiles(table.read(), ["class"], points).collect():
        own = sorted(x.amount for x in rows.filter(F.col("class").eqNullSafe(r["class"])).select("amount").collect())
        for name, p in points.items():
            rank = sum(x < r[name] for x in own) / len(own)
            assert abs(rank - p) <= S.RANK_ERROR + 1 / len(own)
    got = S.rolling_users(table.read()).alias("g").join(S.rolling_users_exact(rows).alias("e"), "day").select(
        "day", F.col("g.users").alias("est"), F.col("e.users").alias("users"),
        F.col("g.new_users").alias("est_new"), F.col("e.new_users").alias("new"), "both_spans").collect()
    assert len(got) == 30 and max(r.users for r in got) > 4 * (1 << S.SET_LG)  # estimated, not listed
    for r in got:
        assert abs(r.est - r.users) <= S.SET_ERROR * r.both_spans
        assert abs(r.est_new - r.new) <= S.SET_ERROR * r.both_spans
    assert any(r.est != r.users for r in got)


def test_days_are_replaced_whole(spark, tmp_path):
    rows = rows_of(spark, 9, 3000, 500).checkpoint()
    table = S.DailySketches(spark, str(tmp_path / "t"), "class")
    table.store(rows)
    late = rows.filter("transaction_day = timestamp_ntz'2024-01-05'")
    table.store(late)                                     # the same day again
    assert table.read().agg(F.sum("n")).first()[0] == 3000
    more = late.unionByName(late.limit(7))
    table.store(more)
    assert table.read().agg(F.sum("n")).first()[0] == 3007
    table.store(rows.limit(0))
    exact = {r.day: (r.users, r.new_users) for r in S.rolling_users_exact(rows).collect()}
    assert {r.day: (r.users, r.new_users) for r in S.rolling_users(table.read()).collect()} == exact


def test_gaps_nulls_and_edges(spark, tmp_path):
    rng = random.Random(1)
    data = [(dt.datetime(2024, 1, d), u, None if u in (None, 3) else float(u), "x") for d in (1, 2, 9, 20)
            for u in rng.sample([None, 1, 2, 3, 4, 5], 4)] + [(None, 1, 1.0, "x")]
    rows = spark.createDataFrame(data, "transaction_day timestamp_ntz, user_id int, amount double, class string")
    table = S.DailySketches(spark, str(tmp_path / "t"), "class")
    table.store(rows)
    exact = {r.day: (r.users, r.new_users) for r in S.rolling_users_exact(rows).collect()}
    assert {r.day: (r.users, r.new_users) for r in S.rolling_users(table.read()).collect()} == exact
    assert len(exact) == 4
    none = rows.withColumn("amount", F.lit(None).cast("double"))
    assert [r.m for r in S.merged_quantiles(S.daily_sketches(none, "class"), ["class"], {"m": 0.5}).collect()] == [None]
    edges = [F.lit(30.0), F.lit(20.0), F.lit(10.0)]
    got = spark.createDataFrame([(None,), (35.0,), (30.0,), (29.0,), (10.0,), (1.0,)], "v double").select(
        S.ntile_by_edges(edges, F.col("v")).alias("b")).collect()
    assert [r.b for r in got] == [1, 1, 1, 2, 3, 4]
