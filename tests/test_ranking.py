"""Distributed NTILE / exact percentile = single-task built-ins."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wapspark.operators.ranking import distributed_ntile, exact_median, exact_percentile_cont
from wapspark.plans.marts import daily_metrics


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 10, 257])
def test_ntile_matches_builtin(spark, n):
    rnd = random.Random(n)
    rows = [(i, rnd.choice([None, 1, 2, 2, 3, 5])) for i in range(n)]  # ties and NULLs
    df = spark.createDataFrame(rows, "id int, v int")
    order = [F.col("v").desc_nulls_first(), F.col("id").asc_nulls_first()]
    ours = distributed_ntile(df, 4, order, "q", num_partitions=3)
    ref = df.withColumn("q", F.ntile(4).over(Window.orderBy(*order)))
    assert sorted(ours.select("id", "q").collect()) == sorted(ref.select("id", "q").collect())


def test_ntile_more_buckets_than_rows(spark):
    df = spark.createDataFrame([(i,) for i in range(3)], "id int")
    out = distributed_ntile(df, 5, [F.col("id").asc()], "q").orderBy("id").collect()
    assert [r.q for r in out] == [1, 2, 3]


def test_median_hot_group_matches_reference(spark):
    rnd = random.Random(7)
    rows = [(0, rnd.randint(-500, 5000) / 100) for _ in range(3000)]  # a hot group
    rows += [(g, rnd.randint(0, 1000) / 100) for g in range(1, 60) for _ in range(rnd.randint(1, 9))]
    rows += [(None, 1.0), (None, 3.0), (61, None)]
    df = spark.createDataFrame(rows, "g int, v double").withColumn("v", F.col("v").cast("decimal(10,2)"))
    got = {r.g: r.m for r in exact_median(df, ["g"], "v", "m", num_partitions=7).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    for g, vals in groups.items():
        assert got[g] == pytest.approx(statistics.median(vals), abs=1e-9)
    assert 61 not in got  # all-NULL group has no median row


def test_percentile_cont_quartile(spark):
    df = spark.createDataFrame([(1, float(x)) for x in [1, 2, 3, 4, 10]], "g int, v double")
    got = exact_percentile_cont(df, ["g"], "v", "p", 0.25).first()["p"]
    assert got == 2.0
    got = exact_percentile_cont(df, ["g"], "v", "p", 0.9).first()["p"]
    assert got == pytest.approx(4 + 0.6 * 6)


def test_moving_average_is_over_rows_not_days(spark):
    import datetime as dt
    days = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 10)]
    df = spark.createDataFrame([(d, float(i + 1)) for i, d in enumerate(days)],
                               "transaction_day timestamp_ntz, amount double") \
        .withColumn("amount", F.col("amount").cast("decimal(10,2)")).withColumn("user_id", F.lit(1))
    out = daily_metrics(df).orderBy("transaction_day").collect()
    assert [r.daily_amount_7day_moving_avg for r in out] == [1.0, 1.5, 2.0]


def test_distributed_moving_average_matches_window(spark):
    import datetime as dt
    rnd = random.Random(3)
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 400)) for _ in range(900)]
    rows = [(d, rnd.choice([None, 1.5, 20.25, -3.0])) for d in days]
    df = spark.createDataFrame(rows, "transaction_day timestamp_ntz, amount double") \
        .withColumn("amount", F.col("amount").cast("decimal(10,2)")).withColumn("user_id", F.lit(1))
    spread = {r.transaction_day: r.daily_amount_7day_moving_avg for r in daily_metrics(df).collect()}
    daily = df.groupBy("transaction_day").agg(F.sum("amount").alias("t"))
    w = Window.orderBy("transaction_day").rowsBetween(-6, 0)
    single = {r.transaction_day: r.m for r in daily.withColumn(
        "m", F.sum("t").over(w).cast("double") / F.count("t").over(w)).collect()}
    assert single == spread and len(single) > 200


def test_rank_time_grows_with_the_rows(spark):
    import time
    from wapspark.operators.ranking import rank_positions

    def seconds(n):
        df = spark.range(n).select(F.col("id"), (F.col("id") * 7919 % 1000).alias("v"))
        t = time.time()
        out = rank_positions(df, [F.col("v").asc(), F.col("id").asc()], num_partitions=1)
        got = out.agg(F.sum(F.col("_rk_before") + F.col("_rk_after") + 1 - F.col("_rk_n")),
                      F.max("_rk_before"), F.max("_rk_after")).first()
        assert tuple(got) == (0, n - 1, n - 1)
        return time.time() - t

    seconds(1000)
    small, large = seconds(20_000), seconds(80_000)
    assert large < max(10, 6 * small)


def test_identical_hot_rows_and_null_keys_spread(spark):
    from wapspark.operators.joins import skew_aware_join
    rows = [("hot", 1)] * 3000 + [(None, 2)] * 3000 + [(f"k{i}", 3) for i in range(3000)]
    big = spark.createDataFrame(rows, "k string, v int")
    small = spark.createDataFrame([("hot", True), ("k1", True)], "k string, m boolean")
    out = skew_aware_join(big, small, "k")
    assert sorted(map(str, out.collect())) == sorted(map(str, big.join(small, "k", "left").collect()))
    salts = big.filter("k = 'hot'").select(F.pmod(F.monotonically_increasing_id(), F.lit(8))).distinct()
    assert salts.count() > 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(k" in plan


def test_skew_aware_join_spreads_hot_key(spark):
    from wapspark.operators.joins import hot_keys, skew_aware_join
    rows = [(0, i) for i in range(3000)] + [(k, i) for k in range(1, 400) for i in range(15)]
    big = spark.createDataFrame(rows, "user_id int, v int")
    small = spark.createDataFrame([(k, k * 10) for k in range(0, 400)], "user_id int, m int")
    assert hot_keys(big, "user_id") == [0]
    out = skew_aware_join(big, small, "user_id", "left")
    ref = big.join(small, "user_id", "left")
    assert sorted(out.collect()) == sorted(ref.collect())
    # the hot key's rows land in several shuffle partitions
    parts = (big.filter("user_id = 0")
                .withColumn("_salt", F.pmod(F.xxhash64("user_id", "v"), F.lit(8)))
                .select("_salt").distinct().count())
    assert parts > 1


def test_many_hot_keys_are_joined_not_listed(spark):
    from wapspark.operators.joins import LISTED, skew_aware_join
    rows = [(k, i) for k in range(400) for i in range(6)] + [(None, 1), (500, 2)]
    big = spark.createDataFrame(rows, "user_id int, v int").repartition(4).checkpoint()
    small = spark.createDataFrame([(k, k * 10) for k in range(0, 399)], "user_id int, m int")
    hot = list(range(0, 400))
    assert len(hot) > LISTED
    for how in ("left", "inner"):
        out = skew_aware_join(big, small, "user_id", how, hot=hot, buckets=5)
        assert sorted(out.collect(), key=str) == sorted(big.join(small, "user_id", how).collect(), key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" not in plan and " IN (" not in plan


def test_user_without_amounts_keeps_its_id(spark):
    from wapspark.plans.marts import user_metrics
    rows = [(1, None), (2, 5.0), (2, 7.0), (None, 1.0), (None, None)]
    df = spark.createDataFrame(rows, "user_id int, amount double") \
        .withColumn("amount", F.col("amount").cast("decimal(10,2)")) \
        .withColumn("transaction_date", F.lit("2024-01-01").cast("timestamp_ntz")) \
        .withColumn("product_category", F.lit("a"))
    for median in ("exact", "approx"):
        out = {r.user_id: r for r in user_metrics(df, median=median).collect()}
        assert set(out) == {1, 2, None}
        assert out[1].median_transaction_amount is None and out[1].total_transactions == 1
        expected = {6.0} if median == "exact" else {5.0, 7.0}  # approx returns an observed value
        assert out[2].median_transaction_amount in expected
        assert out[None].total_transactions == 2


def test_only_hot_groups_are_ranked_by_range(spark, monkeypatch):
    from wapspark.operators import ranking
    rng = random.Random(5)
    rows = [(g, float(rng.randrange(40))) for g in [None] * 300 + [0] * 300 + [i % 90 + 1 for i in range(700)]]
    df = spark.createDataFrame(rows + [(1000, None)], "g int, v double")
    ranged, real = [], ranking.rank_positions

    def seen(df, order, groups=None, *a, **kw):
        ranged.append({r.g for r in df.select("g").distinct().collect()})
        return real(df, order, groups, *a, **kw)
    monkeypatch.setattr(ranking, "rank_positions", seen)
    for p in (0.25, 0.5):
        got = {r.g: r.m for r in exact_percentile_cont(df, ["g"], "v", "m", p).collect()}
        want = {}
        for g in {g for g, _ in rows}:
            v = sorted(x for k, x in rows if k == g)
            at = p * (len(v) - 1)
            lo, hi = v[int(at)], v[-int(-at // 1)]
            want[g] = lo + (hi - lo) * (at - int(at))
        assert got == want
    assert ranged == [{None, 0}, {None, 0}]  # 8 shuffle partitions: more than an eighth of the rows
    weighted = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = {r.g: r.m for r in exact_percentile_cont(weighted, ["g"], "v", "m", 0.5, weight="n").collect()}
    assert got == want
