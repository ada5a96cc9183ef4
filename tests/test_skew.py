"""A user holding a third of all transactions: the flagship's salted join
gives the same rows as a plain join."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wapspark.operators import joins
from wapspark.plans import marts, staging
from wapspark.sources.tables import AS_OF, transactions


def test_flagship_with_hot_user(spark, monkeypatch):
    prod = transactions(spark, SF_SMALL, "prod")
    hot = prod.withColumn("user_id", F.when(F.xxhash64("transaction_id") % 3 == 0, F.lit(0))
                                      .otherwise(F.col("user_id")))
    stg = staging.stg_raw_transactions(hot, as_of=AS_OF)
    assert joins.hot_keys(stg.filter(F.col("user_id").isNotNull()), "user_id") == [0]
    salted = marts.int_transactions_enriched(stg, include_median=True)
    got = sorted(map(tuple, salted.collect()), key=str)

    monkeypatch.setattr(marts, "skew_aware_join", lambda big, small, key, how, hot: big.join(small, key, how))
    plain = marts.int_transactions_enriched(stg, include_median=True)
    want = sorted(map(tuple, plain.collect()), key=str)
    assert len(got) == len(want) == prod.count()
    assert got == want
