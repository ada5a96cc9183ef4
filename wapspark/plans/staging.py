"""Staging models: typed, standardised transactions (M1, M5, M6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wapspark.functions import scalar as S
from wapspark.functions.privacy import mask_id

STG_COLUMNS = [
    "transaction_id", "user_id", "product_category", "currency", "amount",
    "transaction_date", "transaction_day", "transaction_year", "transaction_month",
    "transaction_day_of_month", "transaction_day_of_week", "transaction_hour",
    "status", "processed_at", "data_quality_score", "data_quality_tier",
    "transaction_value_tier", "dbt_transformed_at", "is_anomaly", "is_weekend",
]


def stg_raw_transactions(prod: DataFrame, as_of: dt.datetime | None = None,
                         lenient: bool = False) -> DataFrame:
    """M1: standardise the published transactions.

    Tiers are computed on the unrounded inputs (as the model does), the
    anomaly flag on the rounded amount. ``lenient=True`` turns failing numeric
    casts into NULL (``try_cast``) instead of failing the job.
    """
    def num(c: str, t: str):
        return F.col(c).try_cast(t) if lenient else F.col(c).cast(t)

    ts = F.col("transaction_date").cast("timestamp_ntz")
    renamed = prod.select(
        S.varchar("transaction_id", 50).alias("transaction_id"),
        num("user_id", "int").alias("user_id"),
        F.lower("product_category").alias("product_category"),
        S.varchar("currency", 3).alias("currency"),
        F.round(num("amount", "decimal(10,2)"), 2).cast("decimal(10,2)").alias("amount"),
        ts.alias("transaction_date"),
        S.day_trunc(ts).alias("transaction_day"),
        F.year(ts).alias("transaction_year"),
        F.month(ts).alias("transaction_month"),
        F.dayofmonth(ts).alias("transaction_day_of_month"),
        S.pg_dow(ts).alias("transaction_day_of_week"),
        F.hour(ts).alias("transaction_hour"),
        S.varchar(F.upper("status"), 20).alias("status"),
        F.col("processed_at").cast("timestamp_ntz").alias("processed_at"),
        F.round(num("data_quality_score", "decimal(3,2)"), 2).cast("decimal(3,2)")
         .alias("data_quality_score"),
        S.quality_tier("data_quality_score").alias("data_quality_tier"),
        S.value_tier("amount").alias("transaction_value_tier"),
        S.as_of_lit(as_of).alias("dbt_transformed_at"),
    )
    return renamed.select(
        "*",
        F.when(F.col("amount") < 0, True).otherwise(False).alias("is_anomaly"),
        S.is_weekend("transaction_day_of_week").alias("is_weekend"),
    )


def stg_masked_transactions(stg: DataFrame) -> DataFrame:
    """M5: staging with the user id masked (``ab****1234``)."""
    return stg.select(
        "transaction_id",
        mask_id(F.col("user_id").cast("string")).alias("user_id_masked"),
        "product_category", "amount", "currency", "transaction_date", "status")


def fact_transactions(cleaned: DataFrame) -> DataFrame:
    """M6: ``stg_transactions`` (= cleaned table) projected to the simple fact."""
    return cleaned.select("transaction_id", "user_id", "product_category",
                          "amount", "currency", "status")
