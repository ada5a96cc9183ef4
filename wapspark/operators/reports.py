"""Top-k reports and previews.

``orderBy(...).limit(k)`` plans as a TakeOrderedAndProject: each partition
keeps its own k best rows and only those are merged, so a top-k never sorts
the whole table. Every order ends with a unique key so the cut is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_users_by_lifetime_value(dim_users: DataFrame, k: int = 10) -> DataFrame:
    return top_k(dim_users, [F.col("lifetime_value").desc(), F.col("user_id").asc()], k)


def newest_facts(fct: DataFrame, k: int = 10) -> DataFrame:
    return top_k(fct, [F.col("transaction_date").desc(), F.col("transaction_id").asc()], k)


def newest_quality_days(dashboard: DataFrame, k: int = 7) -> DataFrame:
    return top_k(dashboard, [F.col("fecha").desc()], k)


def newest_validation_logs(logs: DataFrame, k: int = 10) -> DataFrame:
    return top_k(logs, [F.col("validation_timestamp").desc(), F.col("table_name").asc()], k)


def last_days(df: DataFrame, day_col: str, as_of: Column, days: int = 7) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` (a pushed-down filter)."""
    return df.filter((F.col(day_col) > as_of - F.expr(f"INTERVAL {days} DAYS")) & (F.col(day_col) <= as_of))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A bounded preview (``show(5)`` without printing)."""
    return df.limit(n)


def write_validation_document(results: DataFrame, path: str) -> None:
    """A10: store a run's rule results as a JSON document folder."""
    results.coalesce(1).write.mode("overwrite").json(path)
