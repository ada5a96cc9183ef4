"""Repair, publish and reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wapspark.functions.scalar import as_of_lit
from wapspark.operators.key_index import KeyIndex


def repair(df: DataFrame) -> DataFrame:
    """Negative amount → 0 (NULL stays NULL); NULL user → 0.
    Note: the repaired ``user_id = 0`` becomes a hot key downstream."""
    return df.withColumns({
        "amount": F.when(F.col("amount") < 0, F.lit(0).cast(df.schema["amount"].dataType))
                   .otherwise(F.col("amount")),
        "user_id": F.coalesce(F.col("user_id"), F.lit(0).cast(df.schema["user_id"].dataType)),
    })


def publish_clean(audit: DataFrame) -> DataFrame:
    """The published 'cleaned' table: ``amount >= 0`` (NULL amounts
    drop too). Write with ``sinks.overwrite``."""
    return audit.filter(F.col("amount") >= 0)


def dedup_latest(df: DataFrame, key: str = "transaction_id", order_col: str = "ingested_at") -> DataFrame:
    """U4: one row per key, keeping the newest ``order_col``; ties broken by
    the row content so the pick is deterministic. The maximum of (order,
    content) is a partial aggregate that carries each row once: a key with
    many copies is combined map-side, never collected into one task. Rows
    without a key are no copies of one another and all stay."""
    others = [order_col, *[c for c in df.columns if c not in (key, order_col)]]
    picked = (df.filter(F.col(key).isNotNull()).groupBy(key)
                .agg(F.max(F.struct(*[F.col(c) for c in others])).alias("_row")))
    keyed = picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)
    return keyed.unionByName(df.filter(F.col(key).isNull()))


PROD_DAY = "transaction_day"


def publish_incremental(audit: DataFrame, prod: DataFrame, as_of: dt.datetime | None = None,
                        score: float = 1.0) -> DataFrame:
    """Rows to append to prod.

    B4 filter (COMPLETED, amount > 0, known user) → B5 enrichment (score,
    processed_at) → U4 dedup inside the batch → J6 left-anti join on the key
    against what prod already holds. Running it again after the append
    yields no rows (idempotent), whatever a row's date has become since.
    A row without a key could not be told from a published one and is never
    published (the key is prod's primary key).

    When prod is stored partitioned by ``transaction_day`` the output carries
    the day column for the partitioned append; rows are matched on the key
    alone either way."""
    new = publishable(audit, as_of, score, by_day=PROD_DAY in prod.columns)
    return new.join(prod.select("transaction_id"), "transaction_id", "left_anti")


def publishable(audit: DataFrame, as_of: dt.datetime | None = None, score: float = 1.0,
                by_day: bool = False) -> DataFrame:
    """Rows of the batch that may be published, one a key."""
    new = (audit.filter((F.col("status") == "COMPLETED") & (F.col("amount") > 0)
                        & F.col("user_id").isNotNull() & F.col("transaction_id").isNotNull())
                .withColumns({"processed_at": as_of_lit(as_of),
                              "data_quality_score": F.lit(score).cast("decimal(3,2)")}))
    new = dedup_latest(new)
    return new.withColumn(PROD_DAY, F.to_date("transaction_date")) if by_day else new


def publish_indexed(audit: DataFrame, index: KeyIndex, as_of: dt.datetime | None = None,
                    score: float = 1.0, by_day: bool = False) -> DataFrame:
    """M11 against a stored key index (on ``transaction_id``) in place of prod:
    the same rows as ``publish_incremental``, and what is read follows the
    batch, not prod. Write them between ``index.add`` and ``index.commit``."""
    return index.absent(publishable(audit, as_of, score, by_day))


def reconciliation(audit: DataFrame, prod: DataFrame) -> DataFrame:
    """Audit vs prod row counts and their difference, as one
    aggregate over a tagged union (no scalar subqueries, no cross join)."""
    tagged = (audit.select(F.lit(1).alias("_a"), F.lit(0).alias("_p"))
                   .unionByName(prod.select(F.lit(0).alias("_a"), F.lit(1).alias("_p"))))
    return tagged.agg(F.sum("_a").cast("long").alias("total_audit"),
                      F.sum("_p").cast("long").alias("total_prod")) \
                 .withColumn("registros_filtrados", F.col("total_audit") - F.col("total_prod"))


def prod_summary(prod: DataFrame) -> DataFrame:
    """Row count, distinct users, mean amount (exact decimal sum / count)."""
    return prod.agg(F.count(F.lit(1)).alias("total_prod"),
                    F.countDistinct("user_id").alias("usuarios_unicos"),
                    (F.sum("amount").cast("double") / F.count("amount")).alias("monto_promedio"))
