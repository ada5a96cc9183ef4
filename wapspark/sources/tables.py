"""Table scans and the ``tx`` transactions adapter.

``transactions`` derives the quarantine / published transaction table shape
from the driver's TPC-H-style tables (lineitem ⋈ orders ⋈ part), with the
deterministic faults listed in FIXTURES.md §2.1. Only the columns each
consumer needs are read (Catalyst prunes the scan), and filters placed on
the result are pushed below the joins into the parquet scans.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed fixture parameters (FIXTURES.md §2.1).
AS_OF = dt.datetime(2001, 11, 5, 0, 0, 0)
EVENTS_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)

AUDIT_COLUMNS = [
    "transaction_id", "user_id", "product_category", "amount", "currency",
    "transaction_date", "status", "ingested_at", "source_file",
    "gx_validation_status", "gx_validation_errors",
]
PROD_COLUMNS = AUDIT_COLUMNS + ["processed_at", "data_quality_score"]


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def _uuid_from_md5(m: Column) -> Column:
    return F.concat_ws("-", F.substring(m, 1, 8), F.substring(m, 9, 4),
                       F.substring(m, 13, 4), F.substring(m, 17, 4),
                       F.substring(m, 21, 12))


def transactions(spark: SparkSession, sf_dir: str, variant: str = "prod",
                 status_case: str = "upper", share: tuple[int, int] | None = None) -> DataFrame:
    """The ``tx`` fixture in ``prod.raw_transactions`` shape.

    variant: ``prod`` (all columns), ``audit`` (no published columns),
    ``dup`` (prod plus rows with ``l_orderkey % 89 = 0`` a second time, a day
    later and with an amount one higher),
    ``published`` (rows with ``l_orderkey % 3 = 0``, already in prod).
    status_case: ``lower`` feeds lower-case status to exercise staging's UPPER.
    share: ``(k, n)`` gives the rows whose order falls into share k of n, by a
    hash of its key; the n shares are the table.
    """
    if variant == "dup":
        again = _tx(spark, sf_dir, PROD_COLUMNS, status_case, F.col("l_orderkey") % 89 == 0, share)
        return _tx(spark, sf_dir, PROD_COLUMNS, status_case, None, share).unionByName(again.withColumns({
            "amount": (F.col("amount") + 1).cast("decimal(10,2)"),
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY")}))
    if variant == "published":
        return _tx(spark, sf_dir, PROD_COLUMNS, status_case, F.col("l_orderkey") % 3 == 0, share)
    names = AUDIT_COLUMNS if variant == "audit" else PROD_COLUMNS
    return _tx(spark, sf_dir, names, status_case, None, share)


def _tx(spark: SparkSession, sf_dir: str, names: list[str], status_case: str,
        lineitem_filter: Column | None, share: tuple[int, int] | None) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"])
    if lineitem_filter is not None:
        li = li.filter(lineitem_filter)
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderdate"])
    if share is not None:
        li, orders = (df.filter(F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(share[1])) == share[0])
                      for df, key in ((li, "l_orderkey"), (orders, "o_orderkey")))
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(part, li.l_partkey == part.p_partkey))

    # The row hash is projected once and then cut into the UUID form.
    j = j.withColumn("_m", F.md5(F.concat_ws(
        "-", F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
        F.col("l_linenumber"), F.col("l_quantity").cast("int"),
        F.date_format(F.to_date("l_shipdate"), "yyyyMMdd"))))
    m = F.col("_m")
    key_sum = F.col("l_orderkey") + F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    amount = (F.when(key_sum % 211 == 0, F.lit(None))
               .when(key_sum % 53 == 0, -price)
               .when(F.col("l_linenumber") == 7, price)
               .otherwise(F.round(price * F.col("l_discount").cast("decimal(4,2)"), 2))
               .cast("decimal(10,2)"))
    currency = (F.when(F.col("l_suppkey") % 50 == 7, F.lit("JPYX"))
                 .when(F.col("l_suppkey") % 3 == 0, F.lit("USD"))
                 .when(F.col("l_suppkey") % 3 == 1, F.lit("EUR"))
                 .otherwise(F.lit("GBP")))
    status = (F.when(F.col("l_returnflag") == "A", "COMPLETED")
               .when(F.col("l_returnflag") == "N", "PENDING")
               .when(F.col("l_returnflag") == "R", "FAILED"))
    if status_case == "lower":
        status = F.lower(status)
    score = (F.when(F.col("l_suppkey") % 37 == 0, F.lit(None))
              .otherwise(((F.col("l_quantity").cast("decimal(5,2)") + 50) / 100)
                         .cast("decimal(3,2)")))

    cols = {
        "transaction_id": _uuid_from_md5(m),
        "user_id": F.when(F.col("l_orderkey") % 97 == 0, F.lit(None))
                    .otherwise(F.col("o_custkey").cast("int")),
        "product_category": F.when(F.col("l_partkey") % 101 == 0, F.lit(None))
                             .otherwise(F.col("p_type")),
        "amount": amount,
        "currency": currency,
        "transaction_date": F.col("l_shipdate")
            + F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int")),
        "status": status,
        "ingested_at": F.col("o_orderdate"),
        "source_file": F.concat(F.lit("f"), (F.col("l_orderkey") % 10).cast("string")),
        "gx_validation_status": F.lit("PENDING"),
        "gx_validation_errors": F.lit(None).cast("string"),
        "processed_at": F.col("l_shipdate") + F.expr("INTERVAL 1 DAY"),
        "data_quality_score": score,
    }
    return j.select(*[cols[c].alias(c) for c in names])
