"""Masked / pseudonymised views (M16–M18) and the customer PII fixture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wapspark.functions import scalar as S
from wapspark.functions.privacy import (mask_email, mask_id, mask_name, md5_short_tag,
                                        md5_user_tag, pseudonymize)


def audit_masked_transactions(audit: DataFrame) -> DataFrame:
    """Developer view of the quarantine table (``user_`` + md5)."""
    return audit.select("transaction_id", md5_user_tag("user_id").alias("user_id_masked"),
                        "product_category", "amount", "currency", "transaction_date", "status")


def prod_masked_transactions(prod: DataFrame) -> DataFrame:
    """Business-analyst view of prod (``U`` + 8 md5 chars, day grain)."""
    return prod.select("transaction_id", md5_short_tag("user_id").alias("user_short_id"),
                       "product_category", "amount", "currency",
                       S.day_trunc("transaction_date").alias("transaction_day"), "status")


def analytics_view(prod: DataFrame, salt: str | None = None) -> DataFrame:
    """Pseudonymised analytics view over prod. Day and quarter are
    derived here (the published table does not carry them)."""
    return prod.select(
        "transaction_id", pseudonymize("user_id", salt).alias("user_pseudo_id"),
        "product_category", "amount", "currency", "transaction_date", "status",
        "data_quality_score", S.day_trunc("transaction_date").alias("transaction_day"),
        S.quarter_label(F.month("transaction_date")).alias("transaction_quarter"))


def customer_contacts(customer: DataFrame) -> DataFrame:
    """Customer PII fixture: an e-mail column with the edge cases (no ``@``,
    ≤5 characters, NULL) derived from the customer key."""
    k = F.col("c_custkey")
    local = F.lower(F.regexp_replace("c_name", "#", "."))
    full = F.concat(local, F.lit("@"), F.lower("c_mktsegment"), F.lit(".test"))
    email = (F.when(k % 29 == 0, F.lit(None).cast("string"))
              .when(k % 23 == 0, F.lit("a@b.c"))
              .when(k % 19 == 0, local)
              .otherwise(full))
    return customer.select("c_custkey", "c_name", email.alias("email"))


def masked_contacts(contacts: DataFrame) -> DataFrame:
    """P1–P3 applied together."""
    return contacts.select(
        "c_custkey",
        mask_email("email", strict=True).alias("email_masked"),
        mask_email("email", strict=False).alias("email_masked_reference"),
        mask_name("c_name").alias("name_masked"),
        mask_id(F.col("c_custkey").cast("string")).alias("id_masked"))
