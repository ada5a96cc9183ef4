"""Per-user keys and crypto-shredding (P8–P12), as batch DataFrame jobs.

Personal data is stored encrypted with a per-user key (AES-GCM, built-in
``aes_encrypt``). Honouring a deletion request revokes the user's key and
erases its bytes; the ciphertext then reads back as NULL
(``try_aes_decrypt`` with no key). Keys and requests are tables; a batch of
requests produces the next version of the key table, written to a new path
so a failed run leaves the previous version intact.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wapspark.functions.scalar import as_of_lit
from wapspark.operators.joins import skew_aware_join
from wapspark.session import remove_path, scratch_path

KEYS_SCHEMA = ("key_id string, user_id int, encryption_key binary, key_version int, "
               "created_at timestamp_ntz, revoked_at timestamp_ntz, revoke_reason string, "
               "is_active boolean")
REQUESTS_SCHEMA = ("request_id string, user_id int, request_type string, request_date timestamp_ntz, "
                   "status string, completed_at timestamp_ntz, processed_by string, notes string, "
                   "legal_reference string")
SCRATCH_NAME = "issued-keys"  # folder of keys that are drawn but not yet versioned

# Fixed values of the deletion workflow.
PROCESSED_BY = "crypto_shredding_script"
DEFAULT_REASON = "Solicitud del usuario"
LEGAL_REFERENCE = "LDPD Art. 12 / GDPR Art. 17"


def issue_keys(users: DataFrame, existing: DataFrame | None = None,
               as_of: dt.datetime | None = None, test_seed: str | None = None) -> DataFrame:
    """One new active key for every user lacking an active key.

    Production keys are 32 random bytes from the OS CSPRNG, drawn in Arrow
    batches (``mapInPandas``) and written to the shared folder before they
    are returned, so a recomputation can never draw different bytes. ``test_seed`` gives repeatable keys
    ``sha256(seed || user_id)`` for tests."""
    need = users.select(F.col("user_id").cast("int")).filter(F.col("user_id").isNotNull()).distinct()
    version = F.lit(1)
    if existing is not None:
        active = existing.filter("is_active").select("user_id")
        need = need.join(active, "user_id", "left_anti")
        versions = existing.groupBy("user_id").agg(F.max("key_version").alias("_v"))
        need = need.join(versions, "user_id", "left")
        version = F.coalesce(F.col("_v"), F.lit(0)) + 1
    need = need.withColumn("key_version", version.cast("int"))
    if test_seed is not None:
        keyed = need.withColumn("encryption_key",
                                F.unhex(F.sha2(F.concat(F.lit(test_seed), F.col("user_id").cast("string")), 256)))
    else:
        def draw(batches):  # defined here: workers need not have this package
            import secrets
            for pdf in batches:
                pdf["encryption_key"] = [secrets.token_bytes(32) for _ in range(len(pdf))]
                yield pdf

        keyed = need.select("user_id", "key_version").mapInPandas(
            draw, "user_id int, key_version int, encryption_key binary")
    out = keyed.select(
        F.concat_ws("-", F.lit("k"), F.col("user_id").cast("string"),
                    F.col("key_version").cast("string")).alias("key_id"),
        "user_id", "encryption_key", "key_version",
        as_of_lit(as_of).alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("revoked_at"),
        F.lit(None).cast("string").alias("revoke_reason"),
        F.lit(True).alias("is_active"))
    if test_seed is None:
        # Random bytes must never be drawn twice: pin them in the shared
        # folder before anything reads them. ``write_keys_version`` deletes
        # this table once the keys stand in a version of their own.
        spark = out.sparkSession
        path = scratch_path(spark, SCRATCH_NAME)
        out.write.parquet(path)
        out = spark.read.parquet(path)
    return out


def _active(keys: DataFrame, user_col: str) -> DataFrame:
    return keys.filter(F.col("is_active") & F.col("encryption_key").isNotNull()).select(
        F.col("user_id").alias(user_col), F.col("encryption_key").alias("_k_key"),
        F.col("key_version").alias("_k_version"))


def encrypt_column(df: DataFrame, user_col: str, data_col: str, keys: DataFrame,
                   out_col: str = "ciphertext") -> tuple[DataFrame, DataFrame]:
    """P9 (J7): encrypt ``data_col`` with the row user's active key.
    Returns (encrypted rows, rows whose user has no active key). The key join
    is a shuffle join on the user; a hot user is salted (``skew_aware_join``)."""
    j = skew_aware_join(df, _active(keys, user_col), user_col, "left")
    enc = (j.filter(F.col("_k_key").isNotNull())
             .withColumn(out_col, F.aes_encrypt(F.col(data_col).cast("string"), F.col("_k_key"),
                                                F.lit("GCM")))
             .withColumnRenamed("_k_version", "key_version")
             .drop(data_col, "_k_key"))
    missing = j.filter(F.col("_k_key").isNull()).drop("_k_key", "_k_version")
    return enc, missing


def decrypt_column(df: DataFrame, user_col: str, cipher_col: str, keys: DataFrame,
                   out_col: str = "plaintext") -> DataFrame:
    """P10: read back; NULL when the user's key is revoked or absent."""
    j = skew_aware_join(df, _active(keys, user_col), user_col, "left")
    return (j.withColumn(out_col, F.try_aes_decrypt(F.col(cipher_col), F.col("_k_key"), F.lit("GCM"))
                         .cast("string"))
             .drop("_k_key", "_k_version"))


def process_deletions(requests: DataFrame, keys: DataFrame,
                      as_of: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """A batch of deletion requests (``user_id``, optional ``reason``).

    Returns (next key table, completed request rows). Active keys of the
    requesting users are revoked (inactive, revoked_at, reason) and their
    bytes erased; every request completes, also when no active key existed."""
    now = as_of_lit(as_of)
    reason = F.coalesce(F.col("reason"), F.lit(DEFAULT_REASON)) if "reason" in requests.columns \
        else F.lit(DEFAULT_REASON)
    reqs = requests.select(F.col("user_id").cast("int"), reason.alias("reason"))
    # One reason per user for the key update (pre-aggregated; any duplicates
    # of a hot user collapse map-side).
    per_user = reqs.groupBy("user_id").agg(F.max("reason").alias("_reason"))
    j = keys.join(per_user, "user_id", "left")
    hit = F.col("is_active") & F.col("_reason").isNotNull()
    next_keys = j.select(
        "key_id", "user_id",
        F.when(hit, F.lit(None).cast("binary")).otherwise(F.col("encryption_key")).alias("encryption_key"),
        "key_version",
        "created_at",
        F.when(hit, now).otherwise(F.col("revoked_at")).alias("revoked_at"),
        F.when(hit, F.col("_reason")).otherwise(F.col("revoke_reason")).alias("revoke_reason"),
        F.when(hit, F.lit(False)).otherwise(F.col("is_active")).alias("is_active"))
    done = reqs.select(
        F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), F.col("reason"),
                           now.cast("string")), 256).substr(1, 16).alias("request_id"),
        "user_id", F.lit("deletion").alias("request_type"), now.alias("request_date"),
        F.lit("completed").alias("status"), now.alias("completed_at"),
        F.lit(PROCESSED_BY).alias("processed_by"), F.col("reason").alias("notes"),
        F.lit(LEGAL_REFERENCE).alias("legal_reference"))
    return next_keys, done


def deletion_status(ids: DataFrame, keys: DataFrame, requests: DataFrame) -> DataFrame:
    """P12 (J5, W5): status per asked user id. ``found`` is False for users
    without a key row; the request side joins only completed requests
    (predicate inside the join, so unmatched keys survive); the latest key
    version and the latest completed request per user are picked with
    ``max_by`` aggregates (partial, skew-safe)."""
    latest_key = keys.groupBy("user_id").agg(
        F.max_by(F.struct("is_active", "revoked_at"), F.col("key_version")).alias("_k"))
    done = requests.filter(F.col("status") == "completed").groupBy("user_id").agg(
        F.max_by(F.struct("status", "completed_at", "notes"),
                 F.struct("completed_at", "request_id")).alias("_r"))
    kr = latest_key.join(done, "user_id", "left")
    asked = ids.select(F.col("user_id").cast("int")).distinct()
    j = asked.join(kr.withColumn("_found", F.lit(True)), "user_id", "left")
    found = F.coalesce(F.col("_found"), F.lit(False))
    return j.select(
        "user_id", found.alias("found"),
        F.col("_k.is_active").alias("key_active"),
        F.col("_k.revoked_at").alias("key_revoked"),
        F.col("_r.status").alias("deletion_status"),
        F.col("_r.completed_at").alias("completed_at"),
        F.col("_r.notes").alias("notes"))


def write_keys_version(keys: DataFrame, base_path: str, version: int) -> str:
    """Write one complete version of the key table under ``version=N``.

    A failed write leaves no ``_SUCCESS`` marker and readers keep using the
    last complete version. Once the new version is complete, all others and
    the scratch tables that its keys came from are deleted: bytes that a
    deletion batch revoked are then in no file any more."""
    spark = keys.sparkSession
    base = base_path.rstrip("/")
    path = f"{base}/version={int(version)}"
    sources = {m[1] for f in keys.inputFiles()
               if (m := re.match(rf"(.*/{SCRATCH_NAME}-[0-9a-f]{{32}})/", f))}
    keys.write.mode("overwrite").parquet(path)
    for other in _versions(spark, base):
        if other != int(version):
            remove_path(spark, f"{base}/version={other}")
    for source in sources:
        remove_path(spark, source)
    return path


def _versions(spark, base_path: str, complete: bool = False) -> list[int]:
    """Version numbers under the key path, by listing its folder."""
    base = spark._jvm.org.apache.hadoop.fs.Path(base_path)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(base) if fs.exists(base) else []:
        m = re.fullmatch(r"version=(\d+)", status.getPath().getName())
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if m and (not complete or fs.exists(marker)):
            found.append(int(m[1]))
    return found


def read_current_keys(spark, base_path: str) -> DataFrame:
    """The newest version with a ``_SUCCESS`` marker."""
    base = base_path.rstrip("/")
    current = max(_versions(spark, base, complete=True))
    return spark.read.parquet(f"{base}/version={current}")
