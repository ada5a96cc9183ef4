"""The users' keys at rest: wrapped, in buckets, erased bucket by bucket.

A user's data key is stored wrapped by a master key (AES-GCM); the table is cut
into buckets by a hash of the user and replaced part by part in one step
(``VersionedTable``). A batch of new keys or of deletions reads and rewrites the
buckets of its users alone; what it replaces is removed at once, so that the
bytes of a revoked key stand in no file any more. A new master key wraps the
data keys anew: encrypted data stays as it is.

The master key reaches the tasks as a row of a frame, never as a literal, so it
shows in no plan. It is the caller's to keep; the table knows its name only, and
a wrong one fails.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wapspark.operators import shredding
from wapspark.session import ensure_checkpoint_dir, remove_path
from wapspark.sources.versioned import VersionedTable


class KeyStore:
    """Keys at ``path`` under a named master key of 16, 24 or 32 bytes;
    ``buckets`` must be the same whenever the store is opened."""

    def __init__(self, spark: SparkSession, path: str, master_id: str, master: bytes,
                 buckets: int = 256):
        ensure_checkpoint_dir(spark)
        self.spark, self.buckets = spark, buckets
        self.master_id, self._master = master_id, master
        self.table = VersionedTable(spark, path, "bucket")

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(self.buckets)).cast("int"))

    def _with_master(self, df: DataFrame, master: bytes) -> DataFrame:
        one = self.spark.createDataFrame([(bytearray(master),)], "_master binary")
        return df.crossJoin(F.broadcast(one))  # one row

    def _wrap(self, keys: DataFrame) -> DataFrame:
        wrapped = F.when(F.col("encryption_key").isNotNull(),
                         F.aes_encrypt("encryption_key", "_master", F.lit("GCM")))
        return self._bucketed(self._with_master(keys, self._master).withColumn("wrapped_key", wrapped)
                              .withColumn("master_id", F.lit(self.master_id))
                              .drop("encryption_key", "_master"))

    def keys(self, parts: list | None = None) -> DataFrame:
        """The keys, unwrapped; of some buckets only, if given."""
        stored = self.table.read(parts=parts)
        if stored is None:
            return self.spark.createDataFrame([], shredding.KEYS_SCHEMA)
        plain = self._with_master(stored, self._master).withColumn("encryption_key", F.when(
            F.col("wrapped_key").isNotNull(), F.aes_decrypt("wrapped_key", "_master", F.lit("GCM"))))
        names = [c.strip().split(" ")[0] for c in shredding.KEYS_SCHEMA.split(",")]
        return plain.select(*names)

    def _buckets_of(self, users: DataFrame) -> list[int]:
        """The buckets that a batch's users fall into: at most ``buckets`` numbers."""
        return [r["bucket"] for r in self._bucketed(users.select(F.col("user_id").cast("int")).dropna())
                .select("bucket").distinct().collect()]

    def _replace(self, keys: DataFrame) -> None:
        self.table.replace_parts(self._wrap(keys))
        self.table.vacuum(keep=1)

    def issue(self, users: DataFrame, as_of: dt.datetime | None = None,
              test_seed: str | None = None) -> int:
        """A key for each user that has no active one. The number of buckets
        rewritten."""
        touched = self._buckets_of(users)
        old = self.keys(touched)
        fresh = shredding.issue_keys(users, old, as_of=as_of, test_seed=test_seed)
        if fresh.isEmpty():
            return 0
        drawn = {f.rsplit("/", 1)[0] for f in fresh.inputFiles() if f"/{shredding.SCRATCH_NAME}-" in f}
        new = fresh.unionByName(old).checkpoint() if not drawn else fresh.unionByName(old)
        self._replace(new)
        for folder in drawn:
            remove_path(self.spark, folder)
        return len(touched)

    def delete(self, requests: DataFrame, as_of: dt.datetime | None = None) -> tuple[DataFrame, int]:
        """Revoke the keys of a batch of requests. The completed requests,
        and the number of buckets rewritten."""
        requests = requests.checkpoint()
        known = set(self.table.manifest()["parts"]) if self.table.versions() else set()
        touched = [b for b in self._buckets_of(requests) if str(b) in known]
        later, done = shredding.process_deletions(requests, self.keys(touched), as_of=as_of)
        if touched:
            self._replace(later)
        return done, len(touched)

    def rotate_master(self, master_id: str, master: bytes) -> None:
        """Wrap all keys by a new master key; the old one opens nothing then."""
        plain = self.keys()
        self.master_id, self._master = master_id, master
        if self.table.versions():
            self._replace(plain)
