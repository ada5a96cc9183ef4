"""Stored index of published keys for insert-if-absent.

A left-anti join against prod shuffles the whole key column of prod on every
run. The index answers "which of these keys are stored already" by a Bloom
filter and reads stored keys only where the filter says *maybe*:

* keys fall into ``buckets`` by hash; each bucket is a partition folder of the
  stored keys and of the filter;
* the filter is a table of blocks of 256 bits, each four longs. A key sets eight
  bits of one block (two a long), so it costs one row of one equi-join to look
  up, and building it is a ``bit_or`` by (bucket, block), combined map-side.
  Blocks are appended run by run and or-ed when read;
* a batch's keys are looked up in the filters of the buckets that it touches;
  hits are compared with the stored keys of their buckets, exactly. False
  positives cost time and never a row. With ``BITS_PER_KEY`` bits a key some 6
  in 10,000 new keys are hits.

A run's keys count once it is committed: ``add`` before the rows are appended to
prod, ``commit`` after. A run that died between is settled by ``recover``, which
alone reads prod: keys that did arrive are kept under a run of their own.
Adding a run twice does no harm.

Rows whose key is NULL in any column are never known (as in an anti join).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wapspark.operators.joins import materialize
from wapspark.session import ensure_checkpoint_dir
from wapspark.sources.sinks import append, read_if_present

BITS_PER_KEY = 16
BLOCK_BITS = 256
_WORDS = ["w0", "w1", "w2", "w3"]


class KeyIndex:
    """The index at ``path`` over the key columns ``keys``; its sizes are fixed
    when it is created (``KeyIndex.create``)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        ensure_checkpoint_dir(spark)
        meta = spark.read.parquet(f"{self.path}/meta").first()
        self.keys, self.buckets, self.blocks = list(meta["keys"]), meta["buckets"], meta["blocks"]

    @classmethod
    def create(cls, spark: SparkSession, path: str, keys: list[str], expected_keys: int,
               buckets: int = 64) -> "KeyIndex":
        """``expected_keys`` sizes the filter; more keys make more false
        positives (``load`` tells), a new index with a larger number fewer."""
        blocks = max(1, -(-expected_keys * BITS_PER_KEY // (BLOCK_BITS * buckets)))
        (spark.createDataFrame([(list(keys), int(buckets), int(blocks))],
                               "keys array<string>, buckets int, blocks int")
         .coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/meta"))
        return cls(spark, path)

    def _hashed(self, df: DataFrame) -> DataFrame:
        """Distinct keys with bucket, block and the four longs of their bits."""
        cols = [F.col(k) for k in self.keys]
        bits = F.xxhash64(F.lit(2), *cols)

        def one(place: int) -> Column:
            return F.call_function("shiftleft", F.lit(1).cast("long"),
                                   F.shiftrightunsigned(bits, place).bitwiseAND(63).cast("int"))
        found = df.select(*self.keys).dropna().distinct()
        return found.withColumns({
            "bucket": F.pmod(F.xxhash64(*cols), F.lit(self.buckets)).cast("int"),
            "block": F.pmod(F.xxhash64(F.lit(1), *cols), F.lit(self.blocks)).cast("int"),
            **{w: one(12 * i).bitwiseOR(one(12 * i + 6)) for i, w in enumerate(_WORDS)}})

    def _part(self, name: str, buckets: list[int]) -> DataFrame | None:
        """A stored table's rows of some buckets; other folders aren't listed
        for reading (partition pruning)."""
        stored = read_if_present(self.spark, f"{self.path}/{name}")
        return None if stored is None else stored.filter(F.col("bucket").isin(buckets))

    def _note(self, run_id: str, state: str) -> None:
        append(self.spark.createDataFrame([(run_id, state)], "run_id string, state string").coalesce(1),
               f"{self.path}/runs")

    def _runs(self, states: list[str]) -> DataFrame:
        runs = read_if_present(self.spark, f"{self.path}/runs")
        if runs is None:
            return self.spark.createDataFrame([], "run_id string")
        return runs.filter(F.col("state").isin(states)).select("run_id").distinct()

    def add(self, df: DataFrame, run_id: str) -> None:
        """Store the keys of ``df`` for a run that is about to publish them."""
        self._note(run_id, "begun")
        new = self._hashed(df).checkpoint()
        append(new.select(*self.keys, F.lit(run_id).alias("run_id"), "bucket").repartition("bucket"),
               f"{self.path}/keys", partition_by=["bucket"])
        blocks = new.groupBy("bucket", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])
        append(blocks.repartition("bucket"), f"{self.path}/filter", partition_by=["bucket"])

    def commit(self, run_id: str) -> None:
        self._note(run_id, "committed")

    def maybe(self, df: DataFrame) -> DataFrame:
        """Distinct keys of ``df`` that the filter can't rule out, with their
        bucket. The buckets that the batch touches are few numbers."""
        asked = self._hashed(df).checkpoint()
        touched = [r["bucket"] for r in asked.select("bucket").distinct().collect()]
        blocks = self._part("filter", touched)
        if blocks is None:
            return asked.select(*self.keys, "bucket").limit(0)
        held = blocks.select("bucket", "block", *[F.col(w).alias(f"f{w}") for w in _WORDS])
        met = asked.join(held, ["bucket", "block"]).groupBy(*self.keys, "bucket").agg(
            *[F.bit_or(F.col(f"f{w}").bitwiseAND(F.col(w))).alias(f"f{w}") for w in _WORDS],
            *[F.first(w).alias(w) for w in _WORDS])
        every = reduce(lambda a, b: a & b, [F.col(f"f{w}") == F.col(w) for w in _WORDS])
        return met.filter(every).select(*self.keys, "bucket")

    def known(self, df: DataFrame) -> DataFrame:
        """Distinct keys of ``df`` that committed runs have stored, exactly."""
        hits = self.maybe(df).checkpoint()
        buckets = [r["bucket"] for r in hits.select("bucket").distinct().collect()]
        stored = self._part("keys", buckets) if buckets else None
        if stored is None:
            return hits.select(*self.keys).limit(0)
        sure = stored.join(self._runs(["committed"]), "run_id", "left_semi").select("bucket", *self.keys)
        return hits.join(sure, ["bucket", *self.keys], "left_semi").select(*self.keys)

    def absent(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key is not stored (all copies of it). They are read
        twice, so they are written to the shared checkpoint folder first."""
        df = materialize(df, "asked")
        return df.join(self.known(df), self.keys, "left_anti").select(*df.columns)

    def recover(self, prod: DataFrame) -> list[str]:
        """Settle runs that began and neither committed nor were given up: keys
        that prod holds are kept, others forgotten. Returns these runs."""
        open_runs = [r["run_id"] for r in self._runs(["begun"]).join(
            self._runs(["committed", "given up"]), "run_id", "left_anti").collect()]
        stored = read_if_present(self.spark, f"{self.path}/keys")
        for run in open_runs:
            if stored is not None:
                arrived = stored.filter(F.col("run_id") == run).select(*self.keys).join(
                    prod.select(*self.keys), self.keys, "left_semi").checkpoint()
                if not arrived.isEmpty():
                    self.add(arrived, f"{run}/recovered")
                    self.commit(f"{run}/recovered")
            self._note(run, "given up")
        return open_runs

    def load(self) -> float:
        """Share of the filter's bits that are set, two in five when it holds
        the keys that it was made for."""
        blocks = read_if_present(self.spark, f"{self.path}/filter")
        if blocks is None:
            return 0.0
        merged = blocks.groupBy("bucket", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])
        ones = merged.agg(F.sum(sum((F.bit_count(w) for w in _WORDS[1:]), F.bit_count("w0")))).first()[0]
        return (ones or 0) / (BLOCK_BITS * self.blocks * self.buckets)


def insert_if_absent_indexed(new: DataFrame, index: KeyIndex, path: str, run_id: str) -> DataFrame:
    """A11 with an index: append the rows of ``new`` whose key is not stored
    (first copy of each key) to the table at ``path``."""
    rows = index.absent(new.dropDuplicates(index.keys)).checkpoint()
    index.add(rows, run_id)
    append(rows, path)
    index.commit(run_id)
    return rows
