"""Join helpers: broadcast only behind a checked size, else shuffle.

``bounded_broadcast`` materialises a (small, aggregated) side once in the
shared checkpoint folder, measures it there, and hints a broadcast only when
its values' bytes are within the bound; beyond it the side is returned as is and
Spark plans a shuffle (sort-merge) join, with AQE free to re-plan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wapspark.session import ensure_checkpoint_dir, releasing, remove_path, scratch_path

# Default bound for a broadcast side, in bytes of its values. A daily or
# per-category aggregate stays far below it; a per-user aggregate does not.
BROADCAST_MAX_BYTES = 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """Size of a row's values: octets of strings and binaries (of the JSON form
    of nested values), 16 bytes for each other column."""
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(c), F.lit(0)) + 16
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 16
        else:
            width = width + 16
    return width


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    # The size is observed by the checkpoint job itself: one pass.
    seen = Observation("bounded_broadcast")
    with releasing(df.sparkSession):
        small = df.observe(seen, F.sum(row_bytes(df)).alias("bytes")).checkpoint(eager=True)
    return F.broadcast(small) if (seen.get["bytes"] or 0) <= max_bytes else small


def materialize(df: DataFrame | Iterable[DataFrame], name: str = "stage",
                by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts lineage, and later scans get column pruning and pushed-down
    filters (unlike an RDD checkpoint). Several frames of the same columns are
    written one after another, each only once the one before is done: the shuffle
    files of one are there at a time. ``by`` names a column to have a folder for
    each value of (few), which ``discard`` can drop by itself."""
    path, spark, schema = None, None, None
    for part in [df] if isinstance(df, DataFrame) else df:
        if path is None:
            spark, schema = part.sparkSession, part.schema
            path = scratch_path(spark, name)
        with releasing(spark):
            writer = part.select(*schema.names).write.mode("append").option("compression", "zstd")
            (writer.partitionBy(by) if by else writer).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._stored_at, out._stored_by = path, by
    return out


def stored_part(df: DataFrame, value: int) -> DataFrame:
    """The rows of one folder of a materialised frame, without its column."""
    return df.filter(F.col(df._stored_by) == value).drop(df._stored_by)


def stored_with(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, which reads what ``materialize`` wrote for ``source`` and is
    discarded with it."""
    df._stored_at, df._stored_by = source._stored_at, None
    return df


def discard(df: DataFrame, value: int | None = None) -> None:
    """Delete what ``materialize`` wrote for ``df``, or for one value of its
    ``by``: nothing may read it any more."""
    remove_path(df.sparkSession, df._stored_at if value is None else f"{df._stored_at}/{df._stored_by}={value}")


def hot_keys(df: DataFrame, key: str, share: float | None = None,
             counts: DataFrame | None = None, total: int | None = None) -> list:
    """Keys holding more than ``share`` of all rows (default: one shuffle
    partition's worth, 1/N). Counts are map-side combined; at most 1/share
    keys can qualify, so the returned list is bounded by N. ``counts`` (key,
    ``_n``) with the ``total`` of rows saves counting again."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = share or 1.0 / n
    limit = int(1 / share) + 1
    freq = counts if counts is not None else (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")))
    # One job: the top keys by count (a bounded top-k) while the total is
    # observed over every key's count in the same pass.
    seen = Observation("hot_keys")
    with releasing(spark):
        top = (freq.observe(seen, F.sum("_n").alias("total"))
                   .orderBy(F.col("_n").desc()).limit(limit).collect())
    total = total or seen.get["total"] or 0
    return [r[key] for r in top if total and r["_n"] > total * share]


# Up to so many hot keys are tested by an IN list, more by a broadcast join.
LISTED = 200


def _with_hot(df: DataFrame, key: str, hot: list) -> DataFrame:
    """``df`` with ``_hot``: whether the row's key is a hot one. There are at most
    as many hot keys as shuffle partitions: the broadcast is a bounded list."""
    if len(hot) <= LISTED:
        return df.withColumn("_hot", F.coalesce(F.col(key).isin(hot), F.lit(False)))
    keys = df.sparkSession.createDataFrame(
        [(k,) for k in hot], T.StructType([T.StructField(key, df.schema[key].dataType)]))
    marked = df.join(F.broadcast(keys.withColumn("_hot", F.lit(True))), key, "left")
    return marked.select(*df.columns, F.coalesce("_hot", F.lit(False)).alias("_hot"))


def skew_aware_join(big: DataFrame, small: DataFrame, key: str, how: str = "left",
                    share: float | None = None, buckets: int | None = None,
                    hot: list | None = None) -> DataFrame:
    """Left or inner equi-join of ``big`` with ``small`` (at most one row per
    key) so that a hot key of ``big`` is spread over ``buckets`` tasks.

    Rows of hot keys get a salt from their running number in their input
    partition, whatever they hold, so identical rows are spread too; the
    matching ``small`` row is replicated once per salt value, so every row
    matches exactly once. ``big`` should come from a scan, a written table or
    a checkpoint, whose rows keep their order when a task is run again. Cold
    keys keep salt 0 and join as usual. Rows with a NULL key match nothing and
    don't take part in the shuffle."""
    if how not in ("left", "inner"):
        raise ValueError(f"skew_aware_join: {how} join")
    hot = hot_keys(big, key, share) if hot is None else hot
    known = big.filter(F.col(key).isNotNull())
    if not hot:
        out = known.join(small, key, how)
    else:
        n = buckets or int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted_big = _with_hot(known, key, hot).withColumn("_salt", F.when(
            F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(n))).otherwise(F.lit(0))
            .cast("long")).drop("_hot")
        salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
        salted_small = _with_hot(small, key, hot).withColumn(
            "_salt", F.explode(salts.cast("array<long>"))).drop("_hot")
        out = salted_big.join(salted_small, [key, "_salt"], how).drop("_salt")
    if how == "inner":
        return out
    added = [f for f in small.schema.fields if f.name != key]
    unknown = big.filter(F.col(key).isNull()).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    return out.unionByName(unknown)
