"""Exact rank positions without a single-task window.

``NTILE`` over a whole table (no PARTITION BY) and exact medians of a hot
group both need every row's position in a total order. A plain
``Window.orderBy`` moves all rows to one task; a median aggregate keeps all
distinct values of the group in one task's buffer. Instead:

1. range-partition the rows on (group, order) so a hot group spans many
   partitions; tag each row with its partition id and write the result to
   the shared checkpoint folder (the range bounds are drawn once, and lineage
   is cut, so a lost executor cannot re-draw them);
2. count (weighted) rows before each row inside its own partition by a running
   sum over (partition id, group), and after it as total less that sum;
3. per (partition id, group) totals give, through a running sum over the at
   most N partitions a group spans, the offsets contributed by earlier and
   later partitions. Only a group that crosses a partition boundary gets a
   non-NULL offset, and each partition has at most one such group at either
   end, so the offset tables hold at most N rows each: a proven bound, so
   they are broadcast;
4. before = local + offset, after likewise, n = before + weight + after.

No collect, no per-group buffer, no single-partition window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wapspark.session import ensure_checkpoint_dir, pinned, releasing

PID = "_rk_pid"


def rank_positions(df: DataFrame, order: list[Column], group_cols: list[str] | None = None,
                   weight: str | None = None, num_partitions: int | None = None,
                   prefix: str = "_rk") -> DataFrame:
    """Add ``{prefix}_before``, ``{prefix}_after`` and ``{prefix}_n``.

    ``order`` must be a total order inside each group (add a unique
    tie-break). ``weight`` names a non-negative count column for
    pre-aggregated input (value, count) — positions then count weights.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    groups = list(group_cols or [])
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = F.col(weight) if weight else F.lit(1).cast("long")
    wname = f"{prefix}_w"

    keyed = pinned(df.withColumn(wname, w.cast("long"))
                     .repartitionByRange(n_parts, *[F.col(g).asc_nulls_first() for g in groups], *order)
                     .withColumn(PID, F.spark_partition_id()))

    part = [PID] + groups
    # One running sum and one total: what follows a row is the total less what
    # precedes it and its own weight. (A frame that ends at the last row but
    # starts after the current one would be summed anew for every row.)
    before_w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = (keyed
             .withColumn(f"{prefix}_lb", F.coalesce(F.sum(wname).over(before_w), F.lit(0)))
             .withColumn(f"{prefix}_la", F.sum(wname).over(Window.partitionBy(*part))
                         - F.col(f"{prefix}_lb") - F.col(wname)))

    sizes = keyed.groupBy(*part).agg(F.sum(wname).alias("_size"))
    by_pid = Window.partitionBy(*groups).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offs = (sizes
            .withColumn("_ob", F.sum("_size").over(by_pid))
            .withColumn("_oa", F.sum("_size").over(Window.partitionBy(*groups))
                        - F.coalesce("_ob", F.lit(0)) - F.col("_size"))
            .withColumn("_oa", F.when(F.col("_oa") > 0, F.col("_oa"))))
    # Only partition-crossing groups have an offset: at most 2N rows (see
    # the module docstring), so broadcasting this side is bounded.
    off = offs.filter(F.col("_ob").isNotNull() | F.col("_oa").isNotNull())
    o = F.broadcast(off.select(*[F.col(c).alias(f"_o_{c}") for c in part], "_ob", "_oa"))
    cond = reduce(lambda a, b: a & b, [local[c].eqNullSafe(o[f"_o_{c}"]) for c in part])
    out = local.join(o, cond, "left").drop(*[f"_o_{c}" for c in part])
    before = F.col(f"{prefix}_lb") + F.coalesce(F.col("_ob"), F.lit(0))
    after = F.col(f"{prefix}_la") + F.coalesce(F.col("_oa"), F.lit(0))
    return (out.withColumn(f"{prefix}_before", before)
               .withColumn(f"{prefix}_after", after)
               .withColumn(f"{prefix}_n", before + F.col(wname) + after)
               .drop(f"{prefix}_lb", f"{prefix}_la", "_ob", "_oa", PID))


def ntile_from_position(rn: Column, n: Column, buckets: int) -> Column:
    """SQL NTILE bucket for 1-based row number ``rn`` of ``n`` rows: the
    first ``n mod b`` buckets get one row more."""
    q = F.floor(n / buckets)
    r = n % buckets
    big = r * (q + 1)
    return (F.when(q == 0, rn)
             .when(rn <= big, F.ceil(rn / (q + 1)))
             .otherwise(r + F.ceil((rn - big) / q))).cast("long")


def distributed_ntile(df: DataFrame, buckets: int, order: list[Column], out_col: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY order)`` over the whole frame, exact.
    ``order`` must be total (end with a unique key)."""
    ranked = rank_positions(df, order, None, None, num_partitions, prefix="_nt")
    rn = F.col("_nt_before") + 1
    return (ranked.withColumn(out_col, ntile_from_position(rn, F.col("_nt_n"), buckets))
                  .drop("_nt_before", "_nt_after", "_nt_n", "_nt_w"))


def _hot_groups(rows: DataFrame, groups: list[str]) -> list[tuple]:
    """Groups (NULL is one) with more than one shuffle partition's worth, 1/N, of
    the rows: fewer than N, picked by a bounded top-k."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = Observation("hot_groups")
    with releasing(rows.sparkSession):
        top = (rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
                   .observe(seen, F.sum("_n").alias("total"))
                   .orderBy(F.col("_n").desc()).limit(n + 1).collect())
    total = seen.get["total"] or 0
    return [tuple(r[g] for g in groups) for r in top if r["_n"] * n > total]


def _interpolated(ranked: DataFrame, group_cols: list[str], value: str, out_col: str,
                  p: float) -> DataFrame:
    """The order statistics beside position ``p`` of each group, interpolated."""
    pos = F.lit(float(p)) * (F.col("_md_n") - 1)
    k1, k2 = F.floor(pos), F.ceil(pos)
    lo, hi = F.col("_md_before"), F.col("_md_before") + F.col("_md_w") - 1
    covers1, covers2 = (k1 >= lo) & (k1 <= hi), (k2 >= lo) & (k2 <= hi)
    v = F.col(value).cast("double")
    agg = (ranked.filter(covers1 | covers2)
                 .groupBy(*group_cols)
                 .agg(F.min(F.when(covers1, v)).alias("_v1"),
                      F.min(F.when(covers2, v)).alias("_v2"),
                      F.first(pos - F.floor(pos)).alias("_frac")))
    return agg.select(*group_cols, (F.col("_v1") + (F.col("_v2") - F.col("_v1")) * F.col("_frac"))
                      .alias(out_col))


def exact_percentile_cont(df: DataFrame, group_cols: list[str], value: str, out_col: str,
                          p: float = 0.5, num_partitions: int | None = None,
                          weight: str | None = None) -> DataFrame:
    """``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value)`` per group, exact.

    Rows of a hot group (more than one shuffle partition's worth) are first
    pre-aggregated to (group, value, count) — map-side combined, so the group
    shrinks to its distinct values — then ranked by weight across range
    partitions. The other groups' rows meet by a hash of their group, in one
    shuffle, and are ranked by a window of the group. The two neighbouring
    order statistics are interpolated in double precision as
    ``lo + (hi - lo) * frac``, the float8 arithmetic of the SQL function. One
    row per group having a non-NULL value. ``weight`` names a column that says
    how many times a row's value stands. With groups ``df`` is read three times:
    give a scan, a written table or a checkpoint."""
    rows = df.filter(F.col(value).isNotNull()).select(
        *group_cols, value, (F.col(weight) if weight else F.lit(1)).cast("long").alias("_cnt"))

    def by_range(some: DataFrame) -> DataFrame:
        counts = some.groupBy(*group_cols, value).agg(F.sum("_cnt").alias("_cnt"))
        ranked = rank_positions(counts, [F.col(value).asc()], group_cols, "_cnt",
                                num_partitions, prefix="_md")
        return _interpolated(ranked, group_cols, value, out_col, p)

    if not group_cols:
        return by_range(rows)
    hot = _hot_groups(rows, group_cols)
    cold = rows
    if hot:
        # At most as many as shuffle partitions: the broadcast is a bounded list.
        marks = F.broadcast(df.sparkSession.createDataFrame([(*g, True) for g in hot], T.StructType(
            [T.StructField(f"_hot_{g}", df.schema[g].dataType) for g in group_cols]
            + [T.StructField("_is_hot", T.BooleanType())])))
        same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_hot_{g}")) for g in group_cols])
        cold = rows.join(marks, same, "left_anti")
        hot_out = by_range(rows.join(marks, same, "left_semi"))
    own = Window.partitionBy(*group_cols)
    earlier = own.orderBy(F.col(value).asc()).rowsBetween(Window.unboundedPreceding, -1)
    cold_out = _interpolated(cold.withColumns({
        "_md_before": F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)),
        "_md_n": F.sum("_cnt").over(own), "_md_w": F.col("_cnt")}), group_cols, value, out_col, p)
    return cold_out.unionByName(hot_out) if hot else cold_out


def exact_median(df: DataFrame, group_cols: list[str], value: str, out_col: str,
                 num_partitions: int | None = None) -> DataFrame:
    """Exact per-group median (``PERCENTILE_CONT(0.5)``)."""
    return exact_percentile_cont(df, group_cols, value, out_col, 0.5, num_partitions)


def rolling_mean_rows(df: DataFrame, order_col: str, value_col: str, out_col: str,
                      preceding: int, num_partitions: int | None = None) -> DataFrame:
    """``AVG(value) OVER (ORDER BY order_col ROWS BETWEEN preceding PRECEDING
    AND CURRENT ROW)`` without a single-partition window: every row gets its
    global position, contributes its value to itself and the next
    ``preceding`` positions (an explode), and the sums are grouped by target
    position. Mean = exact sum (as double) / count of non-NULL values."""
    ranked = rank_positions(df, [F.col(order_col).asc()], None, None, num_partitions, prefix="_mv")
    idx = F.col("_mv_before")
    contrib = ranked.select(F.explode(F.sequence(idx, idx + preceding)).alias("_target"),
                            F.col(value_col).alias("_v"))
    sums = contrib.groupBy("_target").agg(F.sum("_v").alias("_s"), F.count("_v").alias("_c"))
    out = ranked.join(sums, ranked["_mv_before"] == sums["_target"], "left")
    return (out.withColumn(out_col, F.col("_s").cast("double") / F.col("_c"))
               .drop("_target", "_s", "_c", "_mv_before", "_mv_after", "_mv_n", "_mv_w"))
