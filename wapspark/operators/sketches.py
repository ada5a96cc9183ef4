"""Daily sketches: ranks and distinct counts over merged days.

Exact medians and distinct counts over a span of days need that span's rows
each time. A stored table holds, for each day and class of rows, a rank sketch
(KLL) of the amounts and a set sketch (theta) of the users, made once from the
day's rows; any span is then answered by merging some small binaries:

* quantiles and ranks of a span's amounts, off by at most ``RANK_ERROR`` in rank;
* users of a span, and users of one span that are not in another (set
  difference), off by at most ``SET_ERROR`` of the spans' users; exact up to
  2**``SET_LG`` users.

The bounds hold with a probability of some 99 % each. Sketching is a partial
aggregate: a hot day or class is combined map-side. A day's sketches are
replaced as a whole (``store``), so a repeated or late batch of a day counts
once; the table's parts are months.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wapspark.session import ensure_checkpoint_dir
from wapspark.sources.versioned import VersionedTable

RANK_K = 800
RANK_ERROR = 0.01      # of the rank, for RANK_K entries a level
SET_LG = 12
SET_ERROR = 3 / math.sqrt(1 << SET_LG)


def daily_sketches(rows: DataFrame, class_col: str, day_col: str = "transaction_day",
                   value_col: str = "amount", user_col: str = "user_id") -> DataFrame:
    """Per day and class: ``n`` rows, ``ranks`` of the values, ``users``."""
    return rows.groupBy(F.col(day_col).cast("date").alias("day"), F.col(class_col).alias("class")).agg(
        F.count(F.lit(1)).alias("n"),
        F.kll_sketch_agg_double(F.col(value_col).cast("double"), F.lit(RANK_K)).alias("ranks"),
        F.theta_sketch_agg(F.col(user_col), F.lit(SET_LG)).alias("users"))


class DailySketches:
    """The stored table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, class_col: str):
        self.table, self.class_col = VersionedTable(spark, path, "month"), class_col
        ensure_checkpoint_dir(spark)

    def store(self, rows: DataFrame, **cols) -> None:
        """Replace the sketches of the days that ``rows`` hold; give a day's rows
        whole. Rows without a day belong to none."""
        made = daily_sketches(rows, self.class_col, **cols).filter("day is not null").withColumn(
            "month", F.date_format("day", "yyyyMM").cast("int")).checkpoint()
        months = [r["month"] for r in made.select("month").distinct().collect()]
        old = self.table.read(parts=months)
        if old is not None:
            others = old.join(made.select("day").distinct(), "day", "left_anti")
            made = made.unionByName(others)
        if months:
            self.table.replace_parts(made)

    def read(self) -> DataFrame:
        return self.table.read()


def merged_quantiles(days: DataFrame, by: list[str], points: dict[str, float]) -> DataFrame:
    """Quantiles of all days' values by the columns ``by``."""
    one = days.groupBy(*by).agg(F.kll_merge_agg_double("ranks").alias("ranks"))
    return one.select(*by, "ranks", *[F.when(
        F.kll_sketch_get_n_double("ranks") > 0,
        F.kll_sketch_get_quantile_double("ranks", F.lit(p))).alias(name) for name, p in points.items()])


def ntile_by_edges(edges: list[Column], value: Column) -> Column:
    """NTILE bucket, largest first, from the descending edges between buckets
    that a merged rank sketch gives: off by at most ``RANK_ERROR`` of the rows
    at an edge. NULL is the largest."""
    above = sum(((value < e).cast("long") for e in edges), F.lit(1).cast("long"))
    return F.when(value.isNull(), F.lit(1).cast("long")).otherwise(above)


def _spans(days: DataFrame, length: int, shift: int = 0) -> DataFrame:
    """Each day's row once for every day whose span, ``length`` days that end
    ``shift`` days before it, holds it."""
    ends = F.sequence(F.date_add("day", shift), F.date_add("day", shift + length - 1))
    return days.withColumn("end", F.explode(ends))


def rolling_users(days: DataFrame, length: int = 7) -> DataFrame:
    """For each day of the table: ``users`` of the ``length`` days that end with
    it, and ``new_users`` among them that the ``length`` days before lack."""
    narrow = days.select("day", "users")
    here = _spans(narrow, length).groupBy("end").agg(F.theta_union_agg("users").alias("now"))
    before = _spans(narrow, length, length).groupBy("end").agg(F.theta_union_agg("users").alias("past"))
    known = narrow.select(F.col("day").alias("end")).distinct()
    met = known.join(here, "end", "left").join(before, "end", "left")
    fresh = F.when(F.col("past").isNull(), F.col("now")).otherwise(F.theta_difference("now", "past"))
    return met.select(F.col("end").alias("day"), F.theta_sketch_estimate("now").alias("users"),
                      F.theta_sketch_estimate(fresh).alias("new_users"))


def rolling_users_exact(rows: DataFrame, length: int = 7, day_col: str = "transaction_day",
                        user_col: str = "user_id") -> DataFrame:
    """The same from the rows: each (day, user) once, a flag for the span that
    ends with a day and one for the span before."""
    pairs = rows.select(F.col(day_col).cast("date").alias("day"), F.col(user_col).alias("user")).filter(
        "day is not null").distinct()
    both = _spans(pairs, length).select("end", "user", F.lit(1).alias("now"), F.lit(0).alias("past"))
    both = both.unionByName(_spans(pairs, length, length).select(
        "end", "user", F.lit(0).alias("now"), F.lit(1).alias("past")))
    known = pairs.select(F.col("day").alias("end")).distinct()
    each = both.groupBy("end", "user").agg(F.max("now").alias("now"), F.max("past").alias("past"))
    some = F.col("user").isNotNull()
    return known.join(each, "end", "left").groupBy(F.col("end").alias("day")).agg(
        F.count_if(some & (F.col("now") == 1)).alias("users"),
        F.count_if(some & (F.col("now") == 1) & (F.col("past") == 0)).alias("new_users"),
        F.count_if(some).alias("both_spans"))
