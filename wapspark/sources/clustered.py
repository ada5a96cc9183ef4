"""Files laid out along a space-filling curve, and reads that skip files.

A table sorted by date alone is read whole by a filter on the user. Here rows
are ordered by the interleaved bits (Z-order) of several columns' places, so a
file covers a small range of each of them, and a table of each file's least and
greatest values tells which files a filter needs:

* a column's place is the number of its own quantile edges at or below the value
  (``2**bits - 1`` edges of one approximate pass), so skewed values spread over
  all places; strings are placed by their first bytes, NULL comes first;
* rows are range-partitioned and sorted by the interleaved places, then by the
  columns themselves; a value that fills many files spans as many;
* after the write, one aggregate by file gives the statistics, stored as a table
  beside the data that names the data's version: readers see both or the pair
  before.

The files that a filter needs are names, a bounded list (``files`` at most).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wapspark.operators.joins import discard, materialize, stored_part
from wapspark.session import ensure_checkpoint_dir
from wapspark.sources.versioned import VersionedTable

BITS = 6


def _number(df: DataFrame, name: str) -> Column:
    """A double in the order of the column's values (strings: of their first
    six bytes)."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def _at(value: Column, edges: list[float], low: int = 0) -> Column:
    """How many ``edges`` (ascending) lie at or below the value, by halves."""
    if not edges:
        return F.lit(low)
    half = len(edges) // 2
    return F.when(value >= edges[half], _at(value, edges[half + 1:], low + half + 1)).otherwise(
        _at(value, edges[:half], low))


def curve_place(df: DataFrame, columns: list[str], bits: int = BITS) -> DataFrame:
    """``df`` with ``_place``, the position along the curve: the columns' places
    with their bits interleaved. Reads ``df`` once for the quantile edges."""
    shares = [(i + 1) / (1 << bits) for i in range((1 << bits) - 1)]
    edges = df.agg(*[F.percentile_approx(_number(df, c), shares, 10_000).alias(f"e{i}")
                     for i, c in enumerate(columns)]).first()
    # Each column's number and place is a column of its own, computed once a row.
    numbered = df.withColumns({f"_value{i}": _number(df, c) for i, c in enumerate(columns)})
    places = {}
    for i in range(len(columns)):
        own = sorted(set(edges[i] or []), key=lambda e: (e != e, e))  # NaN is the greatest
        # NULL has place 0. Few edges spread over all places, or else their
        # column would count for little along the curve.
        places[f"_at{i}"] = F.floor(_at(F.col(f"_value{i}"), own) * F.lit(1 << bits)
                                    / F.lit(len(own) + 1)).cast("long")
    place = F.lit(0).cast("long")
    for i in range(len(columns)):
        for b in range(bits):
            bit = F.shiftright(F.col(f"_at{i}"), b).bitwiseAND(1)
            place = place.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return numbered.withColumns(places).select(*df.columns, place.alias("_place"))


class ClusteredTable:
    """The table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.data = VersionedTable(spark, f"{path.rstrip('/')}/rows")
        self.stats = VersionedTable(spark, f"{path.rstrip('/')}/stats")

    def write(self, df: DataFrame, columns: list[str], files: int = 64, steps: int = 1,
              spent: Callable[[], None] | None = None) -> None:
        """Replace the table, laid out along ``columns`` in about so many files.
        ``df`` is read twice: give a stored table or a checkpoint. With ``steps``
        above 1 the rows are first stored by as many stretches of the curve (the
        next power of two at most), and laid out a stretch at a time, whose stored
        rows and shuffle files go before the next. ``spent`` is called when ``df``
        is read no more."""
        order = [F.col("_place"), *[F.col(c).asc_nulls_first() for c in columns]]

        def laid(placed: DataFrame, files: int) -> DataFrame:
            return (placed.repartitionByRange(files, *order).sortWithinPartitions(*order)
                    .select(*df.columns))

        placed = curve_place(df, columns)
        if steps == 1:
            version = self.data.overwrite(laid(placed, files))
            stretches = None
        else:
            # A stretch is what the first bits of the place have in common.
            first = min((steps - 1).bit_length(), BITS * len(columns))
            stretches = materialize(placed.withColumn("_stretch", F.shiftright(
                "_place", BITS * len(columns) - first).cast("int")), "stretches", by="_stretch")
        if spent:
            spent()
        if stretches is not None:
            sizes = dict(stretches.groupBy("_stretch").count().collect())  # 2 ** first at most
            version = self.data.overwrite(self._each(stretches, sizes, files, laid))
            discard(stretches)
        stored = self.data.read(version)
        found = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("n"),
            *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("lo", F.min), ("hi", F.max))],
            *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in columns])
        self.stats.overwrite(found.withColumn("data_version", F.lit(version)).coalesce(1))

    @staticmethod
    def _each(stretches: DataFrame, sizes: dict[int, int], files: int, laid: Callable):
        """A stretch's rows, laid out, with its share of the files."""
        total = sum(sizes.values())
        for k in sorted(sizes) or [0]:
            yield laid(stored_part(stretches, k), max(1, round(files * sizes.get(k, 0) / max(1, total))))
            discard(stretches, k)

    def files(self, ranges: dict) -> list[str]:
        """Files that may hold rows whose columns lie within all ``ranges``
        (column: (least, greatest), None for an open end)."""
        stats = self.stats.read()
        keep = [F.lit(True)]
        for c, (low, high) in ranges.items():
            keep += [F.col(f"hi_{c}") >= F.lit(low)] if low is not None else []
            keep += [F.col(f"lo_{c}") <= F.lit(high)] if high is not None else []
        return [r["file"] for r in stats.filter(reduce(lambda a, b: a & b, keep)).select("file").collect()]

    def read(self, ranges: dict | None = None) -> DataFrame:
        """Rows within all ``ranges`` (NULL is in none), from the files that may
        hold some; all rows without any."""
        # The data that the statistics tell of, also while a writer is between the two.
        told = self.stats.read().select("data_version").first()
        whole = self.data.read(told[0] if told else None)
        if not ranges:
            return whole
        schema, names = whole.schema, self.files(ranges)
        df = (self.spark.read.schema(schema).parquet(*names) if names
              else self.spark.createDataFrame([], schema))
        for c, (low, high) in ranges.items():
            df = df.filter(F.col(c).isNotNull())
            df = df if low is None else df.filter(F.col(c) >= F.lit(low))
            df = df if high is None else df.filter(F.col(c) <= F.lit(high))
        return df
