"""Output typing for cross-engine comparison.

Registered queries expose integers as ``bigint`` and decimals as ``double``
(DuckDB returns BIGINT for EXTRACT/NTILE/COUNT and doubles for averages, so
both sides are cast to the same simple types). Money stays decimal inside
the library; only the registered outputs are cast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame, round_cols: dict[str, int] | None = None) -> DataFrame:
    round_cols = round_cols or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        if f.name in round_cols:
            c = F.round(c, round_cols[f.name])
        cols.append(c.alias(f.name))
    return df.select(*cols)
