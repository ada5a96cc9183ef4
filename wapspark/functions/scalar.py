"""Scalar Column functions (inventory F1–F25).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Where PostgreSQL and Spark disagree (NULL handling of CONCAT, day-of-week
numbering, truncating VARCHAR casts) the PostgreSQL meaning is kept.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_lit(as_of: dt.datetime | None) -> Column:
    """The evaluation instant; ``None`` means the query's current time."""
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    # From the wall-clock text: a Python datetime literal would pass through
    # the session time zone.
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def varchar(c: ColumnOrName, n: int) -> Column:
    """``::VARCHAR(n)``: an explicit cast truncates to n characters (F2)."""
    return F.substring(_c(c).cast("string"), 1, n)


def day_trunc(ts: ColumnOrName) -> Column:
    """``DATE_TRUNC('day', ts)`` kept as a zone-less timestamp (F5). Built
    from the calendar date, so the session time zone cannot shift it."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def pg_dow(ts: ColumnOrName) -> Column:
    """``EXTRACT(DOW)``: Sunday = 0 … Saturday = 6."""
    return F.dayofweek(_c(ts)) - 1


def pg_concat(*cols: ColumnOrName) -> Column:
    """PostgreSQL ``CONCAT`` skips NULL arguments."""
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def minutes_since(as_of: Column, ts: ColumnOrName) -> Column:
    """``EXTRACT(EPOCH FROM as_of - ts) / 60`` as double (F9), on wall-clock
    (zone-less) timestamps: no DST shift whatever the session time zone."""
    return micros_between(_c(ts), as_of) / F.lit(60_000_000.0)


def micros_between(start: Column, end: Column) -> Column:
    """``end - start`` in microseconds on zone-less timestamps."""
    return F.timestamp_diff("MICROSECOND", start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))


def ms_to_kmh(c: ColumnOrName) -> Column:
    """Wind speed m/s → km/h rounded to 2 places."""
    return F.round((_c(c) * F.lit(3.6)).cast("decimal(18,6)"), 2)


def date_path(ts: ColumnOrName) -> Column:
    """Landing-path date part ``YYYY/MM/DD``."""
    return F.date_format(F.to_date(_c(ts)), "yyyy/MM/dd")


def uuid_if_falsy(c: ColumnOrName) -> Column:
    """Source id, or a fresh UUID when it is NULL, '' or 0.
    ``uuid()`` is non-deterministic: persist or write before using twice."""
    s = _c(c).cast("string")
    return F.when(s.isNull() | s.isin("", "0"), F.expr("uuid()")).otherwise(s)


# Fixed tier thresholds and labels of the staging model.
QUALITY_HIGH, QUALITY_MEDIUM = 0.9, 0.7
VALUE_HIGH, VALUE_MEDIUM = 1000, 100


def quality_tier(score: ColumnOrName) -> Column:
    """high ≥ 0.9, medium ≥ 0.7, else (and NULL) low; on the unrounded score."""
    s = _c(score)
    return (F.when(s >= F.lit(QUALITY_HIGH), "high")
             .when(s >= F.lit(QUALITY_MEDIUM), "medium")
             .otherwise("low"))


def value_tier(amount: ColumnOrName) -> Column:
    a = _c(amount)
    return (F.when(a >= VALUE_HIGH, "high_value")
             .when(a >= VALUE_MEDIUM, "medium_value")
             .otherwise("low_value"))


def deviation_pct(amount: ColumnOrName, avg: ColumnOrName) -> Column:
    """Percent deviation from an average, NULL unless the average is > 0."""
    a, m = _c(amount).cast("double"), _c(avg)
    return F.when(m > 0, F.round((a - m) / m * 100, 2))


def composite_score(dq: ColumnOrName, user_count: ColumnOrName,
                    amount: ColumnOrName, category_avg: ColumnOrName) -> Column:
    """0.4·dq + (0.3 if user count > 10 else 0.1) + (0.3 if amount above the
    category average else 0.1), rounded to 2 places (F16). Decimal literals
    keep the sum exact; NULL metrics take the 0.1 branch; NULL dq → NULL."""
    hi, lo = F.lit(0.3).cast("decimal(2,1)"), F.lit(0.1).cast("decimal(2,1)")
    return F.round(
        _c(dq) * F.lit(0.4).cast("decimal(2,1)")
        + F.when(_c(user_count) > 10, hi).otherwise(lo)
        + F.when(_c(amount) > _c(category_avg), hi).otherwise(lo), 2)


# Fixed labels of the fact model (F17): quarter, semester, Spanish day names
# indexed by PostgreSQL day of week (0 = Sunday), and day type.
DAY_NAMES = ["Domingo", "Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado"]
WEEKEND_LABEL, WORKDAY_LABEL = "Fin de Semana", "Dia Laboral"


def quarter_label(month: ColumnOrName) -> Column:
    m = _c(month)
    return (F.when(m.isin(1, 2, 3), "Q1").when(m.isin(4, 5, 6), "Q2")
             .when(m.isin(7, 8, 9), "Q3").otherwise("Q4"))


def semester_label(month: ColumnOrName) -> Column:
    return F.when(_c(month) <= 6, "H1").otherwise("H2")


def day_name(dow: ColumnOrName) -> Column:
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    d = _c(dow)
    return F.when(d.between(0, 6), F.element_at(names, (d + 1).cast("int")))


def is_weekend(dow: ColumnOrName) -> Column:
    return F.when(_c(dow).isin(0, 6), True).otherwise(False)


def day_type(dow: ColumnOrName) -> Column:
    return F.when(_c(dow).isin(0, 6), WEEKEND_LABEL).otherwise(WORKDAY_LABEL)
