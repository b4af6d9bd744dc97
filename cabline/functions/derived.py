"""Derived measures and flags of the wide table and the feature stage.

All built-in expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of(ts) -> Column:
    return F.hour(_c(ts)).cast("int")


def dow_sunday0(ts) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday (Spark's dayofweek is 1..7)."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def seconds_between(start, end) -> Column:
    """``end - start`` in seconds with fractions; works for TIMESTAMP and TIMESTAMP_NTZ."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)


def trip_duration_min(start, end) -> Column:
    """Minutes, floored at 0; a NULL endpoint yields 0 (greatest skips NULLs)."""
    return F.greatest(seconds_between(start, end) / F.lit(60.0), F.lit(0.0))


def avg_speed_mph(distance, start, end) -> Column:
    """distance / hours when the trip lasts > 0 hours, else NULL."""
    hours = seconds_between(start, end) / F.lit(3600.0)
    return F.when(hours > 0, _c(distance) / hours)


def safe_ratio(num, den, scale: float = 1.0) -> Column:
    """``num / NULLIF(den, 0)``; ANSI-safe (no division-by-zero error)."""
    out = _c(num) / F.nullif(_c(den), F.lit(0.0))
    return out * F.lit(scale) if scale != 1.0 else out


def tip_pct(tip, total, as_percent: bool = False) -> Column:
    """Tip as a fraction of the total (``as_percent`` multiplies by 100)."""
    return safe_ratio(tip, total, 100.0 if as_percent else 1.0)


# Hour windows and weekend days of the feature stage (0 = Sunday numbering).
RUSH_HOURS = ((7, 9), (17, 19))
NIGHT_FROM, NIGHT_TO = 20, 5
WEEKEND_DAYS = (5, 6)


def is_rush_hour(hour) -> Column:
    h = _c(hour)
    cond = None
    for lo, hi in RUSH_HOURS:
        part = (h >= lo) & (h <= hi)
        cond = part if cond is None else (cond | part)
    return cond


def is_night(hour) -> Column:
    h = _c(hour)
    return (h >= NIGHT_FROM) | (h <= NIGHT_TO)


def is_weekend(dow, days: Iterable[int] = WEEKEND_DAYS) -> Column:
    return _c(dow).isin(list(days))


def base_fare_components(fare="fare_amount", extra="extra", mta="mta_tax",
                         improvement="improvement_surcharge") -> Column:
    """NULL-propagating sum of the base fare parts."""
    return _c(fare) + _c(extra) + _c(mta) + _c(improvement)


def tolerant_double(c) -> Column:
    """Numeric parse where bad text becomes NULL instead of an ANSI error."""
    return F.expr(f"try_cast({c} AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")
