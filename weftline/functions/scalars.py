"""Column helpers for readings and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.series import Series


def watt_hours(watts: Column, seconds: Column) -> Column:
    """Energy of a constant load over a time."""
    return watts * seconds / 3600


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


# Readings that stand in for a failed sensor.
FALLBACKS = {"humidity": 50.0, "pressure": 1013.25, "compass": 0.0}


def reading_or_fallback(value: Column, kind: str) -> Column:
    """The reading, or the fixed value of its kind if the read failed (null)."""
    return F.coalesce(value, F.lit(FALLBACKS[kind]))


def relative_time(s: Series) -> Column:
    """Seconds since the first row of the whole series (same unit for a numeric clock)."""
    first = s.df.agg(F.min(s.ticks())).scalar()
    passed = s.ticks() - first
    return passed if isinstance(s.df.schema[s.ts].dataType, T.NumericType) else passed / 1e6


def time_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def bucket_start(ts: Column | str, seconds: float) -> Column:
    """Start of the epoch-aligned bucket of a timestamp."""
    return F.window(ts, f"{round(seconds * 1_000_000)} microseconds")["start"]


def floor_second(ts: Column | str) -> Column:
    return F.date_trunc("second", ts)


def nearest_of_two(t: Column, a: Column, b: Column, a_time: Column, b_time: Column) -> Column:
    """``a`` if its time is strictly nearer to ``t``, else ``b``."""
    return F.when(F.abs(t - a_time) < F.abs(t - b_time), a).otherwise(b)
