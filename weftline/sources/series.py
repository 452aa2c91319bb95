"""Named series out of one table, and logical clocks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.slices import SLICE, settled
from weftline.operators.windows import ranked
from weftline.series import Series


def named_series(
    df: DataFrame,
    name: str,
    name_column: str,
    ts: str,
    seq: str,
    values: dict[str, Column],
    by: tuple[str, ...] = (),
) -> Series:
    """The rows of one name; the filter reaches the scan (or the partition listing)."""
    picked = df.where(F.col(name_column) == name).select(
        *by, F.col(ts).alias("ts"), F.col(seq).alias("seq"), *[c.alias(n) for n, c in values.items()]
    )
    return Series(picked, by=by, values=tuple(values))


def logical_clock(s: Series, step: float, rows_per_slice: int | None = None) -> Series:
    """The series with the time of its k-th row replaced by ``k * step``, from 0.0 on.

    A series without a key is written once, in its slices: what comes after it neither numbers its rows again nor looks for cuts.
    """
    counted = ranked(s, "_rank", rows_per_slice, keep_slice=True)
    stamped = counted.withColumn(s.ts, (F.col("_rank") - 1) * F.lit(float(step)))
    if s.by:
        return s.with_df(stamped.select(*s.columns))
    stamped = settled(stamped.select(*s.columns, SLICE))
    first = F.min(F.struct(s.ts, s.seq)).alias("first")
    slices = stamped.groupBy(SLICE).agg(first, F.count(F.lit(1)).alias("rows")).collect()  # at most MAX_SLICES rows
    bounds = sorted(((r.first[0], r.first[1]), r.rows) for r in slices if r.first[1] is not None)
    return replace(s, df=stamped.drop(SLICE), bounds=tuple(bounds))
