"""Selection, projection, and keeping only a part of a series."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.slices import SLICE, running, slice_rows
from weftline.series import Series

_COMPARE = {
    ">": operator.gt,
    "<": operator.lt,
    ">=": operator.ge,
    "<=": operator.le,
    "=": operator.eq,
    "!=": operator.ne,
}

# Up to this many rows per key, Spark drops surplus rows before the shuffle.
_SMALL = 1000


def _attribute(s: Series, attribute: str | int) -> str:
    """Name of an attribute given by name or position (0 is the time)."""
    return [s.ts, *s.values][attribute] if isinstance(attribute, int) else attribute


def select(s: Series, predicates: list[tuple[str | int, str, object]]) -> Series:
    """Rows for which every ``(attribute, operator, constant)`` holds; none keeps all."""
    tests = [_COMPARE[op](F.col(_attribute(s, a)), F.lit(c)) for a, op, c in predicates]
    return s.where(reduce(lambda a, b: a & b, tests)) if tests else s


def project(s: Series, attributes: list[str | int]) -> DataFrame:
    """The listed attributes, in order and with repeats; the time is put first if missing."""
    names = [_attribute(s, a) for a in attributes]
    if s.ts not in names:
        names = [s.ts, *names]
    seen: dict[str, int] = {}
    columns: list[Column] = []
    for n in names:
        seen[n] = seen.get(n, 0) + 1
        columns.append(F.col(n).alias(n if seen[n] == 1 else f"{n}_{seen[n]}"))
    return s.df.select(*s.by, *columns)


def identity(s: Series) -> DataFrame:
    """The series as it is."""
    return s.rows()


def keep_latest(s: Series, n: int, rows_per_slice: int | None = None) -> DataFrame:
    """The newest ``n`` rows of each stream: what a full buffer of that size still holds."""
    if n <= _SMALL and not s.by:
        return s.timed().orderBy(F.desc(s.ts), F.desc(s.seq)).limit(n)
    if n <= _SMALL:
        newest = Window.partitionBy(*s.by).orderBy(F.desc(s.ts), F.desc(s.seq))
        return s.timed().withColumn("_k", F.row_number().over(newest)).where(F.col("_k") <= n).drop("_k")
    df = s.timed().withColumn("_t", s.ticks())
    sl = slice_rows(df, s.by, ("_t", s.seq), rows_per_slice)
    counted = running(sl, sl.df, {"_k": ("sum", F.lit(1).cast("long"))}, reverse=("_k",))
    return counted.where(F.col("_k") <= n).drop("_k", "_t", SLICE)


def shed_count(s: Series, n: int) -> DataFrame:
    """How many rows a buffer of ``n`` rows has overwritten, per key."""
    total = F.count(F.lit(1))
    return s.df.groupBy(*s.by).agg(F.greatest(total - n, F.lit(0)).alias("shed"))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in order; sorts no more than ``n`` rows per task."""
    return df.orderBy(*order).limit(n)
