"""Slices: order-dependent work on streams that are too large for one task.

A running window needs all rows of its key in one task. That fails when one key,
or a stream without a key, holds a large share of the data. Such *large* keys are
cut into slices, ranges of the order with about the same number of rows each.
A row's slice follows from its own columns and a short list of cut points, so it
is the same on every retry and in every branch of a plan. Rows are then grouped
by ``(key, slice)``. What a slice must know of the slices before it is summed up
in one row per slice and joined back; small keys are never cut and need none of it.

Everything that is broadcast here has at most one row (or a few) per slice, and
there are never more than ``MAX_SLICES`` slices.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from weftline.folders import settled

__all__ = ["HALO", "SLICE", "Sliced", "lookup", "overall", "running", "settled", "slice_rows", "with_halo"]

SLICE = "_slice"
HALO = "_halo"

MAX_SLICES = 200_000
ROWS_PER_SLICE = 1_000_000
LEAST_ROWS_PER_SLICE = 1_000
SAMPLES_PER_SLICE = 32
#: Up to so many slices, about 64,000 sampled rows are sorted on the driver.
DRIVER_SLICES = 2_000
ROWS_PER_SLICE_CONF = "spark.weftline.rowsPerSlice"


@dataclass(frozen=True)
class Sliced:
    """Rows with a slice number: 0 for keys that are whole, from 1 on for cut keys."""

    df: DataFrame
    by: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    pieces: int  # about how many slices' worth of rows there are in all

    @property
    def keys(self) -> list[str]:
        return [*self.by, SLICE] if self.split else list(self.by)

    def window(self, *more: str, reverse: bool = False) -> WindowSpec:
        """Ordered window over one slice; ``more`` adds partition columns."""
        order = [F.desc(c) if reverse else F.asc(c) for c in self.order]
        return Window.partitionBy(*self.keys, *more).orderBy(*order)

    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.keys)

    def order_key(self) -> Column:
        return F.struct(*self.order)

    def summary(self, df: DataFrame, *aggs: Column) -> DataFrame:
        """One row per slice of the cut keys, for a ``df`` that already has windows.

        The conditions are on aggregates (the hash is never null) and read every
        column, so nothing is filtered or pruned below the shuffle and this branch
        reuses the shuffle of the branch that it is joined to.
        """
        grouped = df.groupBy(*self.keys).agg(
            F.max(SLICE).alias("_cut"), F.max(F.xxhash64(*_hashable(self.df))).alias("_all"), *aggs
        )
        return grouped.where("_cut > 0 and _all is not null").drop("_cut", "_all")

    def before(self, *more: str) -> WindowSpec:
        """Over a summary: all earlier slices of the same key."""
        w = Window.partitionBy(*self.by, *more).orderBy(SLICE)
        return w.rowsBetween(Window.unboundedPreceding, -1)

    def after(self, *more: str) -> WindowSpec:
        """Over a summary: all later slices of the same key, nearest first at the end."""
        w = Window.partitionBy(*self.by, *more).orderBy(F.desc(SLICE))
        return w.rowsBetween(Window.unboundedPreceding, -1)

    def everywhere(self, *more: str) -> WindowSpec:
        return Window.partitionBy(*self.by, *more)

    def attach(self, df: DataFrame, carry: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
        """Join a per-slice table (bounded by MAX_SLICES) back to the rows."""
        return lookup(df, carry, [*self.keys, *more])


def lookup(df: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Null-safe broadcast join with a small table of unique or few keys."""
    renamed = table
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_key_{k}")
    match = reduce(lambda a, b: a & b, [df[k].eqNullSafe(renamed[f"_key_{k}"]) for k in keys])
    return df.join(F.broadcast(renamed), match, how).drop(*[f"_key_{k}" for k in keys])


def _hashable(df: DataFrame) -> list[Column]:
    """All columns in a form that can be hashed: maps cannot, so what holds one is hashed as text."""
    return [
        F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema
    ]


def _row_limit(df: DataFrame, total: int, rows_per_slice: int | None, least: int) -> int:
    spark = df.sparkSession
    rows = rows_per_slice or int(spark.conf.get(ROWS_PER_SLICE_CONF, "0"))
    if not rows:
        share = -(-total // (2 * spark.sparkContext.defaultParallelism))
        rows = min(max(share, LEAST_ROWS_PER_SLICE), ROWS_PER_SLICE)
    return max(rows, -(-total // MAX_SLICES), least, 1)


def _sample(df: DataFrame, columns: list[str], rows_per_slice: int) -> DataFrame:
    """A repeatable sample: the choice depends on the row, not on its partition."""
    grain = 1 << 30
    kept = int(min(1.0, SAMPLES_PER_SLICE / rows_per_slice) * grain)
    if kept >= grain:
        return df
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(grain)) < kept)


def _orderly(row) -> list[tuple]:
    """Rows as Spark orders them: null first, NaN last."""
    return [(0, 0) if v is None else (2, 0) if v != v else (1, v) for v in row]


def _cut_points(sample: DataFrame, by: list[str], order: list[str], slices: Column, most: int) -> list:
    """First sampled row of every slice but the first; at most MAX_SLICES rows, in order.

    A sample for up to DRIVER_SLICES slices is sorted on the driver, which saves the jobs of two windows.
    """
    if most <= DRIVER_SLICES:
        rows = sample.select(*by, *order, slices.cast("long").alias("_slices")).collect()
        rows.sort(key=lambda row: _orderly(row[:-1]))
        found = []
        for _, same in groupby(rows, key=lambda row: _orderly(row[: len(by)])):
            held, place = list(same), 0
            for i, row in enumerate(held):
                then = i * row[-1] // len(held)
                if then > place:
                    found.append(tuple(row[:-1]))
                place = then
    else:
        w = Window.partitionBy(*by).orderBy(*order)
        n = F.count(F.lit(1)).over(Window.partitionBy(*by))
        place = F.floor((F.row_number().over(w) - 1) * slices / n)
        placed = sample.select(*by, *order, place.alias("_place"))
        placed = placed.withColumn("_last", F.lag("_place").over(w))
        found = map(tuple, placed.where("_place > _last").select(*by, *order).collect())
    return sorted(set(found), key=_orderly)


def _cuts_at(bounds: Sequence[tuple[tuple, int]], limit: int) -> list[tuple]:
    """The beginnings at which about ``limit`` rows have passed since the last cut."""
    cuts, held = [], 0
    for i, (first, rows) in enumerate(sorted(bounds, key=lambda b: _orderly(b[0]))):
        if i and held + rows / 2 > limit:
            cuts.append(first)
            held = 0
        held += rows
    return cuts


def _reaches(columns: tuple[str, ...], cut: Column) -> Column:
    """Whether a row is at or after a cut point; column by column, without building structs."""
    name = columns[0]
    value, bound = F.col(name), cut[name]
    if len(columns) == 1:
        return value >= bound
    return (value > bound) | ((value == bound) & _reaches(columns[1:], cut))


def _slice_number(columns: tuple[str, ...], cuts: Column, longest: int) -> Column:
    """1 + number of cut points at or before the row, by binary search."""
    steps = [1 << k for k in reversed(range(longest.bit_length()))]
    if not steps:
        return F.lit(1)
    return F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(1),
        lambda at, step: F.when(_reaches(columns, F.get(cuts, at + step - 2)), at + step).otherwise(at),
    )


def slice_rows(
    df: DataFrame,
    by: tuple[str, ...],
    order: tuple[str, ...],
    rows_per_slice: int | None = None,
    cut_on: tuple[str, ...] | None = None,
    least: int = 1,
    bounds: Sequence[tuple[tuple, int]] | None = None,
) -> Sliced:
    """Number the rows of ``df`` by slice. ``order`` columns must be numbers or strings.

    No slice is planned with fewer than ``least`` rows.

    ``cut_on`` is a prefix of ``order`` that must not be cut through: with the time
    alone, rows of equal time stay together.

    Runs one count, and one or two more small jobs if some key has to be cut; none if the ``bounds`` of a layout are given, for a
    stream without ``by``: where parts of it begin in its order, and how many rows they have. Without ``by``
    the stream is always sliced, so it never needs a single task.
    """
    by, order = tuple(by), tuple(order)
    cut_on = tuple(cut_on or order)
    if not by:
        known = bounds if bounds and cut_on == order else None
        total = sum(n for _, n in known) if known else df.count()
        limit = _row_limit(df, total, rows_per_slice, least)
        slices = -(-total // limit)
        cuts = []
        if known and (slices <= 1 or 2 * max(n for _, n in known) <= 3 * limit):
            cuts = _cuts_at(known, limit)
        elif slices > 1:
            sample = _sample(df.select(*order), list(order), limit)
            cuts = _cut_points(sample.select(*cut_on), [], list(cut_on), F.lit(slices), slices)
        if not cuts:
            return Sliced(df.withColumn(SLICE, F.lit(1)), by, order, True, max(slices, 1))
        fields = df.select(*cut_on).schema.simpleString()
        # a literal, as branches with the same literal share a shuffle; decimals go as text and come back typed
        text = json.dumps([dict(zip(cut_on, c)) for c in cuts], default=str)
        cut = df.withColumn(SLICE, _slice_number(cut_on, F.from_json(F.lit(text), f"array<{fields}>"), len(cuts)))
        return Sliced(cut, by, order, True, max(slices, 1))

    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    top = sizes.agg(F.sum("_rows").alias("total"), F.max("_rows").alias("most")).first()
    limit = _row_limit(df, top.total or 0, rows_per_slice, least)
    pieces = max(-(-(top.total or 0) // limit), 1)
    if (top.most or 0) <= limit:
        return Sliced(df.withColumn(SLICE, F.lit(0)), by, order, False, pieces)

    # at most total / limit <= MAX_SLICES keys can be this large
    large = df.sparkSession.createDataFrame(
        sizes.where(F.col("_rows") > limit).collect(), sizes.schema
    )
    sample = lookup(df.select(*by, *order), large, list(by), how="inner")
    sample = _sample(sample, [*by, *order], limit)
    cuts = defaultdict(list)
    for row in _cut_points(
        sample.select(*by, *cut_on, "_rows"), list(by), list(cut_on), F.ceil(F.col("_rows") / limit), pieces
    ):
        cuts[tuple(row[: len(by)])].append(tuple(row[len(by) :]))
    keyed = df.select(*by).schema.simpleString()[len("struct<") : -1]
    fields = df.select(*cut_on).schema.simpleString()
    table = df.sparkSession.createDataFrame(
        [(*k, v) for k, v in cuts.items()], f"{keyed},_cuts:array<{fields}>"
    )
    longest = max(map(len, cuts.values()), default=0)
    number = _slice_number(cut_on, F.col("_cuts"), longest)
    cut = lookup(df, table, list(by))
    cut = cut.withColumn(SLICE, F.when(F.col("_cuts").isNull(), 0).otherwise(number))
    return Sliced(cut.drop("_cuts"), by, order, True, pieces)


# --- running aggregates ------------------------------------------------------------

_LOCAL: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _merge(kind: str, carried: Column, local: Column) -> Column:
    if kind == "sum":
        return F.when(carried.isNull(), local).when(local.isNull(), carried).otherwise(carried + local)
    if kind == "min":
        return F.least(carried, local)
    if kind == "max":
        return F.greatest(carried, local)
    return F.coalesce(local, carried)


def running(
    sl: Sliced,
    df: DataFrame,
    specs: dict[str, tuple[str, Column]],
    exclusive: bool = False,
    reverse: tuple[str, ...] = (),
) -> DataFrame:
    """Add running aggregates in order: name -> (sum | min | max | last, column).

    ``last`` is the last non-null value. ``exclusive`` leaves the row itself out; the
    names in ``reverse`` run from the end to the start.
    """
    end = -1 if exclusive else 0
    frames = {n: sl.window(reverse=n in reverse).rowsBetween(Window.unboundedPreceding, end) for n in specs}
    out = df.select("*", *[_LOCAL[k](c).over(frames[n]).alias(n) for n, (k, c) in specs.items()])
    if not sl.split:
        return out

    def collapse(name: str, kind: str, c: Column) -> Column:
        if kind != "last":
            return _LOCAL[kind](c)
        pick = F.min_by if name in reverse else F.max_by
        return pick(c, F.when(c.isNotNull(), sl.order_key()))

    per_slice = (
        df.where(F.col(SLICE) > 0)
        .groupBy(*sl.keys)
        .agg(*[collapse(n, k, c).alias(f"_c_{n}") for n, (k, c) in specs.items()])
    )
    carry = per_slice.select(
        *sl.keys,
        *[
            _LOCAL[k](F.col(f"_c_{n}")).over(sl.after() if n in reverse else sl.before()).alias(f"_c_{n}")
            for n, (k, _) in specs.items()
        ],
    )
    out = sl.attach(out, carry)
    merged = {n: _merge(k, F.col(f"_c_{n}"), F.col(n)) for n, (k, _) in specs.items()}
    return out.withColumns(merged).drop(*[f"_c_{n}" for n in specs])


def overall(sl: Sliced, df: DataFrame, specs: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add aggregates (sum | min | max) over all rows of a key, without a join on large keys."""
    out = df.select("*", *[_LOCAL[k](c).over(sl.whole()).alias(n) for n, (k, c) in specs.items()])
    if not sl.split:
        return out
    per_slice = (
        df.where(F.col(SLICE) > 0)
        .groupBy(*sl.keys)
        .agg(*[_LOCAL[k](c).alias(f"_c_{n}") for n, (k, c) in specs.items()])
    )
    totals = per_slice.select(
        *sl.keys,
        *[_LOCAL[k](F.col(f"_c_{n}")).over(sl.everywhere()).alias(f"_c_{n}") for n, (k, _) in specs.items()],
    )
    out = sl.attach(out, totals)
    return out.withColumns({n: F.coalesce(F.col(f"_c_{n}"), F.col(n)) for n in specs}).drop(
        *[f"_c_{n}" for n in specs]
    )


def with_halo(sl: Sliced, df: DataFrame, rows: int) -> DataFrame:
    """Add to every slice copies of the ``rows`` rows before it, flagged in ``_halo``.

    Frames of the last ``rows + 1`` rows are then right inside each slice. Usually only
    the slice before gives rows; shorter slices pass older ones through.
    """
    if not sl.split or rows < 1:
        return df.withColumn(HALO, F.lit(False))
    large = df.where(F.col(SLICE) > 0)
    key = Window.partitionBy(*sl.by)
    size = large.groupBy(*sl.keys).agg(F.count(F.lit(1)).alias("_n"))
    ends = size.select(
        *sl.keys,
        "_n",
        F.row_number().over(key.orderBy(SLICE)).alias("_at"),
        F.sum("_n").over(key.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, 0)).alias("_end"),
    )
    # how many following slices start before the last row of this one leaves the frame
    ends = ends.withColumn(
        "_reach", F.count(F.lit(1)).over(key.orderBy("_end").rangeBetween(0, rows - 1))
    )
    tail = large.withColumn("_back", F.row_number().over(sl.window(reverse=True))).where(
        F.col("_back") <= rows
    )
    tail = sl.attach(tail, ends)
    tail = tail.withColumn("_at", F.explode(F.sequence(F.col("_at") + 1, F.col("_at") + F.col("_reach"))))
    tail = tail.withColumn("_rank", F.col("_end") - F.col("_back")).drop(SLICE, "_n", "_end", "_reach", "_back")
    target = ends.select(*sl.by, "_at", SLICE, (F.col("_end") - F.col("_n")).alias("_start"))
    halo = lookup(tail, target, [*sl.by, "_at"], how="inner")
    halo = halo.where(F.col("_rank") >= F.col("_start") - rows)
    return df.withColumn(HALO, F.lit(False)).unionByName(
        halo.select(*df.columns, F.lit(True).alias(HALO))
    )
