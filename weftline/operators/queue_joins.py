"""Consuming time joins as a queue that one stream fills and the other empties.

Merge both streams by time. Rows of one side are pushed, each row of the other side
pops one waiting row and is joined with it; a pop that finds nothing waiting is
dropped. Pushes go before pops of the same time.

* fuzzy merge join: dominant rows wait for the first later row of the other side -
  first in, first out;
* bufferless join, oldest first: recessive rows wait, dominant rows pop the oldest;
* bufferless join, newest first: the same, but the newest waiting row is popped.

The queue itself is never built. With ``raw`` = pushes minus pops so far and
``low = min(0, running min of raw)``, a pop is dropped exactly when it lowers ``low``,
and ``-low`` counts the drops. A label then says which push and pop belong together:
the position in the queue (first in, first out) or the depth of the stack (last in,
first out). Rows of the same label alternate push, pop, push, ..., so the partner of
a pop is the row before it under its label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.slices import SLICE, Sliced, slice_rows
from weftline.series import Series

_ORDER = ("_t", "_side", "_seq")


def merge(*series: Series, keep: list[list[str]] | None = None) -> DataFrame:
    """All series in one frame, without rows that have no time: key, ``_t``, ``_side`` (0, 1, ..), ``_seq`` and a row struct per side.

    The struct ``_row<side>`` has the fields ``ts``, ``seq`` and the values, or those in
    ``keep``; without any there is no struct. Carry no field that is not used later: then
    all branches of a plan read the same columns and can share one shuffle.
    """
    by = series[0].by
    if any(s.by != by for s in series):
        raise ValueError("joined series need the same key columns")

    def side(i: int, s: Series) -> DataFrame:
        names = ["ts", "seq", *s.values] if keep is None else keep[i]
        source = {"ts": s.ts, "seq": s.seq}
        fields = [F.col(source.get(n, n)).alias(n) for n in names]
        return s.df.where(F.col(s.ts).isNotNull()).select(
            *by,
            s.ticks().alias("_t"),
            F.lit(i).alias("_side"),
            F.col(s.seq).alias("_seq"),
            *([F.struct(*fields).alias(f"_row{i}")] if fields else []),
        )

    out = side(0, series[0])
    for i, s in enumerate(series[1:], 1):
        out = out.unionByName(side(i, s), allowMissingColumns=True)
    return out


def merged_bounds(*series: Series) -> list[tuple[tuple, int]] | None:
    """Where the slices of written series begin in the order (t, side, seq) of ``merge``; null if one of them has none."""
    if any(s.bounds is None for s in series):
        return None
    return [((first[0], i, *first[1:]), rows) for i, s in enumerate(series) for first, rows in s.bounds]


def _queue(
    push: Series, pop: Series, rows_per_slice: int | None, keep: list[list[str]] | None = None
) -> tuple[Sliced, DataFrame]:
    """Merged rows with ``_raw``, ``_low``, ``_low_before``, ``_pushes`` and ``_all_pushes``."""
    sl = slice_rows(merge(push, pop, keep=keep), push.by, _ORDER, rows_per_slice, bounds=merged_bounds(push, pop))
    pushed = F.when(F.col("_side") == 0, 1).otherwise(0).cast("long")
    step = F.when(F.col("_side") == 0, 1).otherwise(-1).cast("long")
    w = sl.window()
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    local = sl.df.select(
        "*",
        F.sum(step).over(so_far).alias("_raw"),
        F.sum(pushed).over(so_far).alias("_pushes"),
    ).select("*", F.min("_raw").over(so_far).alias("_min"), F.min("_raw").over(earlier).alias("_min_before"))
    local = local.withColumn("_all_pushes", F.sum(pushed).over(sl.whole()))
    zero = F.lit(0).cast("long")
    if not sl.split:
        return sl, local.withColumns(
            {"_low": F.least(zero, "_min"), "_low_before": F.least(zero, "_min_before")}
        ).drop("_min", "_min_before")

    slices = sl.summary(
        local,
        F.sum(step).alias("_s_raw"),
        F.max("_pushes").alias("_s_pushes"),
        F.min("_raw").alias("_s_min"),
    )
    starts = slices.select(
        *sl.keys,
        "_s_min",
        F.coalesce(F.sum("_s_raw").over(sl.before()), zero).alias("_c_raw"),
        F.coalesce(F.sum("_s_pushes").over(sl.before()), zero).alias("_c_pushes"),
        F.sum("_s_pushes").over(sl.everywhere()).alias("_c_all"),
    )
    carry = starts.withColumn(
        "_c_low", F.least(zero, F.min(F.col("_c_raw") + F.col("_s_min")).over(sl.before()))
    ).drop("_s_min")
    rows = sl.attach(local, carry)
    raw = F.coalesce("_c_raw", zero)
    low = F.coalesce("_c_low", zero)
    return sl, rows.select(
        *sl.df.columns,
        (F.col("_raw") + raw).alias("_raw"),
        (F.col("_pushes") + F.coalesce("_c_pushes", zero)).alias("_pushes"),
        F.coalesce("_c_all", "_all_pushes").alias("_all_pushes"),
        F.least(low, F.col("_min") + raw).alias("_low"),
        F.least(low, F.col("_min_before") + raw).alias("_low_before"),
    )


def _is_push() -> Column:
    return F.col("_side") == 0


def _dropped() -> Column:
    return (F.col("_side") == 1) & (F.col("_low") < F.col("_low_before"))


def queue_pairs(
    push: Series,
    pop: Series,
    newest: bool,
    rows_per_slice: int | None = None,
    keep: list[list[str]] | None = None,
) -> DataFrame:
    """Joined rows as ``by..., _row0 (pushed), _row1 (popped by)``; see ``merge`` for ``keep``."""
    sl, rows = _queue(push, pop, rows_per_slice, keep)
    if newest:
        depth = F.col("_raw") - F.col("_low")
        label = F.when(_is_push(), depth).otherwise(depth + 1)
    else:
        popped = F.col("_pushes") - F.col("_raw") + F.col("_low")
        label = F.when(_is_push(), F.col("_pushes")).otherwise(popped)
    live = rows.where(~_dropped()).select(
        *push.by, SLICE, *_ORDER, "_row0", "_row1", label.alias("_label")
    )
    here = sl.window("_label")
    near = live.withColumn("_mate", F.lag("_row0").over(here))
    found = near.where((F.col("_side") == 1) & F.col("_mate").isNotNull())
    pairs = found.select(*push.by, F.col("_mate").alias("_row0"), "_row1")
    if not sl.split:
        return pairs

    # What a slice could not settle: at most one push and one pop per label and slice.
    near = near.withColumn("_next", F.lead("_side").over(here))
    unsettled = F.when(_is_push(), F.col("_next").isNull()).otherwise(F.col("_mate").isNull())
    open_rows = near.where(F.when(F.col(SLICE) > 0, unsettled).otherwise(False))
    across = Window.partitionBy(*push.by, "_label").orderBy(*_ORDER)
    far = open_rows.withColumn("_mate", F.lag("_row0").over(across))
    far = far.where((F.col("_side") == 1) & F.col("_mate").isNotNull())
    return pairs.unionByName(far.select(*push.by, F.col("_mate").alias("_row0"), "_row1"))


def queue_drops(push: Series, pop: Series, rows_per_slice: int | None = None) -> DataFrame:
    """Pops that found nothing waiting, with the running count and whether pushes follow."""
    _, rows = _queue(push, pop, rows_per_slice, keep=[[], ["ts"]])
    return rows.where(_dropped()).select(
        *push.by,
        F.col("_row1.ts").alias("ts"),
        (-F.col("_low")).alias("dropped_so_far"),
        (F.col("_pushes") < F.col("_all_pushes")).alias("_push_follows"),
    )


def _payload(row: str, s: Series, prefix: str) -> list[Column]:
    return [F.col(row)[v].alias(f"{prefix}_{v}") for v in s.values]


def fuzzy_merge_join(s: Series, t: Series, rows_per_slice: int | None = None) -> DataFrame:
    """``(ts, s values, t values)``: each S with the first unused T at or after it.

    T rows that are passed over are used up as well; S rows without a partner wait.
    """
    pairs = queue_pairs(s, t, False, rows_per_slice, keep=[["ts", *s.values], [*t.values]])
    return pairs.select(
        *s.by, F.col("_row0.ts").alias("ts"), *_payload("_row0", s, "s"), *_payload("_row1", t, "t")
    )


def fuzzy_merge_drops(s: Series, t: Series, rows_per_slice: int | None = None) -> DataFrame:
    """``(ts, dropped_so_far)`` of every T the fuzzy merge join passed over."""
    drops = queue_drops(s, t, rows_per_slice)
    return drops.where("_push_follows").drop("_push_follows")


def bufferless_newest_join(d: Series, n: Series, rows_per_slice: int | None = None) -> DataFrame:
    """``(ts, d values, n_ts, n values)``: each D with the newest unused N at or before it."""
    pairs = queue_pairs(n, d, True, rows_per_slice, keep=[["ts", *n.values], ["ts", *d.values]])
    return pairs.select(
        *d.by,
        F.col("_row1.ts").alias("ts"),
        *_payload("_row1", d, "d"),
        F.col("_row0.ts").alias("n_ts"),
        *_payload("_row0", n, "n"),
    )


def bufferless_oldest_join(d: Series, n: Series, rows_per_slice: int | None = None) -> DataFrame:
    """``(ts, d values, n values)``: each D with the oldest unused N, if that is not later."""
    pairs = queue_pairs(n, d, False, rows_per_slice, keep=[[*n.values], ["ts", *d.values]])
    return pairs.select(
        *d.by, F.col("_row1.ts").alias("ts"), *_payload("_row1", d, "d"), *_payload("_row0", n, "n")
    )


def bufferless_drops(d: Series, n: Series, rows_per_slice: int | None = None) -> DataFrame:
    """``(ts, dropped_so_far)`` of every D without a partner; the same for both orders."""
    return queue_drops(n, d, rows_per_slice).drop("_push_follows")
