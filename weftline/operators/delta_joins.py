"""Symmetric minimal delta join: every row with its nearest rows of the other stream.

Both streams are walked in one order, time first, stream one before stream two at
equal times. A row joins the rows of the other stream at the least distance: the one
before it (``x``), the one after it (``y``), or both. A later partner that comes next
after a change of stream is passed over, and what lies before it is then no longer
available to the run of rows that it opens.

Cut the order into *runs* of rows of one stream. Whether the first row of run r + 1 is
passed over depends on run r alone, as a function of whether r's own first row was:

* the last row of r takes ``y`` and r has several rows: yes;
* it takes ``y`` and r is a single row: the opposite of r;
* it does not take ``y`` and r is a single row: no;
* otherwise: the same as r.

So the answer is the last constant before a row, flipped once per "opposite" since:
two running aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.queue_joins import merge, merged_bounds
from weftline.operators.slices import Sliced, running, slice_rows
from weftline.series import Series

_ORDER = ("_t", "_side", "_seq")


def _neighbours(sl: Sliced) -> DataFrame:
    """Add the previous and next row of either stream: ``_prev0, _prev1, _next0, _next1``."""

    def rows_of(side: int) -> Column:
        return F.when(F.col("_side") == side, F.struct(*_ORDER, "_row0", "_row1"))

    specs = {f"_{way}{side}": ("last", rows_of(side)) for way in ("next", "prev") for side in (0, 1)}
    return running(sl, sl.df, specs, exclusive=True, reverse=("_next0", "_next1"))


def _with_turns(sl: Sliced, rows: DataFrame) -> DataFrame:
    """Add ``_x``, ``_y``, ``_first`` (opens a run) and ``_skip`` (the run's opener is passed over)."""
    mine = F.col("_side") == 0

    def pick(same: bool, when: str) -> Column:
        a, b = (f"_{when}0", f"_{when}1") if same else (f"_{when}1", f"_{when}0")
        return F.when(mine, F.col(a)).otherwise(F.col(b))

    def place(c: str) -> Column:
        return F.struct(*[F.col(c)[o] for o in _ORDER])

    rows = rows.select(
        *sl.df.columns,
        pick(False, "prev").alias("_x"),
        pick(False, "next").alias("_y"),
        pick(True, "prev").alias("_same_before"),
        pick(True, "next").alias("_same_after"),
    )
    x, y = F.col("_x"), F.col("_y")
    first = F.col("_same_before").isNull() | (x.isNotNull() & (place("_x") > place("_same_before")))
    last = F.col("_same_after").isNull() | (y.isNotNull() & (place("_y") < place("_same_after")))
    takes_y = x.isNull() | (y["_t"] - F.col("_t") <= F.col("_t") - x["_t"])
    rows = rows.withColumns({"_first": first, "_ends": last & y.isNotNull(), "_takes_y": takes_y})
    flips = F.when(F.col("_ends") & F.col("_first") & F.col("_takes_y"), 1).otherwise(0).cast("long")
    rows = rows.select(
        *sl.df.columns, "_x", "_y", "_first", flips.alias("_flip"),
        F.when(F.col("_ends") & (F.col("_first") != F.col("_takes_y")), F.col("_takes_y").cast("int"))
        .alias("_set"),
    )

    so_far = sl.window().rowsBetween(Window.unboundedPreceding, 0)
    earlier = sl.window().rowsBetween(Window.unboundedPreceding, -1)
    # a constant is kept as "value, undone by the flips so far", so later flips just add up
    local = rows.withColumn("_flips", F.sum("_flip").over(so_far))
    local = local.withColumn("_mark", F.col("_set").bitwiseXOR((F.col("_flips") % 2).cast("int")))
    local = local.select(
        "*",
        F.last("_mark", ignorenulls=True).over(earlier).alias("_marked"),
        (F.col("_flips") - F.col("_flip")).alias("_flips_before"),
    )
    if sl.split:
        at = F.when(F.col("_mark").isNotNull(), sl.order_key())
        slices = sl.summary(
            local, F.sum("_flip").alias("_s_flips"), F.max_by("_mark", at).alias("_s_mark")
        )
        starts = slices.select(
            *sl.keys,
            "_s_mark",
            F.coalesce(F.sum("_s_flips").over(sl.before()), F.lit(0).cast("long")).alias("_c_flips"),
        )
        parity = (F.col("_c_flips") % 2).cast("int")
        carry = starts.withColumn(
            "_c_mark",
            F.last(F.col("_s_mark").bitwiseXOR(parity), ignorenulls=True).over(sl.before()),
        ).drop("_s_mark")
        local = sl.attach(local, carry)
        carried = F.coalesce("_c_flips", F.lit(0).cast("long"))
        undo = (carried % 2).cast("int")
        local = local.withColumns(
            {
                "_marked": F.coalesce(F.col("_marked").bitwiseXOR(undo), F.col("_c_mark")),
                "_flips_before": F.col("_flips_before") + carried,
            }
        )
    skip = F.coalesce("_marked", F.lit(0)).bitwiseXOR((F.col("_flips_before") % 2).cast("int")) == 1
    return local.withColumn("_skip", skip)


def delta_pairs(
    one: Series,
    two: Series,
    rows_per_slice: int | None = None,
    keep: list[list[str]] | None = None,
) -> DataFrame:
    """Joined rows as ``by..., _side`` (0: one is dominant), ``_row0, _row1``; see ``merge``."""
    sl = slice_rows(merge(one, two, keep=keep), one.by, _ORDER, rows_per_slice, bounds=merged_bounds(one, two))
    rows = _with_turns(sl, _neighbours(sl))
    x, y, t = F.col("_x"), F.col("_y"), F.col("_t")
    walked = rows.where(y.isNotNull() & ~(F.col("_first") & F.col("_skip")))
    far_x, far_y = t - x["_t"], y["_t"] - t
    partners = (
        F.when(x.isNull() | F.col("_skip") | (far_y < far_x), F.array("_y"))
        .when(far_x < far_y, F.array("_x"))
        .otherwise(F.array("_x", "_y"))
    )
    pairs = walked.select(*one.by, "_side", "_row0", "_row1", F.explode(partners).alias("_mate"))
    return pairs.select(
        *one.by, "_side", *[F.coalesce(r, F.col("_mate")[r]).alias(r) for r in ("_row0", "_row1")]
    )


def minimal_delta_join(one: Series, two: Series, rows_per_slice: int | None = None) -> DataFrame:
    """``(ts, dominant, d values, p values)``: dominant row, then its partner without the time.

    ``dominant`` is 1 or 2; values are matched by position and named after stream one.
    """
    if len(one.values) != len(two.values):
        raise ValueError("both streams need the same number of values; see delta_pairs")
    pairs = delta_pairs(one, two, rows_per_slice, keep=[["ts", *s.values] for s in (one, two)])
    mine = F.col("_side") == 0

    def value(i: int, dominant: bool) -> Column:
        a, b = F.col("_row0")[one.values[i]], F.col("_row1")[two.values[i]]
        chosen = F.when(mine, a).otherwise(b) if dominant else F.when(mine, b).otherwise(a)
        return chosen.alias(f"{'d' if dominant else 'p'}_{one.values[i]}")

    places = range(len(one.values))
    return pairs.select(
        *one.by,
        F.when(mine, F.col("_row0.ts")).otherwise(F.col("_row1.ts")).alias("ts"),
        (F.col("_side") + 1).alias("dominant"),
        *[value(i, True) for i in places],
        *[value(i, False) for i in places],
    )
