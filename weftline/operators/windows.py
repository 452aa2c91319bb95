"""Tumbling, count-sliding and landmark windows, averages and extrema.

Rows without a time are left out (``metrics.untimed`` counts them). Averages are over the values that are not null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.slices import HALO, SLICE, overall, running, slice_rows, with_halo
from weftline.series import Series, mean

# Windows per piece when gaps are filled: keeps the generated arrays short.
_FILL_PIECE = 4096


def _ordered(s: Series, rows_per_slice: int | None = None, least: int = 1):
    """Rows of a series that have a time, with a numeric one, sliced."""
    df = s.timed().withColumn("_t", s.ticks())
    return slice_rows(df, s.by, ("_t", s.seq), rows_per_slice, least=least, bounds=s.bounds)


def _span(seconds: float) -> int:
    return round(seconds * 1_000_000)


def _interval(micros: int) -> str:
    return f"{micros} microseconds"


# --- time windows ------------------------------------------------------------------


def _has_clock(s: Series) -> bool:
    """Whether time is a plain number (a logical clock or epoch seconds)."""
    return isinstance(s.df.schema[s.ts].dataType, T.NumericType)


def _step(s: Series, seconds: float) -> Column:
    if _has_clock(s):
        return F.lit(float(seconds))
    return F.expr(f"INTERVAL '{_span(seconds) / 1e6:.6f}' SECOND")


def tumbling(s: Series, seconds: float) -> DataFrame:
    """``(start, end, count, avg)`` of every closed epoch-aligned window.

    A window is closed once a row at or after its end has arrived in the input, on
    any key; the last, open one is not reported. Empty windows are not reported.
    """
    newest = s.df.agg(F.max(s.ts)).scalar()
    if _has_clock(s):
        start = F.floor(F.col(s.ts) / seconds) * F.lit(float(seconds))
    else:
        start = F.window(s.ts, _interval(_span(seconds)))["start"]
    rows = s.timed().withColumn("_start", start)
    stats = rows.groupBy(*s.by, F.col("_start").alias("start")).agg(
        F.count(F.lit(1)).alias("count"), mean(F.sum(s.value), F.count(s.value)).alias("avg")
    )
    closed = stats.withColumn("end", F.col("start") + _step(s, seconds)).where(F.col("end") <= newest)
    return closed.select(*s.by, "start", "end", "count", "avg")


def tumbling_filled(s: Series, seconds: float, max_windows: int | None = None) -> DataFrame:
    """Tumbling windows with the empty ones as ``count 0, avg 0.0``.

    Runs per key from its first window to its last closed one. ``max_windows`` keeps
    the first windows of each key.
    """
    found = tumbling(s, seconds)
    ends = found.groupBy(*s.by).agg(F.min("start").alias("_first"), F.max("start").alias("_last"))
    if _has_clock(s):
        count = F.round((F.col("_last") - F.col("_first")) / seconds).cast("long")
    else:
        count = F.expr(f"timestampdiff(MICROSECOND, _first, _last) div {_span(seconds)}")
    last = count if max_windows is None else F.least(count, F.lit(max_windows - 1).cast("long"))
    pieces = ends.where(F.col("_first").isNotNull()).select(*s.by, "_first", last.alias("_n"))
    pieces = pieces.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.expr(f"_n div {_FILL_PIECE}"))))
    pieces = pieces.repartition(*s.by, "_piece")
    low = F.col("_piece") * _FILL_PIECE
    steps = pieces.withColumn(
        "_k", F.explode(F.sequence(low, F.least(F.col("_n"), low + (_FILL_PIECE - 1))))
    )
    step = _step(s, seconds)
    if _has_clock(s):
        # windows meet by number: the start of a fractional step is a rounded product
        number = lambda start: F.round(start / seconds).cast("long")
        at = number(F.col("_first")) + F.col("_k")
        grid = steps.select(*s.by, at.alias("_at"), (at * F.lit(float(seconds))).alias("start"))
    else:
        number = lambda start: start
        at = F.col("_first") + F.col("_k") * step
        grid = steps.select(*s.by, at.alias("_at"), at.alias("start"))
    stats = found.drop("end").withColumnsRenamed({c: f"_f_{c}" for c in s.by})
    stats = stats.withColumn("_f_at", number(F.col("start"))).drop("start")
    same = grid["_at"] == stats["_f_at"]
    for c in s.by:
        same = same & grid[c].eqNullSafe(stats[f"_f_{c}"])
    joined = grid.join(stats, same, "left")
    return joined.select(
        *s.by,
        "start",
        (F.col("start") + step).alias("end"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("avg", F.lit(0.0)).alias("avg"),
    )


# --- frames of the last n rows -----------------------------------------------------
#
# A short frame is read anew for every row. A long one is put together from two parts that are known for every row: cut the rows
# into blocks of n, then the last n rows are the end of one block, from the frame's first row on, and the start of the
# next. Running aggregates over each block, one in order and one from its end, give both; so a row costs the same for every n.

#: Frames up to this length are read anew for every row.
SHORT_FRAME = 64

_NUMBER = "_number"
#: An aggregate and how two of its results are put together.
_Fold = tuple[Column, Callable[[Column, Column], Column]]


def _one_or_both(a: Column, b: Column, both: Column) -> Column:
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(both)


def _sum(c: Column) -> _Fold:
    return F.sum(c), lambda a, b: _one_or_both(a, b, a + b)


def _last_rows(s: Series, n: int, folds: dict[str, _Fold], rows_per_slice: int | None) -> DataFrame:
    """Aggregates over the last ``n`` rows up to and including each row, with ``_oldest`` (their first time) and ``_held`` (their
    number). Aggregates may use ``_number``, the place of a row among its neighbours."""
    sl = _ordered(s, rows_per_slice, least=n)
    rows = with_halo(sl, sl.df, n - 1).withColumn(_NUMBER, F.row_number().over(sl.window()).cast("long"))
    held = F.least(F.col(_NUMBER), F.lit(n).cast("long"))
    if n <= SHORT_FRAME:
        frame = sl.window().rowsBetween(-(n - 1), 0)
        out = rows.select("*", F.first(s.ts).over(frame).alias("_oldest"), *[c.over(frame).alias(name) for name, (c, _) in folds.items()])
    else:
        rows = rows.withColumn("_block", F.expr(f"(_number - 1) div {n}"))
        start = sl.window("_block").rowsBetween(Window.unboundedPreceding, 0)
        end = sl.window("_block", reverse=True).rowsBetween(Window.unboundedPreceding, 0)
        parts = rows.select(
            "*",
            *[c.over(start).alias(name) for name, (c, _) in folds.items()],
            *[c.over(end).alias(f"_to_end_{name}") for name, (c, _) in folds.items()],
        )
        across = F.col(_NUMBER) % n != 0  # else the frame is a whole block
        before = {name: F.lag(f"_to_end_{name}", n - 1).over(sl.window()) for name in folds}
        out = parts.select(
            *rows.columns,
            F.when(F.col(_NUMBER) >= n, F.lag(s.ts, n - 1).over(sl.window()))
            .otherwise(F.first(s.ts).over(sl.window().rowsBetween(Window.unboundedPreceding, 0)))
            .alias("_oldest"),
            *[F.when(across, before[name]).alias(f"_before_{name}") for name in folds],
            *folds,
        )
        out = out.withColumns({name: merge(F.col(f"_before_{name}"), F.col(name)) for name, (_, merge) in folds.items()})
    return out.where(~F.col(HALO)).withColumn("_held", held)


def count_sliding(s: Series, n: int = 10, rows_per_slice: int | None = None) -> DataFrame:
    """``(oldest_ts, newest_ts, count, avg, min, max)`` of the last ``n`` rows, per row."""
    value = F.col(s.value)
    out = _last_rows(
        s,
        n,
        {
            "_sum": _sum(value),
            "_values": _sum(F.when(value.isNotNull(), 1).otherwise(0)),
            "min": (F.min(value), F.least),
            "max": (F.max(value), F.greatest),
        },
        rows_per_slice,
    )
    return out.select(
        *s.by,
        F.col("_oldest").alias("oldest_ts"),
        F.col(s.ts).alias("newest_ts"),
        F.col("_held").alias("count"),
        mean(F.col("_sum"), F.nullif(F.col("_values"), F.lit(0))).alias("avg"),
        "min",
        "max",
    )


def moving_average(s: Series, n: int = 20, rows_per_slice: int | None = None) -> DataFrame:
    """Every row with ``moving_avg``: NaN for the first ``n - 1``, then the mean of the last ``n``."""
    value = F.col(s.value)
    folds = {"_sum": _sum(value), "_values": _sum(F.when(value.isNotNull(), 1).otherwise(0))}
    out = _last_rows(s, n, folds, rows_per_slice)
    average = mean(F.col("_sum"), F.nullif(F.col("_values"), F.lit(0)))
    return out.select(*s.columns, F.when(F.col("_held") < n, F.lit(float("nan"))).otherwise(average).alias("moving_avg"))


def window_extrema(s: Series, n: int, largest: bool = True, rows_per_slice: int | None = None) -> DataFrame:
    """Per row, the row that holds the extremum of the last ``n``; ties go to the earliest. Rows without a value hold none; if no
    row has a value, all is null."""
    place = F.struct(F.col(s.value).alias("value"), (F.col(_NUMBER) * (-1 if largest else 1)).alias("at"))
    found = F.struct(place.alias("place"), F.col(s.ts).alias("ts"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(s.values)])
    held = F.when(F.col(s.value).isNotNull(), place)
    best = (F.max_by if largest else F.min_by)(found, held)

    def better(a: Column, b: Column) -> Column:
        first = a["place"] > b["place"] if largest else a["place"] < b["place"]
        return _one_or_both(a, b, F.when(first, a).otherwise(b))

    out = _last_rows(s, n, {"_best": (best, better)}, rows_per_slice)
    return out.select(
        *s.by,
        F.col(s.ts).alias("at_ts"),
        F.col("_best.ts").alias("ts"),
        *[F.col("_best")[f"v{i}"].alias(v) for i, v in enumerate(s.values)],
    )


# --- running aggregates ------------------------------------------------------------


def landmark(
    s: Series,
    start=None,
    floor_second: bool = False,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """``(landmark, ts, count, sum, avg)`` of everything from the landmark on, per row.

    The landmark is the time of the row that arrived first (lowest ``seq``), or
    ``start``; ``floor_second`` cuts it to the full second. Earlier rows are dropped.
    """
    sl = _ordered(s, rows_per_slice)
    arrival = F.struct(s.seq, s.ts)
    if start is not None:
        first = sl.df.withColumn("landmark", F.lit(start).cast(s.df.schema[s.ts].dataType))
    elif not s.by:
        first = sl.df.withColumn("landmark", s.timed().agg(F.min(arrival)[s.ts]).scalar())
    else:
        first = overall(sl, sl.df, {"_first": ("min", arrival)})
        first = first.withColumn("landmark", F.col("_first")[s.ts])
    if floor_second:
        kind = s.df.schema[s.ts].dataType
        full = F.floor("landmark") if _has_clock(s) else F.date_trunc("second", "landmark")
        first = first.withColumn("landmark", full.cast(kind))
    kept = first.where(F.col(s.ts) >= F.col("landmark"))
    held = F.when(F.col(s.value).isNotNull(), 1).otherwise(0).cast("long")
    out = running(
        sl,
        kept,
        {"count": ("sum", F.lit(1).cast("long")), "sum": ("sum", F.col(s.value)), "_held": ("sum", held)},
    )
    return out.select(
        *s.by,
        "landmark",
        F.col(s.ts).alias("ts"),
        "count",
        "sum",
        mean(F.col("sum"), F.col("_held")).alias("avg"),
    )


def landmark_points(s: Series, max_points: int | None = None, rows_per_slice: int | None = None) -> DataFrame:
    """``(landmark, ts, count, avg)`` with the landmark on the full second; ``max_points`` keeps the first."""
    points = landmark(s, floor_second=True, rows_per_slice=rows_per_slice).drop("sum")
    return points if max_points is None else points.where(F.col("count") <= max_points)


def running_min_max(s: Series, rows_per_slice: int | None = None) -> DataFrame:
    """Running ``(min, max)`` per row; the time itself is not reported."""
    sl = _ordered(s, rows_per_slice)
    out = running(sl, sl.df, {"min": ("min", F.col(s.value)), "max": ("max", F.col(s.value))})
    return out.select(*s.by, "min", "max")


def record_extrema(
    s: Series, column: str | None = None, largest: bool = False, rows_per_slice: int | None = None
) -> DataFrame:
    """Rows that strictly beat every earlier value of ``column``."""
    name = column or s.value
    sl = _ordered(s, rows_per_slice)
    best = ("max" if largest else "min", F.col(name))
    out = running(sl, sl.df, {"_best": best}, exclusive=True)
    value, held = F.col(name), F.col("_best")
    beats = value > held if largest else value < held
    return out.where(value.isNotNull() & (held.isNull() | beats)).select(*s.columns)


# --- ranks -------------------------------------------------------------------------


def ranked(s: Series, name: str = "rank", rows_per_slice: int | None = None, keep_slice: bool = False) -> DataFrame:
    """Every row with its 1-based position in its stream."""
    sl = _ordered(s, rows_per_slice)
    out = running(sl, sl.df, {name: ("sum", F.lit(1).cast("long"))})
    return out.drop("_t") if keep_slice else out.drop("_t", SLICE)
