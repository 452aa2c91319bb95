"""Structured Streaming: rows of a key in event-time order, whatever order they arrive in.

Keys are dealt over bundles. The rows of a micro-batch are sorted per bundle, so many at a time, and wait in state as runs, until the watermark
has passed them; the due parts of the runs are merged and fed to each key's machine in ``(ts, side, seq)`` order. So a stream gives what the batch operator gives for the rows
the watermark has passed (it has millisecond steps); newer rows wait, and rows that come behind the watermark are dropped and
counted by Spark (``numRowsDroppedByWatermark``). Rows without a time are left out. ``folders.Closing`` ends a finished input, so
that no row is left waiting.

Runs, and what a machine keeps of rows that may be many, lie in state by rank (``lines``): a micro-batch reads and writes its own and the due
rows, not all that wait. All values of a row travel as JSON text and come back with their types; equal times are settled
by ``seq`` in its own type, null first, as in batch. State is kept per key, and a key, with its bundle, is processed by one task at a time;
a stream without a key needs ``single_key=True``, as all of it is one task's work. Needs the RocksDB state store provider.
"""

from __future__ import annotations

import decimal
import heapq
import itertools
import json
import math
import operator
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.series import Series
from weftline.streaming import machines
from weftline.streaming.folders import CLOSING
from weftline.streaming.lines import Lines, Runs, Store
from weftline.streaming.machines import Machine, Row

# columns of its own have no leading underscores: the rows reach the processor as named tuples
_END = -1
#: Keys share a group's state and calls, so that many small keys cost little more than their rows.
_BUNDLES = 1024
#: Rows that are sorted, or processed, at once.
_RUN = 65_536
_ORDER = operator.itemgetter(0, 1, 2)  # of a Row: t, side, order
_FIELDS = json.JSONDecoder(parse_float=Decimal)
#: Before the row that closes an input (``folders.Closing``): the last day of 2249.
_LAST_MS = 8_835_868_800_000
#: Rows of output that are handed on at once.
_BLOCK = 4096
# Fixed: microseconds and zone, so that times in values survive the text form; nulls are written, so that every field is there.
_TEXT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def _number(x) -> Decimal | float | None:
    """A number from JSON: NaN and the infinities come as text."""
    if isinstance(x, str):
        x = float(x)
    return x if x is None or isinstance(x, Decimal | int) or not math.isfinite(x) else Decimal(str(x))


def _by_key(rows: list[Row]) -> dict[str, list[Row]]:
    found = {}
    for row in rows:
        found.setdefault(row.key, []).append(row)
    return found


class InOrder(StatefulProcessor):
    """All keys of a bundle. ``numeric`` says of each side whether its first value and its seq are numbers."""

    def __init__(self, machine: Machine, columns: list[str], doubles: list[str], numeric: list[tuple[bool, bool]]):
        self.machine = machine
        self.columns = columns
        self.doubles = doubles
        self.numeric = numeric

    def init(self, handle: StatefulProcessorHandle) -> None:
        decimal.getcontext().prec = 100  # sums of decimals stay exact
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "json string")
        self.parts = handle.getMapState("parts", "part string", "rows string")
        self.memories = handle.getMapState("memories", "key string", "json string")
        self.kept = handle.getMapState("kept", "key string, part string", "rows string")

    def _waiting(self) -> dict:
        """What the bundle waits for: its runs, and the time its timer is set for."""
        return json.loads(self.waiting.get()[0]) if self.waiting.exists() else {"runs": {}, "wake": None}

    def _open(self, key: str) -> tuple[dict, Lines]:
        memory = json.loads(self.memories.getValue((key,))[0]) if self.memories.containsKey((key,)) else {"own": {}, "ends": {}}
        return memory, Lines(Store(self.kept, key), memory["ends"])

    def _close(self, key: str, memory: dict) -> None:
        self.memories.updateValue((key,), (json.dumps(memory),))

    def _row(self, t: int | float, side: int, key: str, text: str) -> Row:
        fields = _FIELDS.decode(text)
        first_is_number, seq_is_number = self.numeric[side]
        seq = fields["seq"]
        if seq is None:
            order = (0, 0)
        elif not seq_is_number:
            order = (1, seq)
        else:
            seq = _number(seq)
            order = (2, 0) if seq != seq else (1, seq)
        return Row(t, side, order, _number(fields.get("v0")) if first_is_number else None, text, key)

    def _runs(self, waiting: dict) -> Runs:
        return Runs(self.parts, waiting["runs"], head=lambda row: row[0])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, fresh = self._waiting(), []
        for pdf in rows:
            fresh += [
                self._row(int(t), int(side), of, text)
                for t, side, of, text in zip(pdf["in_t"], pdf["in_side"], pdf["in_key"], pdf["in_row"])
                if side != _END
            ]
            if len(fresh) >= _RUN:
                self._file(waiting, fresh)
                fresh = []
        if fresh:
            self._file(waiting, fresh)
        self._wait(waiting)
        yield from ()

    def _file(self, waiting: dict, fresh: list[Row]) -> None:
        fresh.sort(key=_ORDER)
        if self.machine.arrive:
            for key, rows in _by_key(fresh).items():
                memory, _ = self._open(key)
                for row in rows:
                    self.machine.arrive(memory["own"], row)
                self._close(key, memory)
        self._runs(waiting).add([[row.t, row.side, row.key, row.row] for row in fresh])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = self._waiting()
        if waiting["wake"] is None or waiting["wake"] > passed:
            return
        due = self._runs(waiting).take(passed, lambda row: self._row(*row), _ORDER)
        out = []
        while some := list(itertools.islice(due, _RUN)):
            for of, rows in _by_key(some).items():
                memory, lines = self._open(of)
                for row in rows:
                    out += [(of, *found) for found in self.machine.step(memory["own"], lines, row)]
                    if len(out) >= _BLOCK:
                        yield self._frame(out)
                        out = []
                self._close(of, memory)
        waiting["wake"] = None
        self._wait(waiting)
        if out:
            yield self._frame(out)

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        found = dict(zip(["in_key", *self.columns], map(list, zip(*out))))
        for c in self.doubles:  # as text: NaN in a frame would arrive as null
            found[c] = [None if x is None else str(x) for x in found[c]]
        for i in self.machine.times:
            found[self.columns[i]] = pd.to_datetime(pd.Series(found[self.columns[i]]), unit="us", utc=True)
        return pd.DataFrame(found)

    def _wait(self, waiting: dict) -> None:
        """A timer for the earliest row that waits, if none is set for that."""
        runs = self._runs(waiting)
        if not len(runs):
            self.waiting.clear()
            return
        if waiting["wake"] is None or runs.first() < waiting["wake"]:
            waiting["wake"] = runs.first()
            self.handle.registerTimer(-(-waiting["wake"] // 1000))
        self.waiting.update((json.dumps(waiting),))

    def close(self) -> None:
        pass


class InClockOrder(InOrder):
    """Rows of several sides merged by a clock of their own, which only goes up on each side.

    A row is processed once every other side has a row waiting that is not before it, or at the end of the input (``Closing``):
    nothing else tells that no earlier reading can come. ``in_order`` gives each side's rows in ascending order.
    """

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, fresh = self._waiting(), []
        runs = Runs(self.parts, waiting["runs"], head=lambda row: 0)
        for pdf in rows:
            fresh += map(list, zip(pdf["in_key"], pdf["in_clock"].tolist(), pdf["in_side"].tolist(), pdf["in_row"]))
            if len(fresh) >= _RUN:
                fresh.sort()
                runs.add(fresh)
                fresh = []
        fresh.sort()
        # rows that were filed are taken back at once, in order
        merged = heapq.merge(runs.take(0, list, list), fresh)
        out = []
        while some := list(itertools.islice(merged, _RUN)):
            for of, rows_of in itertools.groupby(some, key=lambda row: row[0]):
                memory, lines = self._open(of)
                for _, clock, side, text in rows_of:
                    lines[f"side{side}"].push([clock, side, text])
                for found in self._merged(of, memory, lines, False):
                    out.append(found)
                    if len(out) >= _BLOCK:
                        yield self._frame(out)
                        out = []
                self._close(of, memory)
        if out:
            yield self._frame(out)
        if waiting["wake"] is None:
            waiting["wake"] = _LAST_MS
            self.handle.registerTimer(_LAST_MS)
            self.waiting.update((json.dumps({"runs": {}, "wake": _LAST_MS}),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        for (of,) in list(self.memories.keys()):
            memory, lines = self._open(of)
            for found in self._merged(of, memory, lines, True):
                out.append(found)
                if len(out) >= _BLOCK:
                    yield self._frame(out)
                    out = []
            self._close(of, memory)
        if out:
            yield self._frame(out)

    def _merged(self, key: str, memory: dict, lines: Lines, ended: bool) -> Iterator[tuple]:
        sides = [lines[f"side{i}"] for i in range(len(self.numeric))]
        while any(map(len, sides)) if ended else all(map(len, sides)):
            clock, side, text = min((line for line in sides if len(line)), key=lambda line: line[0][:2]).take()
            for found in self.machine.step(memory["own"], lines, self._row(clock, side, key, text)):
                yield key, *found


class Gaps(StatefulProcessor):
    """The windows of a key, as they are closed, with the empty ones between two of them. A micro-batch closes later ones only."""

    def __init__(self, width: int):
        self.width = width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", "at long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows)).sort_values("in_t", kind="stable")
        of, at, out = found["in_key"].iloc[0], self.next.get()[0] if self.next.exists() else None, []
        for t, count, avg in zip(found["in_t"].tolist(), found["in_count"].tolist(), found["in_avg"]):
            while at is not None and at < t:
                out.append((of, at, 0, "0.0"))
                at += self.width
                if len(out) >= _BLOCK:
                    yield self._frame(out)
                    out = []
            out.append((of, t, count, avg))
            at = t + self.width
        self.next.update((at,))
        yield self._frame(out)

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["in_key", "in_t", "count", "avg"])

    def close(self) -> None:
        pass


def _key(df: DataFrame, by: list[str]) -> Column:
    """A row's key as text."""
    kinds = {c: df.schema[c].dataType for c in by}
    # a zero has no sign, as in a grouping
    columns = [(F.col(c) + F.lit(0.0)).cast(k).alias(c) if isinstance(k, T.DoubleType | T.FloatType) else F.col(c) for c, k in kinds.items()]
    return F.to_json(F.struct(*columns), _TEXT) if by else F.lit("{}")


def _bundled(rows: DataFrame) -> GroupedData:
    """Keys are dealt over a fixed number of bundles by a hash; that number belongs to a stream's progress."""
    return rows.withColumn("in_bundle", F.pmod(F.xxhash64("in_key"), F.lit(_BUNDLES)).cast("int")).groupBy("in_bundle")


def _keyed(out: DataFrame, df: DataFrame, by: list[str]) -> DataFrame:
    """The key's columns instead of its text."""
    if not by:
        return out.drop("in_key")
    kind = T.StructType([T.StructField(c, df.schema[c].dataType) for c in by])
    read = out.withColumn("in_key", F.from_json("in_key", kind, _TEXT))
    return read.select(*[F.col("in_key")[c].alias(c) for c in by], *[c for c in out.columns if c != "in_key"])


def _payload(s: Series) -> tuple[Column, T.StructType]:
    """A row's time, seq and values as JSON, and the type to read them back."""
    fields = [F.col(s.ts).alias("ts"), F.col(s.seq).alias("seq"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(s.values)]]
    packed = F.struct(*fields)
    kind = s.df.select(packed.alias("p")).schema["p"].dataType
    return F.to_json(packed, _TEXT), kind


def _numeric(s: Series) -> tuple[bool, bool]:
    kinds = [s.df.schema[c].dataType for c in (s.value, s.seq)] if s.values else [T.StringType(), s.df.schema[s.seq].dataType]
    return tuple(isinstance(k, T.NumericType) for k in kinds)


def _closing(df: DataFrame) -> Column:
    return F.col(CLOSING) if CLOSING in df.columns else F.lit(False)


def _by(s: Series, single_key: bool) -> list[str]:
    if not s.by and not single_key:
        raise ValueError("a stream without a key is one task's work; say single_key=True if that is meant")
    return list(s.by)


def in_order(machine: Machine, *series: Series, delay: str = "0 seconds", single_key: bool = False, event_time: str = "") -> DataFrame:
    """Feed one or more streaming series, merged by time, to a machine per key. ``event_time`` names a time column of the output
    for stateful operators that come after."""
    by = _by(series[0], single_key)

    def side(i: int, s: Series) -> DataFrame:
        stamped = s.df.withColumn("in_ts", F.col(s.ts).cast("timestamp")).withWatermark("in_ts", delay)
        return stamped.where("in_ts is not null").select(
            _key(s.df, by).alias("in_key"),
            "in_ts",
            F.unix_micros("in_ts").alias("in_t"),
            F.when(_closing(s.df), _END).otherwise(i).alias("in_side"),
            _payload(s)[0].alias("in_row"),
        )

    rows = side(0, series[0])
    for i, s in enumerate(series[1:], 1):
        rows = rows.unionByName(side(i, s))
    found = T.StructType.fromDDL(machine.columns)
    doubles = [f.name for f in found if isinstance(f.dataType, T.DoubleType)]
    fields = [T.StructField(f.name, T.StringType()) if f.name in doubles else f for f in found]
    out = _bundled(rows).transformWithStateInPandas(
        statefulProcessor=InOrder(machine, found.names, doubles, [_numeric(s) for s in series]),
        outputStructType=T.StructType([T.StructField("in_key", T.StringType()), *fields]),
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName=event_time,
    )
    return _keyed(out.withColumns({c: F.col(c).cast("double") for c in doubles}), series[0].df, by)


def _unpacked(out: DataFrame, *series: Series) -> DataFrame:
    """The text of ``row0, row1, ..`` as structs with the fields ``ts``, ``seq`` and the values by number."""
    return out.withColumns(
        {f"row{i}": F.from_json(f"row{i}", _payload(s)[1], _TEXT) for i, s in enumerate(series)}
    )


def _values(row: str, s: Series, name: str = "{}") -> list[Column]:
    return [F.col(row)[f"v{i}"].alias(name.format(v)) for i, v in enumerate(s.values)]


def _whole(row: str, s: Series) -> list[Column]:
    """Time, seq and values of a row under their own names."""
    return [F.col(row)["ts"].alias(s.ts), F.col(row)["seq"].alias(s.seq), *_values(row, s)]


def tumbling(s: Series, seconds: float, delay: str = "0 seconds") -> DataFrame:
    """``(start, end, count, avg)`` of windows the watermark has closed; append mode."""
    stamped = s.df.withColumn("_ts", F.col(s.ts).cast("timestamp")).withWatermark("_ts", delay).where(~_closing(s.df))
    window = F.window("_ts", f"{round(seconds * 1_000_000)} microseconds").alias("_w")
    stats = stamped.groupBy(*s.by, window).agg(
        F.count(F.lit(1)).alias("count"),
        (F.sum(s.value).cast("double") / F.count(s.value)).alias("avg"),
    )
    return stats.select(*s.by, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), "count", "avg")


def tumbling_filled(s: Series, seconds: float, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """As ``tumbling``, with the empty windows between two closed ones of a key as ``count 0, avg 0.0``. A window goes out when the watermark
    has passed its end, also if its key gets no further row. Only windows, not rows, go through the operator that fills the gaps."""
    by = _by(s, single_key)
    closed = tumbling(s, seconds, delay)
    rows = closed.select(
        _key(closed, by).alias("in_key"),
        F.unix_micros("start").alias("in_t"),
        F.col("count").alias("in_count"),
        F.coalesce("avg", F.lit(0.0)).cast("string").alias("in_avg"),
    )
    width = round(seconds * 1_000_000)
    out = rows.groupBy("in_key").transformWithStateInPandas(
        statefulProcessor=Gaps(width),
        outputStructType="in_key string, in_t long, count long, avg string",
        outputMode="Append",
        timeMode="None",
    )
    windows = out.select(
        "in_key",
        F.timestamp_micros("in_t").alias("start"),
        F.timestamp_micros(F.col("in_t") + width).alias("end"),
        "count",
        F.col("avg").cast("double").alias("avg"),
    )
    return _keyed(windows, s.df, by)


def count_sliding(s: Series, n: int = 10, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    return in_order(machines.count_sliding(n), s, delay=delay, single_key=single_key)


def moving_average(s: Series, n: int = 20, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """Every row with ``moving_avg``, as the batch operator."""
    out = _unpacked(in_order(machines.moving_average(n), s, delay=delay, single_key=single_key), s)
    return out.select(*s.by, *_whole("row0", s), "moving_avg")


def window_extrema(s: Series, n: int, largest: bool = True, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """``(at_ts, ts, values)``: per row, the row that holds the extremum of the last ``n``."""
    out = _unpacked(in_order(machines.window_extrema(n, largest), s, delay=delay, single_key=single_key), s)
    return out.select(*s.by, "at_ts", F.col("row0.ts").alias("ts"), *_values("row0", s))


def landmark(s: Series, floor_second: bool = False, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    return in_order(machines.landmark(floor_second), s, delay=delay, single_key=single_key)


def landmark_points(s: Series, max_points: int | None = None, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """``(landmark, ts, count, avg)`` with the landmark on the full second; ``max_points`` keeps the first."""
    points = landmark(s, True, delay, single_key).drop("sum")
    return points if max_points is None else points.where(F.col("count") <= max_points)


def running_min_max(s: Series, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    return in_order(machines.running_min_max(), s, delay=delay, single_key=single_key)


def record_extrema(s: Series, largest: bool = False, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """The rows, whole, that strictly beat every earlier value."""
    out = _unpacked(in_order(machines.record_extrema(largest), s, delay=delay, single_key=single_key), s)
    return out.select(*s.by, *_whole("row0", s))


def shed_oldest(s: Series, n: int, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """The rows that a full buffer of ``n`` rows loses, with ``shed_so_far``."""
    out = _unpacked(in_order(machines.shed_oldest(n), s, delay=delay, single_key=single_key), s)
    return out.select(*s.by, *_whole("row0", s), "shed_so_far")


def fuzzy_merge_join(
    s: Series, t: Series, max_age_seconds: float | None = None, delay: str = "0 seconds", single_key: bool = False
) -> DataFrame:
    """``(ts, s values, t values)``, as the batch operator."""
    out = in_order(machines.queue(False, max_age_seconds), s, t, delay=delay, single_key=single_key)
    return _unpacked(out, s, t).select(
        *s.by, F.col("row0.ts").alias("ts"), *_values("row0", s, "s_{}"), *_values("row1", t, "t_{}")
    )


def fuzzy_merge_drops(s: Series, t: Series, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """``(ts, dropped_so_far)`` of every T the fuzzy merge join passed over, once a later S has come."""
    return in_order(machines.queue(False, drops="followed"), s, t, delay=delay, single_key=single_key)


def bufferless_join(
    d: Series, n: Series, newest: bool, max_age_seconds: float | None = None, delay: str = "0 seconds", single_key: bool = False
) -> DataFrame:
    """``(ts, d values, n_ts, n values)``; oldest first has no ``n_ts``, as the batch operator."""
    out = in_order(machines.queue(newest, max_age_seconds), n, d, delay=delay, single_key=single_key)
    return _unpacked(out, n, d).select(
        *d.by,
        F.col("row1.ts").alias("ts"),
        *_values("row1", d, "d_{}"),
        *([F.col("row0.ts").alias("n_ts")] if newest else []),
        *_values("row0", n, "n_{}"),
    )


def queue_drops(
    push: Series, pop: Series, newest: bool = False, max_age_seconds: float | None = None, delay: str = "0 seconds", single_key: bool = False
) -> DataFrame:
    """``(ts, dropped_so_far)`` of every pop that found nothing waiting."""
    return in_order(machines.queue(newest, max_age_seconds, drops="all"), push, pop, delay=delay, single_key=single_key)


def alternating_delta_join(one: Series, two: Series, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """``(ts, values of one, values of two)``, as the batch operator."""
    out = _unpacked(in_order(machines.alternating(), one, two, delay=delay, single_key=single_key), one, two)
    return out.select(
        *one.by,
        F.when(F.col("side") == 0, F.col("row0.ts")).otherwise(F.col("row1.ts")).alias("ts"),
        *_values("row0", one, "{}_1"),
        *_values("row1", two, "{}_2"),
    )


def minimal_delta_join(one: Series, two: Series, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """``(ts, dominant, d values, p values)``, as the batch operator."""
    if len(one.values) != len(two.values):
        raise ValueError("both streams need the same number of values")
    return _symmetric(_unpacked(in_order(machines.symmetric(), one, two, delay=delay, single_key=single_key), one, two), one, two)


def _symmetric(out: DataFrame, one: Series, two: Series) -> DataFrame:
    mine = F.col("side") == 0

    def pick(a: Column, b: Column, name: str) -> Column:
        return F.when(mine, a).otherwise(b).alias(name)

    pairs = [(F.col("row0")[f"v{i}"], F.col("row1")[f"v{i}"], v) for i, v in enumerate(one.values)]
    return out.select(
        *one.by,
        pick(F.col("row0.ts"), F.col("row1.ts"), "ts"),
        (F.col("side") + 1).alias("dominant"),
        *[pick(a, b, f"d_{v}") for a, b, v in pairs],
        *[pick(b, a, f"p_{v}") for a, b, v in pairs],
    )


def logical_clock(s: Series, step: float, delay: str = "0 seconds", single_key: bool = False) -> Series:
    """The k-th row of a stream gets the time ``k * step``, from 0 on. The frame keeps ``event_ts``, the time by which the stream
    advances, for the operators that come after."""
    out = _unpacked(in_order(machines.clock(step), s, delay=delay, single_key=single_key, event_time="event_ts"), s)
    df = out.select(*s.by, "event_ts", "clock", F.col("row0.seq").alias(s.seq), *_values("row0", s))
    return Series(df, ts="clock", seq=s.seq, values=s.values, by=s.by)


def minimal_delta_join_on_clocks(one: Series, two: Series) -> DataFrame:
    """``minimal_delta_join`` of streams that ``logical_clock`` has stamped, after a selection or not; ``ts`` is the clock."""
    by = list(one.by)
    sides = [
        s.df.select(_key(s.df, by).alias("in_key"), "event_ts", F.lit(i).alias("in_side"), F.col(s.ts).alias("in_clock"), _payload(s)[0].alias("in_row"))
        for i, s in enumerate((one, two))
    ]
    machine = machines.symmetric()
    found = T.StructType.fromDDL(machine.columns)
    out = _bundled(sides[0].unionByName(sides[1])).transformWithStateInPandas(
        statefulProcessor=InClockOrder(machine, found.names, [], [_numeric(s) for s in (one, two)]),
        outputStructType=T.StructType([T.StructField("in_key", T.StringType()), *found.fields]),
        outputMode="Append",
        timeMode="EventTime",
    )
    return _symmetric(_unpacked(_keyed(out, one.df, by), one, two), one, two)


def three_way_delta_join(one: Series, two: Series, three: Series, delay: str = "0 seconds", single_key: bool = False) -> DataFrame:
    """``(dominant: struct<ts, value>, joined: struct<v1, v2, v3>)`` of the first values, as the batch operator."""
    series = (one, two, three)
    out = _unpacked(in_order(machines.three_way(), *series, delay=delay, single_key=single_key), *series)
    heads = [F.struct(F.col(f"row{i}")["ts"].alias("ts"), F.col(f"row{i}")["v0"].alias("value")) for i in range(3)]
    head = F.when(F.col("side") == 0, heads[0]).when(F.col("side") == 1, heads[1]).otherwise(heads[2])
    values = [F.col(f"row{i}")["v0"].alias(f"v{i + 1}") for i in range(3)]
    return out.select(*one.by, head.alias("dominant"), F.struct(*values).alias("joined"))
