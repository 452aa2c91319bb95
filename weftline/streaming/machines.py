"""What one stream key remembers between rows, for operators that streams need state for.

A machine is fed the due rows in order. ``t`` is in microseconds, ``value`` the first value as an exact number (or a float that is not
finite), ``row`` all values as JSON text, which joins hand on unread. Its memory is a dictionary that JSON can hold, of bounded size;
what may grow with the rows that wait is in ``lines``. A step changes both and gives output rows. Columns named in ``times`` are
microseconds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from typing import NamedTuple

from weftline.streaming.lines import Line, Lines


class Row(NamedTuple):
    t: int
    side: int
    order: tuple  # of equal times and sides
    value: Decimal | int | float | None
    row: str
    key: str = ""


Step = Callable[[dict, Lines, Row], Iterable[tuple]]


@dataclass(frozen=True)
class Machine:
    columns: str
    times: tuple[int, ...]  # positions of the time columns
    step: Step
    arrive: Callable[[dict, Row], None] | None = None  # sees every row when it arrives, in any order


def _double(x) -> float | None:
    return None if x is None else float(x)


def _rank(x) -> tuple:
    """Values in Spark's order: NaN is greater than all others."""
    return (1, 0) if isinstance(x, float) and math.isnan(x) else (0, x)


def _kept(x) -> str | None:
    return None if x is None else str(x)


def _read(text: str | None) -> Decimal | float | None:
    """A value from its text."""
    if text is None:
        return None
    x = Decimal(text)
    return x if x.is_finite() else float(x)


class Total:
    """Sum and number of values that come and go, exact; kept in ``held``."""

    def __init__(self, held: dict):
        self.held = held
        if not held:
            held.update(sum="0", n=0, odd={})

    def add(self, x: Decimal | float | None, times: int = 1) -> None:
        if x is None:
            return
        self.held["n"] += times
        if isinstance(x, float):  # not finite: counted by name
            odd = self.held["odd"]
            odd[str(x)] = odd.get(str(x), 0) + times
        else:
            self.held["sum"] = str(Decimal(self.held["sum"]) + times * x)

    def sum(self) -> float | None:
        if not self.held["n"]:
            return None
        return sum((float(name) for name, n in self.held["odd"].items() if n), float(Decimal(self.held["sum"])))

    def mean(self) -> float | None:
        return None if not self.held["n"] else self.sum() / self.held["n"]


class Extremum:
    """The greatest or least of the last rows: a line of those that no later row beats. Ties stay with the earliest."""

    def __init__(self, line: Line, largest: bool):
        self.line, self.largest = line, largest

    def add(self, number: int, x: Decimal | float | None, more=None) -> None:
        if x is None:
            return
        while len(self.line):
            old = _rank(_read(self.line.newest()[1]))
            if not (old < _rank(x) if self.largest else old > _rank(x)):
                break
            self.line.pop()
        self.line.push([number, _kept(x), more])

    def best(self, oldest: int) -> list | None:
        """The entry (number, value, more), if its number is not below ``oldest``."""
        while len(self.line) and self.line[0][0] < oldest:
            self.line.take()
        return self.line[0] if len(self.line) else None


def _last(memory: dict, lines: Lines, row: Row, n: int) -> int:
    """Note a row among the last n; gives its number."""
    memory["number"] = number = memory.get("number", -1) + 1
    held, total = lines["held"], Total(memory.setdefault("total", {}))
    held.push([row.t, _kept(row.value)])
    total.add(row.value)
    if len(held) > n:
        total.add(_read(held.take()[1]), -1)
    return number


def count_sliding(n: int) -> Machine:
    def step(memory: dict, lines: Lines, row: Row) -> list[tuple]:
        number = _last(memory, lines, row, n)
        found = []
        for name, largest in (("least", False), ("most", True)):
            extremum = Extremum(lines[name], largest)
            extremum.add(number, row.value)
            best = extremum.best(number - n + 1)
            found.append(_double(_read(best[1])) if best else None)
        held = lines["held"]
        return [(held[0][0], row.t, len(held), Total(memory["total"]).mean(), *found)]

    return Machine(
        "oldest_ts timestamp, newest_ts timestamp, count long, avg double, min double, max double", (0, 1), step
    )


def moving_average(n: int) -> Machine:
    def step(memory: dict, lines: Lines, row: Row) -> list[tuple]:
        _last(memory, lines, row, n)
        full = len(lines["held"]) == n
        return [(row.row, Total(memory["total"]).mean() if full else math.nan)]

    return Machine("row0 string, moving_avg double", (), step)


def window_extrema(n: int, largest: bool) -> Machine:
    def step(memory: dict, lines: Lines, row: Row) -> list[tuple]:
        memory["number"] = number = memory.get("number", -1) + 1
        extremum = Extremum(lines["best"], largest)
        extremum.add(number, row.value, row.row)
        best = extremum.best(number - n + 1)
        return [(row.t, best[2] if best else None)]

    return Machine("at_ts timestamp, row0 string", (0,), step)


def landmark(floor_second: bool = False) -> Machine:
    """The landmark is the time of the row with the lowest ``seq`` of those that have arrived when the first row falls due; it
    stays, also if a lower ``seq`` comes later. Rows before it are dropped, as in the batch form."""

    def arrive(memory: dict, row: Row) -> None:
        if "start" not in memory:
            first = memory.get("first")
            order = [str(x) if isinstance(x, Decimal) else x for x in row.order]
            # of equal ones the earliest, in whatever pieces a micro-batch is seen
            if first is None or (row.order, row.t) < (tuple(Decimal(x) if d else x for x, d in zip(first[0], first[1])), first[2]):
                memory["first"] = [order, [isinstance(x, Decimal) for x in row.order], row.t]

    def step(memory: dict, lines: Lines, row: Row) -> list[tuple]:
        if "start" not in memory:
            start = memory.pop("first")[2]
            memory["start"] = start - start % 1_000_000 if floor_second else start
        if row.t < memory["start"]:
            return []
        memory["count"] = count = memory.get("count", 0) + 1
        total = Total(memory.setdefault("total", {}))
        total.add(row.value)
        return [(memory["start"], row.t, count, total.sum(), total.mean())]

    return Machine("landmark timestamp, ts timestamp, count long, sum double, avg double", (0, 1), step, arrive)


def running_min_max() -> Machine:
    def step(memory: dict, lines: Lines, row: Row) -> list[tuple]:
        if row.value is not None:
            for name, pick in (("min", min), ("max", max)):
                held = _read(memory.get(name))
                memory[name] = _kept(row.value if held is None else pick(held, row.value, key=_rank))
        return [tuple(_double(_read(memory.get(name))) for name in ("min", "max"))]

    return Machine("min double, max double", (), step)


def record_extrema(largest: bool) -> Machine:
    def step(memory: dict, lines: Lines, row: Row) -> list[tuple]:
        if row.value is None:
            return []
        best = _read(memory.get("best"))
        if best is not None and not (_rank(row.value) > _rank(best) if largest else _rank(row.value) < _rank(best)):
            return []
        memory["best"] = _kept(row.value)
        return [(row.row,)]

    return Machine("row0 string", (), step)


def shed_oldest(n: int) -> Machine:
    """Reports each row that a full buffer of ``n`` rows loses, with the running count."""

    def step(memory: dict, lines: Lines, row: Row) -> list[tuple]:
        held = lines["held"]
        held.push([row.row])
        if len(held) <= n:
            return []
        memory["shed"] = shed = memory.get("shed", 0) + 1
        return [(held.take()[0], shed)]

    return Machine("row0 string, shed_so_far long", (), step)


def queue(newest: bool, max_age_seconds: float | None = None, drops: str | None = None) -> Machine:
    """Side 0 is pushed, side 1 pops the oldest or the newest and is joined with it; a pop that finds none is dropped.

    ``max_age_seconds`` forgets waiting rows that are older than that, so that the state stays bounded; without it none is
    forgotten. ``drops`` reports the dropped pops with their running count instead of the pairs: ``all`` of them at once, or
    each once a push has ``followed``.
    """

    def step(memory: dict, lines: Lines, row: Row) -> Iterator[tuple]:
        waiting = lines["waiting"]
        if row.side == 0:
            waiting.push([row.t, row.row])
            if drops == "followed":
                lost = lines["lost"]
                while len(lost):
                    yield tuple(lost.take())
            return
        if max_age_seconds is not None:
            oldest = row.t - max_age_seconds * 1_000_000
            while len(waiting) and waiting[0][0] < oldest:
                waiting.take()
        if not len(waiting):
            memory["dropped"] = dropped = memory.get("dropped", 0) + 1
            if drops == "followed":
                lines["lost"].push([row.t, dropped])
            elif drops:
                yield row.t, dropped
            return
        taken = waiting.pop() if newest else waiting.take()
        if not drops:
            yield taken[1], row.row

    columns = "ts timestamp, dropped_so_far long" if drops else "row0 string, row1 string"
    return Machine(columns, (0,) if drops else (), step)


def alternating() -> Machine:
    """Each side's rows wait in order. Of the two rows of the other side around the dominant head the nearer one is joined, the
    earlier one if they are equally near; that then makes its own side dominant."""

    def step(memory: dict, lines: Lines, row: Row) -> Iterator[tuple]:
        lines[str(row.side)].push([row.t, row.row])
        side = memory.get("side", 0)
        while len(lines[str(side)]):
            mine, other = lines[str(side)], lines[str(1 - side)]
            t, payload = mine[0]
            # rows before the two around t are passed over, whatever comes
            while len(other) > 1 and other[1][0] < t:
                other.take()
            if not len(other) or (len(other) == 1 and other[0][0] < t):
                break
            in_step = other[0][0] >= t
            earlier = not in_step and t - other[0][0] <= other[1][0] - t
            partner = other[0 if in_step or earlier else 1][1]
            yield (side, payload, partner) if side == 0 else (side, partner, payload)
            other.take()
            if earlier:
                side = 1 - side
            else:
                mine.take()
        memory["side"] = side

    return Machine("side int, row0 string, row1 string", (), step)


def symmetric() -> Machine:
    """Rows of one side in a row are a run; it is settled when a row ``y`` of the other side comes: each of its rows joins ``y``,
    the last row ``x`` before the run, or both, whichever is nearest. If the run took ``y``, then ``y`` opens its own run as one that is passed over."""

    def step(memory: dict, lines: Lines, row: Row) -> Iterator[tuple]:
        run = lines["run"]
        if len(run) and memory["side"] != row.side:
            x, skip, side = memory.get("x"), memory.get("skip", False), memory["side"]
            size, last = len(run), run.newest()
            for i in range(size):
                t, payload = run.take()
                if i == 0 and skip:
                    continue
                near = [[row.t, row.row]]
                if x is not None and not skip:
                    before, after = t - x[0], row.t - t
                    near = [x] * (before <= after) + near * (after <= before)
                for _, partner in near:
                    yield (side, payload, partner) if side == 0 else (side, partner, payload)
            takes = x is None or row.t - last[0] <= last[0] - x[0]
            if size == 1:
                memory["skip"] = takes and not skip
            elif takes:
                memory["skip"] = True
            memory["x"] = last
        memory["side"] = row.side
        run.push([row.t, row.row])

    return Machine("side int, row0 string, row1 string", (), step)


def three_way() -> Machine:
    """The dominant head with the nearer of the first two rows of each other side, the second if they are equally near. The
    side of the earliest of the three drops its head and becomes dominant."""

    def step(memory: dict, lines: Lines, row: Row) -> Iterator[tuple]:
        sides = [lines[str(i)] for i in range(3)]
        sides[row.side].push([row.t, row.row])
        dominant = memory.get("dominant", 0)
        while all(len(line) > (side != dominant) for side, line in enumerate(sides)):
            t = sides[dominant][0][0]
            chosen = []
            for side, line in enumerate(sides):
                second = side != dominant and abs(t - line[0][0]) >= abs(t - line[1][0])
                chosen.append(line[1 if second else 0])
            yield (dominant, *[c[1] for c in chosen])
            ahead = min(range(3), key=lambda side: (chosen[side][0], side))
            sides[ahead].take()
            dominant = ahead
        memory["dominant"] = dominant

    return Machine("side int, row0 string, row1 string, row2 string", (), step)


def clock(step_size: float) -> Machine:
    """Every row with its number in its stream times ``step_size``, from 0 on, and its own time."""

    def step(memory: dict, lines: Lines, row: Row) -> list[tuple]:
        memory["rank"] = rank = memory.get("rank", -1) + 1
        return [(row.t, rank * step_size, row.row)]

    return Machine("event_ts timestamp, clock double, row0 string", (0,), step)
