"""Alternating minimal delta join and the three-way minimal delta join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.slices import SLICE
from weftline.operators.turns import END, OPENS, PART, Stretch, codes, join_ranks, lay_out, numbers, stretches, walk_all
from weftline.series import Series

# --- alternating -------------------------------------------------------------------
#
# State: (dominant side, rank of its head, rank of the other head). The dominant head
# meets the first row of the other stream that is not earlier:
#   * the other head, or what lies behind it: joined, both heads move on ("in step");
#   * a later row, and the row before that is at least as near: that row is joined, and
#     the other stream becomes dominant from the later row on;
#   * a later row that is nearer: it is joined but stays, only the dominant head moves on.
# The lead is the other head's rank minus the dominant head's; in step it does not change. A
# row asks for a lead: the rank of the row it meets minus its own. It is in step if it asks
# for no more than there is; else the step is broken there, and what comes next follows from that row alone.
# So a slice is a forest: each row points to the next row at which the step after it would
# be broken. The dominant head only moves on in the order (t, side, seq), so a state between two slices is
# the dominant side and the lead.


def _ladder(values: np.ndarray) -> list[np.ndarray]:
    """Greatest values of 1, 2, 4, .. neighbours."""
    levels = [values]
    while len(levels[-1]) > 1:
        v = levels[-1]
        if len(v) % 2:
            v = np.r_[v, np.iinfo(np.int64).min]
        levels.append(np.maximum(v[::2], v[1::2]))
    return levels


def _first_above(levels: list[np.ndarray], start: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """For each query, the first place from ``start`` on with a value above ``bound``; the number of values if there is none."""
    found = np.full(len(start), len(levels[0]), np.int64)
    query, at, climbed = np.arange(len(start)), start, []
    for k, values in enumerate(levels):
        inside = at < len(values)
        query, at, bound = query[inside], at[inside], bound[inside]
        hit = values[at] > bound
        climbed.append((k, query[hit], at[hit], bound[hit]))
        query, at, bound = query[~hit], at[~hit] + 1, bound[~hit]
        odd = at % 2 == 1  # the node beside it, before going up
        hit = odd & (at < len(values))
        hit[hit] = values[at[hit]] > bound[hit]
        climbed.append((k, query[hit], at[hit], bound[hit]))
        query, at, bound = query[~hit], (at[~hit] + odd[~hit]) >> 1, bound[~hit]
    for k, query, at, bound in climbed:
        for values in reversed(levels[:k]):
            at = 2 * at
            at = at + (values[at] <= bound)
        found[query] = at
    return found


class _Forest:
    """The own rows of all (key, slice) stretches of a table, in order of (stretch, side, rank), and what follows a
    step that is broken at each of them."""

    def __init__(self, rows: pa.Table, by: list[str]):
        code = codes(rows, [*by, SLICE])
        side, rank, t, part, opens = (numbers(rows, c) for c in ("_side", "_rank", "_t", PART, OPENS))
        order = np.lexsort((rank, side, t, code))
        code, side, rank, t, part, opens = (c[order] for c in (code, side, rank, t, part, opens))
        self.n_codes = int(code[-1]) + 1
        n = len(code)
        line = 2 * code + side  # a stream of a stretch
        listed = np.argsort(line, kind="stable")
        first = np.searchsorted(line[listed], np.arange(2 * self.n_codes + 1))
        held = np.diff(first)
        # rows of the other stream that are earlier: before the row, or for side one before all rows of its time
        begins = np.searchsorted(code, np.arange(self.n_codes))
        group = np.ones(n, bool)
        group[1:] = (code[1:] != code[:-1]) | (t[1:] != t[:-1])
        group = np.maximum.accumulate(np.where(group, np.arange(n), 0))
        before = [np.cumsum(side == s) - (side == s) for s in (0, 1)]
        place = np.where(side == 0, before[1] - before[1][begins[code]], before[0][group] - before[0][begins[code]])
        other = line ^ 1
        some = held[other] > 0
        head = listed[np.minimum(first[other], n - 1)]  # first listed row of the other stream
        exists = place < held[other]
        after = listed[np.minimum(first[other] + place, n - 1)]
        prior = listed[np.maximum(first[other] + place - 1, 0)]
        meets = np.where(some, rank[head] + place, 0)
        # the row borrowed from before may have this time too; so may others before that one
        same = some & (side == 1) & (place == 0) & (part[head] == -1) & (t[head] == t)
        meets[same] = opens[head[same]].astype(np.int64)
        earlier = exists & (place > 0) & (t - t[prior] <= t[after] - t)

        own = listed[part[listed] == 0]
        lines = np.arange(2 * self.n_codes)
        self.start = np.searchsorted(line[own], np.r_[lines, 2 * self.n_codes])  # of the own rows of a line
        count = np.diff(self.start)
        low = np.zeros(2 * self.n_codes, np.int64)
        any_ = held > 0
        top = listed[np.minimum(first[:-1], n - 1)]
        low[any_] = rank[top[any_]] + (part[top[any_]] == -1)
        self.low, self.high = low, low + count
        self.row, self.line, self.side, self.rank = order[own], line[own], side[own], rank[own]
        self.met, self.earlier = meets[own], earlier[own]
        asks = self.met - self.rank
        self.asks = asks
        # after the break: side, its head, and the lead
        self.to = np.where(exists[own], np.where(self.earlier, 1 - self.side, self.side), END)
        self.head = np.where(self.earlier, self.met, self.rank + 1)
        self.rest = np.where(self.earlier, -asks, asks - 1)
        self.levels = _ladder(asks)
        size = len(own)
        self.next = np.full(size, size, np.int64)
        goes = np.flatnonzero(self.to != END)
        self.next[goes] = self.breaks(self.line[goes] - self.side[goes] + self.to[goes], self.head[goes], self.rest[goes])

    def breaks(self, line: np.ndarray, head: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """The own row at which a step from ``head`` with a lead is broken; the number of own rows if that is beyond the stretch."""
        at = self.start[line] + np.maximum(head - self.low[line], 0)
        found = np.full(len(line), len(self.rank), np.int64)
        inside = np.flatnonzero(at < self.start[line + 1])
        if len(inside):
            place = _first_above(self.levels, at[inside], lead[inside])
            place[place >= self.start[line[inside] + 1]] = len(self.rank)
            found[inside] = place
        return found

    def rules(self) -> list[np.ndarray]:
        """Arrays (row of the table, side, lead, exit side, exit lead)."""
        size = len(self.rank)
        if not size:
            return [np.zeros(0, np.int64)] * 5
        last = np.where(self.next < size, self.next, np.arange(size))  # from where the way from a row leaves the slice
        while True:
            then = last[last]
            if (then == last).all():
                break
            last = then
        # only rows that ask for more than all own rows of their stream before them can break the first step
        chosen = np.flatnonzero(_new_highs(self.asks, self.start[:-1]))
        leave = last[chosen]
        return [self.row[chosen], self.side[chosen], self.asks[chosen], self.to[leave], np.where(self.to[leave] == END, 0, self.rest[leave])]

    def pairs(self, on: np.ndarray, lead: np.ndarray) -> list[np.ndarray]:
        """Arrays (row of the table, dominant side, rank of stream one, rank of stream two), from a state per own row's stretch."""
        size = len(self.rank)
        codes = np.arange(self.n_codes)
        line = 2 * codes + on
        at = self.breaks(line, self.low[line], lead)
        visited, steps = [], self.next.tolist()
        for k in at.tolist():
            while k < size:
                visited.append(k)
                k = steps[k]
        v = np.array(visited, np.int64)
        # what is in step: from each entry, and after each break, up to the next break or the end of the slice
        to_line = self.line[v] - self.side[v] + self.to[v]
        goes = self.to[v] != END
        lines = np.r_[line, to_line[goes]]
        begin = np.r_[self.low[line], self.head[v][goes]]
        until = np.r_[at, self.next[v][goes]]
        end = np.where(until < size, self.rank[np.minimum(until, size - 1)], self.high[lines]) if size else self.high[lines]
        leads = np.r_[lead, self.rest[v][goes]]
        sizes = np.maximum(end - begin, 0)
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        mine = np.repeat(begin, sizes) + inside
        side = np.repeat(lines % 2, sizes)
        row = self.start[np.repeat(lines, sizes)] + mine - self.low[np.repeat(lines, sizes)]
        side = np.r_[side, self.side[v]]
        theirs = np.r_[mine + np.repeat(leads, sizes), self.met[v] - self.earlier[v]]
        mine = np.r_[mine, self.rank[v]]
        row = self.row[np.r_[row, v].astype(np.int64)]
        broken = np.r_[np.ones(len(mine) - len(v), bool), goes]
        return [c[broken] for c in (row, side, np.where(side == 0, mine, theirs), np.where(side == 0, theirs, mine))]


def _new_highs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether each value is above all values before it in its segment."""
    n = len(values)
    segment = np.zeros(n, np.int64)
    np.add.at(segment, starts[starts < n], 1)
    segment = np.cumsum(segment)
    # one running maximum over (segment, value): ranks of the values keep it within 64 bits
    order = np.argsort(values, kind="stable")
    dense = np.empty(n, np.int64)
    sorted_ = values[order]
    dense[order] = np.cumsum(np.r_[True, sorted_[1:] != sorted_[:-1]]) if n else 0
    key = segment * (n + 1) + dense
    best = np.maximum.accumulate(key)
    return np.r_[True, key[1:] > best[:-1]] if n else np.zeros(0, bool)


def alternating_pairs(one: Series, two: Series, rows_per_slice: int | None = None) -> DataFrame:
    """Joined rows as ``by..., _side`` (0: one is dominant), ``_row0, _row1``."""
    layout = lay_out([one, two], ahead=1, rows_per_slice=rows_per_slice)
    by = layout.by

    def walk(rows: pa.Table, on: np.ndarray, lead: np.ndarray) -> list[np.ndarray]:
        first = np.unique(codes(rows, [*by, SLICE]), return_index=True)[1]
        return _Forest(rows, by).pairs(on[first], lead[first])

    found = walk_all(
        layout,
        start=(0, 0),
        reduce_slices=lambda rows: _Forest(rows, by).rules(),
        walk=walk,
        columns=["_side", "_rank0", "_rank1"],
    )
    return join_ranks(found, layout, {"_rank0": 0, "_rank1": 1})


def alternating_delta_join(one: Series, two: Series, rows_per_slice: int | None = None) -> DataFrame:
    """``(ts, values of one, values of two)``; ``ts`` is the dominant row's time."""
    pairs = alternating_pairs(one, two, rows_per_slice)
    return pairs.select(
        *one.by,
        F.when(F.col("_side") == 0, F.col("_row0.ts")).otherwise(F.col("_row1.ts")).alias("ts"),
        *[F.col("_row0")[v].alias(f"{v}_1") for v in one.values],
        *[F.col("_row1")[v].alias(f"{v}_2") for v in two.values],
    )


# --- three-way ---------------------------------------------------------------------
#
# State: (dominant side, rank of the head of each stream). The dominant head is joined with
# the nearer of the first two rows of each other stream, the second one if they are equally
# near. The stream of the earliest of the three (by time, then by stream) drops its head and becomes dominant. A step
# belongs to the slice of that earliest row. Until the first step whose earliest row lies behind a cut, no row behind the
# cut was dropped, and in that step each chosen row, the head or the one after it, lies behind it. So a
# slice is entered with each head at its first own row or one before it, the dominant one at it: the state between two slices
# is the dominant side, and for each stream whether its head is one before.


def _step_three(st: Stretch, state: tuple[int, ...]):
    """(chosen ranks, the stream that goes ahead, next state), or None if the join waits for ever."""
    dominant, heads = state[0], state[1:]
    at = heads[dominant] - st.base[dominant]
    if at >= len(st.times[dominant]):
        return None
    t = st.times[dominant][at]
    chosen, times = [], []
    for side in range(3):
        rank = heads[side]
        if side != dominant:
            rows, k = st.times[side], rank - st.base[side]
            if k + 1 >= len(rows):
                return None
            if abs(t - rows[k]) >= abs(t - rows[k + 1]):
                rank += 1
        chosen.append(rank)
        times.append(st.times[side][rank - st.base[side]])
    ahead = times.index(min(times))
    moved = [h + (side == ahead) for side, h in enumerate(heads)]
    return chosen, ahead, (ahead, *moved)


def _three_code(state: tuple[int, ...], at: list[int]) -> int:
    """A state as one number, by how far its heads are before the ranks ``at``."""
    return 8 * state[0] + sum((a - h) << side for side, (h, a) in enumerate(zip(state[1:], at)))


def _walk_three(st: Stretch, code: int) -> Iterator[tuple[int, ...]]:
    state = (code // 8, *[low - (code >> side & 1) for side, low in enumerate(st.low)])
    while step := _step_three(st, state):
        chosen, ahead, then = step
        if chosen[ahead] >= st.high[ahead]:
            return
        yield (state[0], *chosen)
        state = then


def _reduce_three(st: Stretch) -> list[tuple[int, int]]:
    """(entry, exit) for the twelve possible ways in."""
    rules, passed = [], {}
    for code in range(24):
        dominant, back = code // 8, [code >> side & 1 for side in range(3)]
        heads = [low - b for low, b in zip(st.low, back)]
        if back[dominant] or any(b and h < base for b, h, base in zip(back, heads, st.base)):
            continue
        state = (dominant, *heads)
        trail, leave = [], None
        while leave is None:
            # ways that meet stay together; look every 16 steps
            if sum(state[1:]) % 16 == 0:
                if state in passed:
                    leave = passed[state]
                    break
                trail.append(state)
            step = _step_three(st, state)
            if step is None:
                leave = END
            elif step[0][step[1]] >= st.high[step[1]]:
                leave = _three_code(state, st.high)
            else:
                state = step[2]
        passed.update(dict.fromkeys(trail, leave))
        rules.append((code, leave))
    return rules


def three_way_pairs(
    one: Series, two: Series, three: Series, rows_per_slice: int | None = None
) -> DataFrame:
    """Joined rows as ``by..., _side`` (the dominant one), ``_row0, _row1, _row2``."""
    layout = lay_out([one, two, three], ahead=2, rows_per_slice=rows_per_slice)
    by = layout.by

    def reduce_slices(rows: pa.Table) -> list[np.ndarray]:
        # a state has no lead here: all of it is in the number
        rules = [(st.row, on, 1, to, 0) for st in stretches(rows, by, 3) for on, to in _reduce_three(st)]
        return list(np.array(rules, np.int64).reshape(-1, 5).T)

    def walk(rows: pa.Table, on: np.ndarray, lead: np.ndarray) -> list[np.ndarray]:
        found = [(st.row, *step) for st in stretches(rows, by, 3) for step in _walk_three(st, int(on[st.row]))]
        return list(np.array(found, np.int64).reshape(-1, 5).T)

    found = walk_all(
        layout,
        start=(0, 0),
        reduce_slices=reduce_slices,
        walk=walk,
        columns=["_side", "_rank0", "_rank1", "_rank2"],
    )
    return join_ranks(found, layout, {"_rank0": 0, "_rank1": 1, "_rank2": 2})


def three_way_delta_join(
    one: Series, two: Series, three: Series, rows_per_slice: int | None = None
) -> DataFrame:
    """``(dominant: struct<ts, value>, joined: struct<v1, v2, v3>)`` of the first values."""
    series = (one, two, three)
    pairs = three_way_pairs(*series, rows_per_slice=rows_per_slice)
    head = F.coalesce(
        *[
            F.when(
                F.col("_side") == i,
                F.struct(F.col(f"_row{i}.ts").alias("ts"), F.col(f"_row{i}")[s.value].alias("value")),
            )
            for i, s in enumerate(series)
        ]
    )
    values = [F.col(f"_row{i}")[s.value].alias(f"v{i + 1}") for i, s in enumerate(series)]
    return pairs.select(*one.by, head.alias("dominant"), F.struct(*values).alias("joined"))
