"""Step-by-step models of the joins, one row at a time. A row is ``(ts, seq)``."""

from __future__ import annotations

import random


def random_cases(count: int, streams: int, longest: int, ties: bool, seed: int):
    """``{case: [rows of stream 0, rows of stream 1, ..]}`` with bursts and empty sides."""
    rng = random.Random(seed)
    cases = {}
    for case in range(count):
        span = rng.choice([6, 20, 60]) if ties else 10_000
        pool = []
        for side in range(streams):
            n = rng.choice([0, 1, 2, rng.randint(0, longest), rng.randint(0, longest)])
            low, high = sorted((rng.randint(0, span), rng.randint(0, span)))
            if rng.random() < 0.6:
                low, high = 0, span
            pool += [(rng.randint(low, high), side) for _ in range(n)]
        if not ties:
            times = rng.sample(range(span * 2), len(pool))
            order = sorted(range(len(pool)), key=lambda i: pool[i][0])
            pool = [(t, pool[i][1]) for t, i in zip(sorted(times), order)]
        rng.shuffle(pool)
        rows = [[] for _ in range(streams)]
        for seq, (ts, side) in enumerate(sorted(pool, key=lambda p: p[0])):
            rows[side].append((ts, seq))
        cases[case] = rows
    return cases


def fuzzy_merge(s, t):
    pairs, dropped, at = [], [], 0
    for row in s:
        while at < len(t) and t[at][0] < row[0]:
            dropped.append((t[at], len(dropped) + 1))
            at += 1
        if at == len(t):
            break
        pairs.append((row, t[at]))
        at += 1
    return pairs, dropped


def bufferless(d, n, newest):
    pairs, dropped, waiting, at = [], [], [], 0
    for row in d:
        while at < len(n) and n[at][0] <= row[0]:
            waiting.append(n[at])
            at += 1
        if waiting:
            pairs.append((row, waiting.pop(-1 if newest else 0)))
        else:
            dropped.append((row, len(dropped) + 1))
    return pairs, dropped


def alternating(one, two):
    """Rows ``(dominant stream, row of one, row of two)``."""
    pending = [list(one), list(two)]
    dominant, out = 0, []

    def emit(mine, other):
        pair = (mine, other) if dominant == 0 else (other, mine)
        out.append((dominant, *pair))

    while pending[dominant]:
        mine, other = pending[dominant], pending[1 - dominant]
        head = mine[0]
        later = next((i for i, r in enumerate(other) if r[0] >= head[0]), None)
        if later is None:
            break
        if later == 0:
            emit(head, other[0])
            mine.pop(0)
            other.pop(0)
        elif head[0] - other[later - 1][0] <= other[later][0] - head[0]:
            emit(head, other[later - 1])
            del other[:later]
            dominant = 1 - dominant
        else:
            emit(head, other[later])
            mine.pop(0)
            del other[:later]
    return out


def symmetric(one, two):
    """Rows ``(dominant stream, dominant row, partner row)``.

    Rows take turns in the order (time, stream, seq). Each joins the rows of the
    other stream at the least distance. A later partner is remembered: when its own
    turn comes right after a change of stream it is passed over, and the other
    stream forgets everything before it.
    """
    merged = sorted([(t, 0, q) for t, q in one] + [(t, 1, q) for t, q in two])
    forgotten = [None, None]  # rows of a stream below this are gone
    partner = [None, None]  # newest row of a stream taken as a later partner
    out, before = [], None
    for at, row in enumerate(merged):
        side = row[1]
        changed = before is not None and before != side
        before = side
        if changed and partner[side] == row:
            forgotten[1 - side] = row
            continue
        rest = [r for r in merged[at + 1 :] if r[1] != side]
        if not rest:
            break
        past = [r for r in merged[:at] if r[1] != side]
        if past and forgotten[1 - side] is not None and past[-1] < forgotten[1 - side]:
            past = []
        choice = past[-1:] + rest[:1]
        least = min(abs(r[0] - row[0]) for r in choice)
        chosen = [r for r in choice if abs(r[0] - row[0]) == least]
        for other in chosen:
            out.append((side, (row[0], row[2]), (other[0], other[2])))
            if other > row:
                partner[1 - side] = other
        forgotten[1 - side] = max(filter(None, [forgotten[1 - side], chosen[0]]))
    return out


def three_way(streams):
    """Rows ``(dominant stream, dominant row, (chosen row per stream))``."""
    pending = [list(s) for s in streams]
    dominant, out = 0, []
    while pending[dominant] and all(len(p) >= 2 for i, p in enumerate(pending) if i != dominant):
        head = pending[dominant][0]
        chosen = []
        for i, rows in enumerate(pending):
            if i == dominant:
                chosen.append(head)
            else:
                first = abs(head[0] - rows[0][0]) < abs(head[0] - rows[1][0])
                chosen.append(rows[0] if first else rows[1])
        out.append((dominant, head, tuple(chosen)))
        ahead = min(range(3), key=lambda i: chosen[i][0])
        pending[ahead].pop(0)
        dominant = ahead
    return out
