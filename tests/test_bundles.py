"""Keys in bundles, without a running stream."""

import itertools
import json
import random

import pandas as pd
import pytest

from tests.test_gaps import Value
from weftline.streaming import lines, machines, ordered


class Parts(dict):
    def __init__(self):
        self.calls = 0

    def getValue(self, key):
        self.calls += 1
        return self[key]

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def containsKey(self, key):
        self.calls += 1
        return key in self

    def removeKey(self, key):
        self.calls += 1
        del self[key]


class Handle:
    def __init__(self):
        self.maps, self.timers = {}, []

    def getValueState(self, name, kind):
        return Value()

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, Parts())

    def registerTimer(self, ms):
        self.timers.append(ms)


class Passed:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def text(key):
    return json.dumps({"k": key})


def frames(rows, size):
    columns = ["in_t", "in_side", "in_key", "in_row"]
    return iter([pd.DataFrame(rows[i : i + size], columns=columns) for i in range(0, len(rows), size)])


def made(n, keys, sides=1, seed=3):
    """Rows out of order, with equal times and seqs, as a bundle gets them."""
    rng = random.Random(seed)
    found = []
    for i in range(n):
        seq = None if i % 17 == 4 else rng.randrange(n)
        value = None if i % 13 == 6 else f"{rng.randrange(100)}.50"
        found.append((1000 * rng.randrange(n // 3), i % sides, text(rng.randrange(keys)), f'{{"ts":{i},"seq":{json.dumps(seq)},"v0":{value or "null"}}}'))
    return found


def processor(machine, sides=1, of=ordered.InOrder):
    columns = [c.split() for c in machine.columns.split(", ")]
    p = of(machine, [c for c, _ in columns], [c for c, k in columns if k == "double"], [(True, True)] * sides)
    p.init(Handle())
    return p


def by_key(found):
    rows = {}
    for frame in found:
        for row in frame.itertuples(index=False):
            rows.setdefault(row[0], []).append(tuple(map(str, row[1:])))
    return rows


def test_many_keys_cost_few_calls_and_frames():
    """F2 to F5, F7: a key used to be a group of its own, with its own frames, timers and some ten calls of state."""
    p = processor(machines.clock(0.5))
    rows = made(12_000, keys=3000)
    list(p.handleInputRows((7,), frames(rows, 10_000), Passed(0)))
    assert len(p.handle.timers) == 1
    found = list(p.handleExpiredTimer((7,), Passed(10**9), None))
    assert len(found) <= 12_000 // ordered._BLOCK + 1
    assert sum(map(len, found)) == 12_000
    keys = len(by_key(found))
    assert len(p.handle.maps["memories"]) == keys > 2900 and p.handle.maps["memories"].calls <= 3 * keys
    assert p.handle.maps["parts"].calls <= 3 * (12_000 // lines.SIZE + 2) and not p.handle.maps["parts"] and not p.waiting.exists()


@pytest.mark.parametrize(
    "make, sides",
    [
        (lambda: machines.count_sliding(5), 1),
        (lambda: machines.shed_oldest(4), 1),
        (machines.landmark, 1),
        (machines.three_way, 3),
        (lambda: machines.queue(True), 2),
    ],
)
def test_bundles_give_what_single_keys_give(monkeypatch, make, sides):
    """Several runs, small steps and watermarks that pass bit by bit, against each key alone, sorted in memory."""
    rows = made(600, keys=7, sides=sides)
    want = {}
    for key in {row[2] for row in rows}:
        p, memory = processor(make(), sides), {"own": {}, "ends": {}}
        mine = sorted((p._row(*row) for row in rows if row[2] == key), key=lambda r: r[:3])
        for row in mine:
            if p.machine.arrive:
                p.machine.arrive(memory["own"], row)
        held = lines.Lines(lines.Store(Parts()), memory["ends"])
        out = [(key, *o) for row in mine for o in p.machine.step(memory["own"], held, row)]
        want |= by_key([p._frame(out)] if out else [])
    monkeypatch.setattr(ordered, "_RUN", 40)
    monkeypatch.setattr(ordered, "_BLOCK", 16)
    monkeypatch.setattr(lines, "SIZE", 8)
    monkeypatch.setattr(lines, "_SEEN", 4)
    p, found = processor(make(), sides), []
    list(p.handleInputRows((1,), frames(rows, 30), Passed(0)))
    for ms in itertools.chain(range(0, 200, 9), [10**6]):
        found += p.handleExpiredTimer((1,), Passed(ms), None)
    assert by_key(found) == want and len(want) == 7
    assert not p.handle.maps["parts"] and not p.waiting.exists()
    assert max(map(len, found)) <= 2 * 16


def test_a_long_key_is_filed_in_pieces(monkeypatch):
    """F1: all rows of a key in a micro-batch were held at once."""
    monkeypatch.setattr(ordered, "_RUN", 1000)
    sizes, p = [], processor(machines.running_min_max())
    file = p._file
    monkeypatch.setattr(p, "_file", lambda waiting, fresh: sizes.append(len(fresh)) or file(waiting, fresh))
    list(p.handleInputRows((1,), frames(made(20_000, keys=1), 500), Passed(0)))
    assert sum(sizes) == 20_000 and max(sizes) <= 1500
    assert sum(map(len, p.handleExpiredTimer((1,), Passed(10**9), None))) == 20_000


def test_clocks_of_many_keys(monkeypatch):
    """the join behind two clocks gives the same in one piece and in many, with as few calls."""
    rng = random.Random(5)
    rows = [(text(k), float(i) / (1 + side), side, f'{{"ts":{i},"seq":{i},"v0":{i}}}') for k in range(200) for side in (0, 1) for i in range(6)]
    rng.shuffle(rows)
    columns = ["in_key", "in_clock", "in_side", "in_row"]

    def run(size):
        p = processor(machines.symmetric(), 2, ordered.InClockOrder)
        monkeypatch.setattr(Parts, "keys", lambda self: iter([*self]), raising=False)
        given = iter([pd.DataFrame(rows[i : i + size], columns=columns) for i in range(0, len(rows), size)])
        found = list(p.handleInputRows((1,), given, Passed(0)))
        assert p.handle.timers == [ordered._LAST_MS]
        assert p.handle.maps["memories"].calls <= 3 * 200 + 3 * len(rows) // ordered._RUN
        found += p.handleExpiredTimer((1,), Passed(ordered._LAST_MS), None)
        return by_key(found), len(found)

    whole, n = run(10_000)
    assert n <= 4 and len(whole) == 200
    monkeypatch.setattr(ordered, "_RUN", 50)
    assert run(30)[0] == whole
