"""Tables of slices, put together in any way, against walks over whole keys; cuts through equal times; many slices."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests import simulate
from weftline.operators import turn_joins, turns
from weftline.operators.slices import SLICE, slice_rows
from weftline.operators.queue_joins import merge
from weftline.series import Series


def cut_up(streams, cuts, ahead):
    """The frame of one key that lay_out would make, cut before the given places of the order (t, side, seq)."""
    rows = sorted((t, side, rank) for side, rows in enumerate(streams) for rank, (t, _) in enumerate(rows))
    bounds = [0, *cuts, len(rows)]
    out = []
    for number, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]), 1):
        own = rows[a:b]
        if not own:
            continue
        out += [(number, *r, 0, None) for r in own]
        for side, stream in enumerate(streams):
            low = sum(s == side for _, s, _ in rows[:a])
            high = low + sum(s == side for _, s, _ in own)
            if low:
                t = stream[low - 1][0]
                out.append((number, t, side, low - 1, -1, next(r for r, (u, _) in enumerate(stream) if u == t)))
            out += [(number, stream[r][0], side, r, k + 1, None) for k, r in enumerate(range(high, min(high + ahead, len(stream))))]
    random.Random(len(rows)).shuffle(out)
    names = [SLICE, "_t", "_side", "_rank", turns.PART, turns.OPENS]
    return pa.table([pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 6, names=names)


def tables(pdf, reduce_slices):
    """The table of each slice."""
    found = reduce_slices(pdf)
    slices = turns.numbers(pdf, SLICE)
    number = slices[found[0].astype(np.int64)]
    return {k: turns.Table(*(c[number == k].astype(np.int64) for c in found[1:])) for k in set(slices.tolist())}


def folded(parts, rng):
    """Neighbours put together at random until one table is left."""
    while len(parts) > 1:
        at = rng.randrange(len(parts) - 1)
        parts[at : at + 2] = [parts[at].then(parts[at + 1])]
    return parts[0]


def joined(streams, cuts, ahead, reduce_slices, walk, rng):
    """Results from slices walked each from its own entry state, which the tables give."""
    pdf = cut_up(streams, cuts, ahead)
    if not len(pdf):
        return []
    by_slice = tables(pdf, reduce_slices)
    state, entry = (np.array([0]), np.array([0])), {}
    numbers = sorted(by_slice)
    for k in numbers:
        entry[k] = state[0][0], state[1][0]
        state = by_slice[k].leave(*state)
    whole = folded([by_slice[k] for k in numbers], rng)
    assert [int(c[0]) for c in whole.leave(np.array([0]), np.array([0]))] == [int(c[0]) for c in state]
    on, lead = (np.array([entry[k][i] for k in turns.numbers(pdf, SLICE).tolist()]) for i in (0, 1))
    alive = on >= 0
    pdf = pdf.filter(pa.array(alive))
    return [tuple(int(c[i]) for c in found[1:]) for found in [walk(pdf, on[alive], lead[alive])] for i in range(len(found[0]))]


def alternating(pdf, on, lead):
    if not len(pdf):
        return [np.zeros(0, np.int64)] * 4
    first = np.unique(turns.codes(pdf, [SLICE]), return_index=True)[1]
    return turn_joins._Forest(pdf, []).pairs(on[first], lead[first])


def three_way(pdf, on, lead):
    found = [(st.row, *step) for st in turns.stretches(pdf, [], 3) for step in turn_joins._walk_three(st, int(on[st.row]))]
    return list(np.array(found, np.int64).reshape(-1, 5).T)


def reduce_three(pdf):
    rules = [(st.row, on, 1, to, 0) for st in turns.stretches(pdf, [], 3) for on, to in turn_joins._reduce_three(st)]
    return list(np.array(rules, np.int64).reshape(-1, 5).T)


CASES = [(k, c) for seed, ties in ((1, True), (2, False)) for k, c in simulate.random_cases(150, 3, 18, ties=ties, seed=seed).items()]


@pytest.mark.parametrize("sides", [2, 3])
def test_random_cuts(sides):
    rng = random.Random(sides)
    for _, case in CASES:
        streams = [sorted(s) for s in case[:sides]]
        n = sum(map(len, streams))
        if sides == 2:
            want = [(d, streams[0].index(a), streams[1].index(b)) for d, a, b in simulate.alternating(*streams)]
            reduce_slices, walk, ahead = lambda pdf: turn_joins._Forest(pdf, []).rules(), alternating, 1
        else:
            want = [(d, *[s.index(r) for s, r in zip(streams, chosen)]) for d, _, chosen in simulate.three_way(streams)]
            reduce_slices, walk, ahead = reduce_three, three_way, 2
        for _ in range(3):
            cuts = sorted(rng.randint(0, n) for _ in range(rng.randint(0, 6)))
            got = joined(streams, cuts, ahead, reduce_slices, walk, rng)
            if sides == 2:  # a step without a partner falls away when rows are joined to ranks
                got = [g for g in got if g[1] < len(streams[0]) and g[2] < len(streams[1])]
            assert sorted(got) == sorted(want), (streams, cuts)


def test_first_above():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 64, 100):
        values = rng.integers(0, 12, n)
        levels = turn_joins._ladder(values)
        start, bound = rng.integers(0, n, 50), rng.integers(-1, 13, 50)
        want = [next((i for i in range(a, n) if values[i] > b), n) for a, b in zip(start, bound)]
        assert turn_joins._first_above(levels, start, bound).tolist() == want


def numbered(spark, n, t, sides):
    """Rows in turn of each stream, as series without a key."""
    rows = spark.range(n).select((F.col("id") % sides).alias("kind"), t.alias("ts"), F.col("id").alias("seq"), F.col("id").cast("double").alias("value"))
    return [Series(rows.where(F.col("kind") == k).drop("kind")) for k in range(sides)]


def same(a, b):
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 1000


@pytest.mark.parametrize("sides", [2, 3])
def test_many_slices_in_pairs(spark, monkeypatch, sides):
    """Thousands of slices of one key, never more than two tables at a time."""
    t = (F.pmod(F.xxhash64("id"), F.lit(9)) + F.col("id") * 3).cast("double")
    series = numbered(spark, 6_000 if sides == 2 else 3_000, t, sides)
    join = turn_joins.alternating_delta_join if sides == 2 else turn_joins.three_way_delta_join
    whole = join(*series, rows_per_slice=1_000_000)
    monkeypatch.setattr(turns, "RULES_PER_BLOCK", 1)
    same(join(*series, rows_per_slice=4 if sides == 2 else 12), whole)


def test_one_time_is_cut(spark):
    """All rows of one time: slices of bounded size, and the rows meet in order."""
    n = 400_000
    one, two = numbered(spark, n, F.lit(5.0), 2)
    sl = slice_rows(merge(one, two), (), ("_t", "_side", "_seq"), 50_000)
    assert sl.df.groupBy(SLICE).count().agg(F.max("count")).first()[0] < 100_000
    got = turn_joins.alternating_delta_join(one, two, rows_per_slice=50_000)
    assert got.where("value_2 = value_1 + 1 AND value_1 % 2 = 0").count() == got.count() == n // 2
