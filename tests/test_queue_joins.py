import pytest

from tests import simulate
from tests.cases import as_series, by_case, expected
from weftline.operators import queue_joins as q
from weftline.series import Series

CASES = simulate.random_cases(150, 2, 14, ties=True, seed=7) | {
    1000 + k: v for k, v in simulate.random_cases(100, 2, 14, ties=False, seed=8).items()
}
LONG = simulate.random_cases(1, 2, 400, ties=True, seed=21)


@pytest.fixture(scope="module")
def sides(spark):
    return as_series(spark, CASES, 0), as_series(spark, CASES, 1)


@pytest.mark.parametrize("rows_per_slice", [1000, 4])
def test_fuzzy_merge(sides, rows_per_slice):
    got = q.fuzzy_merge_join(*sides, rows_per_slice=rows_per_slice)
    want = expected(CASES, lambda c: [(s[0], float(s[1]), float(t[1])) for s, t in simulate.fuzzy_merge(*c)[0]])
    assert by_case(got, "ts", "s_value", "t_value") == want
    drops = q.fuzzy_merge_drops(*sides, rows_per_slice=rows_per_slice)
    want = expected(CASES, lambda c: [(t[0], k) for t, k in simulate.fuzzy_merge(*c)[1]])
    assert by_case(drops, "ts", "dropped_so_far") == want


@pytest.mark.parametrize("rows_per_slice", [1000, 4])
@pytest.mark.parametrize("newest", [True, False])
def test_bufferless(sides, rows_per_slice, newest):
    join = q.bufferless_newest_join if newest else q.bufferless_oldest_join
    got = join(*sides, rows_per_slice=rows_per_slice)
    want = expected(
        CASES, lambda c: [(d[0], float(d[1]), float(n[1])) for d, n in simulate.bufferless(*c, newest)[0]]
    )
    assert by_case(got, "ts", "d_value", "n_value") == want
    drops = q.bufferless_drops(*sides, rows_per_slice=rows_per_slice)
    want = expected(CASES, lambda c: [(d[0], k) for d, k in simulate.bufferless(*c, newest)[1]])
    assert by_case(drops, "ts", "dropped_so_far") == want


@pytest.mark.parametrize("rows_per_slice", [5000, 150, 11])
def test_without_key(spark, rows_per_slice):
    one, two = simulate.random_cases(6, 2, 300, ties=True, seed=5)[3]
    cases = {0: [one or two, two or one]}
    a, b = (as_series(spark, cases, i) for i in (0, 1))
    a, b = Series(a.df), Series(b.df)
    got = q.bufferless_newest_join(a, b, rows_per_slice=rows_per_slice).collect()
    want = [(d[0], float(d[1]), n[0], float(n[1])) for d, n in simulate.bufferless(*cases[0], True)[0]]
    assert sorted(tuple(r) for r in got) == sorted(want)
    got = q.fuzzy_merge_join(a, b, rows_per_slice=rows_per_slice).collect()
    want = [(s[0], float(s[1]), float(t[1])) for s, t in simulate.fuzzy_merge(*cases[0])[0]]
    assert sorted(tuple(r) for r in got) == sorted(want)


def points(spark, times):
    return Series(spark.createDataFrame([(float(t), i, float(t)) for i, t in enumerate(times)], "ts double, seq long, value double"))


def test_golden(spark):
    s, t = points(spark, [1, 2, 3]), points(spark, [0.3, 0.9, 1.2, 1.6, 2.0, 2.4])
    assert sorted(map(tuple, q.fuzzy_merge_join(s, t).collect())) == [(1.0, 1.0, 1.2), (2.0, 2.0, 2.0)]
    drops = [(0.3, 1), (0.9, 2), (1.6, 3), (2.4, 4)]
    assert sorted(map(tuple, q.fuzzy_merge_drops(s, t).collect())) == drops
    d, n = points(spark, [0.5, 3, 4, 5, 7]), points(spark, [1, 2, 6])
    newest = q.bufferless_newest_join(d, n).collect()
    assert sorted((r.ts, r.n_ts) for r in newest) == [(3, 2), (4, 1), (7, 6)]
    oldest = q.bufferless_oldest_join(d, n).collect()
    assert sorted((r.ts, r.n_value) for r in oldest) == [(3, 1), (4, 2), (7, 6)]
    assert sorted(map(tuple, q.bufferless_drops(d, n).collect())) == [(0.5, 1), (5.0, 2)]
