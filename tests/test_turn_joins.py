import pytest

from tests import simulate
from tests.cases import as_series, by_case, expected
from tests.test_queue_joins import points
from weftline.operators.turn_joins import alternating_delta_join, three_way_delta_join
from weftline.series import Series

CASES = simulate.random_cases(120, 2, 16, ties=True, seed=41) | {
    1000 + k: v for k, v in simulate.random_cases(120, 2, 20, ties=False, seed=42).items()
}
THREE = simulate.random_cases(100, 3, 12, ties=True, seed=51) | {
    1000 + k: v for k, v in simulate.random_cases(100, 3, 16, ties=False, seed=52).items()
}
LIMITS = pytest.mark.parametrize("rows_per_slice", [1000, 4])


@LIMITS
def test_alternating(spark, rows_per_slice):
    one, two = as_series(spark, CASES, 0), as_series(spark, CASES, 1)
    got = alternating_delta_join(one, two, rows_per_slice=rows_per_slice)
    want = expected(
        CASES,
        lambda c: [((a, b)[d][0], float(a[1]), float(b[1])) for d, a, b in simulate.alternating(*c)],
    )
    assert by_case(got, "ts", "value_1", "value_2") == want


@LIMITS
def test_three_way(spark, rows_per_slice):
    sides = [as_series(spark, THREE, i) for i in range(3)]
    got = three_way_delta_join(*sides, rows_per_slice=rows_per_slice)
    got = got.selectExpr("case", "dominant.ts", "dominant.value", "joined.v1", "joined.v2", "joined.v3")
    want = expected(
        THREE,
        lambda c: [
            (head[0], float(head[1]), *[float(r[1]) for r in chosen])
            for _, head, chosen in simulate.three_way(c)
        ],
    )
    assert by_case(got, "ts", "value", "v1", "v2", "v3") == want


@pytest.mark.parametrize("rows_per_slice", [900, 40])
def test_without_key(spark, rows_per_slice):
    rows = next(c for c in simulate.random_cases(50, 3, 300, ties=True, seed=9).values() if min(map(len, c)) > 50)
    sides = [Series(as_series(spark, {0: rows}, i).df) for i in range(3)]
    got = alternating_delta_join(*sides[:2], rows_per_slice=rows_per_slice).collect()
    want = [((a, b)[d][0], float(a[1]), float(b[1])) for d, a, b in simulate.alternating(*rows[:2])]
    assert sorted(map(tuple, got)) == sorted(want)
    got = three_way_delta_join(*sides, rows_per_slice=rows_per_slice).collect()
    want = [(h[0], float(h[1]), *[float(r[1]) for r in c]) for _, h, c in simulate.three_way(rows)]
    assert sorted((*r.dominant, *r.joined) for r in got) == sorted(want)


def test_golden(spark):
    def pairs(one, two):
        got = alternating_delta_join(points(spark, one), points(spark, two))
        return sorted(map(tuple, got.collect()))

    assert pairs([1, 5, 9], [2, 4, 6, 8, 10]) == [(1, 1, 2), (5, 5, 4), (6, 5, 6), (9, 9, 8)]
    assert pairs([10], [1, 2, 12]) == [(10, 10, 12)]
    assert pairs([1, 2, 3], [4, 5, 6]) == [(1, 1, 4), (2, 2, 5), (3, 3, 6)]
