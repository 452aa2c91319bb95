import pytest

from tests import simulate
from tests.cases import as_series, by_case, expected
from tests.test_queue_joins import points
from weftline.operators.delta_joins import minimal_delta_join

CASES = simulate.random_cases(150, 2, 12, ties=True, seed=31) | {
    1000 + k: v for k, v in simulate.random_cases(100, 2, 14, ties=False, seed=32).items()
}


@pytest.mark.parametrize("rows_per_slice", [1000, 3])
def test_symmetric(spark, rows_per_slice):
    one, two = as_series(spark, CASES, 0), as_series(spark, CASES, 1)
    got = minimal_delta_join(one, two, rows_per_slice=rows_per_slice)
    want = expected(
        CASES,
        lambda c: [(d[0], side + 1, float(d[1]), float(p[1])) for side, d, p in simulate.symmetric(*c)],
    )
    assert by_case(got, "ts", "dominant", "d_value", "p_value") == want


def test_golden(spark):
    a, b = points(spark, [1, 5, 9]), points(spark, [2, 4, 6, 8, 10])
    got = sorted((r.d_value, r.p_value) for r in minimal_delta_join(a, b).collect())
    assert got == [(1, 2), (4, 5), (6, 5), (8, 9)]
    a, b = points(spark, [0, 1, 2]), points(spark, [0.5, 1.5, 2.5])
    got = sorted((r.d_value, r.p_value) for r in minimal_delta_join(a, b).collect())
    assert got == [(0, 0.5), (1, 0.5), (1, 1.5), (2, 1.5), (2, 2.5)]
