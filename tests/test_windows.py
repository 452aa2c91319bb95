import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from weftline.operators import windows as w
from weftline.series import Series

RNG = random.Random(4)
KEYS = {
    k: [(ts, seq, float(RNG.randint(-9, 9))) for seq, ts in enumerate(sorted(RNG.randint(0, 50) for _ in range(n)))]
    for k, n in enumerate([0, 1, 2, 5, 9, 17, 40, 64])
}


@pytest.fixture(scope="module")
def keyed(spark):
    rows = [(k, *r) for k, rs in KEYS.items() for r in rs]
    RNG.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, ts bigint, seq bigint, value double")
    return Series(df, by="k")


def check(df, per_key):
    got = sorted(map(tuple, df.collect()))
    want = sorted((k, *row) for k, rows in KEYS.items() for row in per_key(rows))
    assert got == want


LIMITS = pytest.mark.parametrize("rows_per_slice", [1000, 12, 1])
#: Frames read anew for every row, and frames put together from two parts.
FRAMES = pytest.mark.parametrize("short", [64, 0])


@LIMITS
@FRAMES
@pytest.mark.parametrize("n", [1, 4, 10])
def test_count_sliding(keyed, rows_per_slice, n, short, monkeypatch):
    monkeypatch.setattr(w, "SHORT_FRAME", short)
    def expect(rows):
        for i in range(len(rows)):
            frame = rows[max(0, i - n + 1) : i + 1]
            v = [r[2] for r in frame]
            yield frame[0][0], frame[-1][0], len(v), sum(v) / len(v), min(v), max(v)

    check(w.count_sliding(keyed, n, rows_per_slice), expect)


@LIMITS
@FRAMES
def test_window_extrema(keyed, rows_per_slice, short, monkeypatch):
    monkeypatch.setattr(w, "SHORT_FRAME", short)
    for largest in (True, False):
        def expect(rows):
            for i in range(len(rows)):
                frame = rows[max(0, i - 4) : i + 1]
                best = min(frame, key=lambda r: (-r[2] if largest else r[2], r[0], r[1]))
                yield rows[i][0], best[0], best[2]

        check(w.window_extrema(keyed, 5, largest, rows_per_slice), expect)


@LIMITS
def test_running(keyed, rows_per_slice):
    def extremes(rows):
        v = [r[2] for r in rows]
        return [(min(v[: i + 1]), max(v[: i + 1])) for i in range(len(v))]

    check(w.running_min_max(keyed, rows_per_slice), extremes)
    for largest in (True, False):
        def records(rows):
            best = -math.inf if largest else math.inf
            for r in rows:
                if (r[2] > best) if largest else (r[2] < best):
                    best = r[2]
                    yield r

        check(w.record_extrema(keyed, largest=largest, rows_per_slice=rows_per_slice), records)
    check(
        w.ranked(keyed, rows_per_slice=rows_per_slice),
        lambda rows: [(*r, i) for i, r in enumerate(rows, 1)],
    )


@LIMITS
def test_landmark(keyed, rows_per_slice):
    def totals(rows, start):
        rows = [r for r in rows if r[0] >= start]
        for i in range(len(rows)):
            v = [r[2] for r in rows[: i + 1]]
            yield start, rows[i][0], len(v), sum(v), sum(v) / len(v)

    check(w.landmark(keyed, rows_per_slice=rows_per_slice), lambda rows: totals(rows, rows[0][0]) if rows else [])
    check(w.landmark(keyed, start=20, rows_per_slice=rows_per_slice), lambda rows: totals(rows, 20))


def test_landmark_is_the_first_to_arrive(spark):
    df = spark.createDataFrame([(5, 0, 1.0), (3, 1, 2.0), (8, 2, 4.0)], "ts long, seq long, value double")
    got = sorted(map(tuple, w.landmark(Series(df)).collect()))
    assert got == [(5, 5, 1, 1.0, 1.0), (5, 8, 2, 5.0, 2.5)]


def test_moving_average(keyed):
    got = w.moving_average(keyed, 3, rows_per_slice=6).collect()
    for k, rows in KEYS.items():
        mine = {r.seq: r.moving_avg for r in got if r.k == k}
        assert len(mine) == len(rows)
        for i, r in enumerate(rows):
            if i < 2:
                assert math.isnan(mine[r[1]])
            else:
                assert mine[r[1]] == pytest.approx(sum(x[2] for x in rows[i - 2 : i + 1]) / 3)


@pytest.mark.parametrize("rows_per_slice", [1000, 7])
def test_without_key(spark, keyed, rows_per_slice):
    rows = KEYS[7]
    s = Series(keyed.df.where("k = 7"))
    got = sorted(map(tuple, w.count_sliding(s, 6, rows_per_slice).collect()))
    want = []
    for i in range(len(rows)):
        v = [r[2] for r in rows[max(0, i - 5) : i + 1]]
        want.append((rows[max(0, i - 5)][0], rows[i][0], len(v), sum(v) / len(v), min(v), max(v)))
    assert got == sorted(want)


def clock(seconds):
    return datetime(2024, 1, 1) + timedelta(seconds=seconds)


def test_tumbling_golden(spark):
    df = spark.createDataFrame(
        [(clock(t), i, v) for i, (t, v) in enumerate([(103, 1.0), (107, 2.0), (112, 5.0), (135, 7.0)])],
        "ts timestamp_ntz, seq long, value double",
    )
    closed = [(clock(100), clock(110), 2, 1.5), (clock(110), clock(120), 1, 5.0)]
    assert sorted(map(tuple, w.tumbling(Series(df), 10).collect())) == closed
    later = df.unionAll(spark.createDataFrame([(clock(140), 9, 0.0)], df.schema))
    filled = [*closed, (clock(120), clock(130), 0, 0.0), (clock(130), clock(140), 1, 7.0)]
    assert sorted(map(tuple, w.tumbling_filled(Series(later), 10).collect())) == filled
    assert sorted(map(tuple, w.tumbling_filled(Series(later), 10, max_windows=3).collect())) == filled[:3]


def test_numeric_clock(spark):
    df = spark.createDataFrame(
        [(t, i, v) for i, (t, v) in enumerate([(103.0, 1.0), (107.5, 2.0), (112.0, 5.0), (145.0, 7.0)])],
        "ts double, seq long, value double",
    )
    closed = [(100.0, 110.0, 2, 1.5), (110.0, 120.0, 1, 5.0)]
    assert sorted(map(tuple, w.tumbling(Series(df), 10).collect())) == closed
    half = w.tumbling_filled(Series(df), 2.5).collect()
    assert sorted((r.start, r["count"]) for r in half) == [(102.5, 1), (105.0, 0), (107.5, 1), (110.0, 1)]
    assert {r.landmark for r in w.landmark_points(Series(df.withColumn("ts", df.ts + 0.5))).collect()} == {103.0}


def test_one_key_with_a_third_of_all_rows(spark):
    """A large key is cut into slices by itself; the small ones stay whole."""
    rows = spark.range(60_000).selectExpr(
        "id AS seq", "id * 10 AS ts", "cast(id % 97 AS double) AS value",
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id % 500 END AS k",
    )
    got = w.landmark(Series(rows, by="k"))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k" in text and "_slice" in text
    last = got.groupBy("k").agg(F.max("count").alias("n"), F.max_by("sum", "ts").alias("sum"))
    want = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("value").alias("sum"))
    assert last.exceptAll(want).count() == 0 and last.count() == want.count()


def test_landmark_points(spark):
    df = spark.createDataFrame(
        [(clock(1) + timedelta(microseconds=i * 300_000 + 5), i, float(i)) for i in range(6)],
        "ts timestamp, seq long, value double",
    )
    got = sorted(map(tuple, w.landmark_points(Series(df), max_points=4).collect()))
    assert [r[0] for r in got] == [clock(1)] * 4
    assert [(r[2], r[3]) for r in got] == [(1, 0.0), (2, 0.5), (3, 1.0), (4, 1.5)]


@pytest.mark.parametrize("n", [3, 70])
def test_long_and_short_frames_agree_on_odd_values(spark, monkeypatch, n):
    rows = [(i % 2, float(i // 3), f"s{i * 7 % 200:03d}", None if i % 5 < 2 else float("nan") if i % 17 == 3 else float(i * 31 % 40)) for i in range(200)]
    s = Series(spark.createDataFrame(rows, "k int, ts double, seq string, value double"), by="k")
    found = []
    for short in (1000, 0):
        monkeypatch.setattr(w, "SHORT_FRAME", short)
        ops = [w.count_sliding(s, n, 40), w.moving_average(s, n), w.window_extrema(s, n, True, 40), w.window_extrema(s, n, False)]
        found.append([sorted(map(repr, op.collect())) for op in ops])
    assert found[0] == found[1]
