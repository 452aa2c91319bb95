"""The same result for every slice size and every type of value, order and time."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weftline.folders import shared_root
from weftline.functions import scalars
from weftline.operators import metrics
from weftline.operators import queue_joins as q
from weftline.operators import windows as w
from weftline.operators.delta_joins import minimal_delta_join
from weftline.operators.slices import HALO, with_halo
from weftline.operators.turn_joins import alternating_delta_join
from weftline.series import Series

START = datetime(2024, 1, 1)
JOINS = [
    q.fuzzy_merge_join, q.bufferless_newest_join, q.bufferless_oldest_join, minimal_delta_join, alternating_delta_join,
]


def rows(spark, n=60):
    data = [(i % 3 if i % 11 else None, START + timedelta(seconds=i * 5 % 97), i, float(i * 7 % 20)) for i in range(n)]
    return spark.createDataFrame(data, "k int, ts timestamp, seq long, value double")


def collected(df):
    return sorted((repr(r) for r in df.collect()))


KINDS = {
    "plain": lambda: {},
    "map": lambda: {"value": F.create_map(F.lit("x"), F.col("value"))},
    "decimal seq": lambda: {"seq": F.col("seq").cast("decimal(12,2)")},
    "decimal clock": lambda: {"ts": (F.unix_seconds("ts") % 1000).cast("decimal(12,1)") / 2},
    "string seq": lambda: {"seq": F.format_string("%05d", "seq")},
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("by", [(), ("k",)])
def test_joins_do_not_depend_on_slices(spark, kind, by):
    df = rows(spark).withColumn("_half", F.col("value") % 2)
    df = df.withColumns(KINDS[kind]()) if kind != "plain" else df
    s, t = (Series(df.where(F.col("_half") == i), by=by) for i in (0, 1))
    joins = JOINS if kind == "plain" else JOINS[:4:3] + JOINS[4:] * (kind == "decimal clock" and not by)
    for join in joins:
        whole = collected(join(s, t, rows_per_slice=1000))
        assert whole and collected(join(s, t, rows_per_slice=4)) == whole


def test_nulls_in_averages(spark):
    data = [(START + timedelta(seconds=i), i, v) for i, v in enumerate([1.0, None, 3.0])]
    s = Series(spark.createDataFrame(data, "ts timestamp, seq long, value double"))
    for size in (1000, 1):
        assert [r.avg for r in w.count_sliding(s, 2, size).orderBy("newest_ts").collect()] == [1.0, 1.0, 3.0]
        assert [r.avg for r in w.landmark(s, rows_per_slice=size).orderBy("ts").collect()] == [1.0, 1.0, 2.0]
        assert w.moving_average(s, 3, size).orderBy("ts").collect()[2].moving_avg == 2.0
    empty = s.with_df(s.df.withColumn("value", F.lit(None).cast("double")))
    assert {r.avg for r in w.count_sliding(empty, 2).collect()} == {None}
    assert w.landmark_points(Series(spark.range(120).select(F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"), F.lit(1).alias("value")))).count() == 120


def test_rows_without_a_time_are_left_out_and_counted(spark):
    df = rows(spark).withColumn("ts", F.when(F.col("seq") % 5 != 0, F.col("ts")))
    s, timed = Series(df, by="k"), Series(df.where("ts is not null"), by="k")
    for run in (lambda x: w.tumbling(x, 10), lambda x: w.count_sliding(x, 3), lambda x: w.landmark(x)):
        assert collected(run(s)) == collected(run(timed))
    halves = lambda x: [x.with_df(x.df.where(F.col("value") % 2 == i)) for i in (0, 1)]
    for join in JOINS:
        assert collected(join(*halves(s))) == collected(join(*halves(timed)))
    assert sum(r.untimed for r in metrics.untimed(s).collect()) == 12


def test_frames_longer_than_a_slice(spark):
    s = Series(spark.range(4000).select(F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"), F.col("id").alias("value")))
    sl = w._ordered(s, 100, least=2000)
    copied = with_halo(sl, sl.df, 1999).where(F.col(HALO)).count()
    slices = sl.df.select("_slice").distinct().count()
    assert copied <= 2000 * (slices - 1)
    last = w.count_sliding(s, 2000, 100).orderBy(F.desc("newest_ts")).first()
    assert (last["count"], last["min"], last["max"], last.avg) == (2000, 2000, 3999, 2999.5)


def test_dates_are_times(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), 1, 1.0), (date(2024, 1, 2), 2, 1.0)], "ts date, seq long, value double")
    s = Series(df)
    assert sorted(r[0] for r in df.select(scalars.relative_time(s)).collect()) == [0.0, 86400.0]


def test_fractional_windows_lose_nothing(spark):
    data = [(i / 20, i, Decimal(i)) for i in range(400) if i % 7 < 4]
    s = Series(spark.createDataFrame(data, "ts double, seq long, value decimal(10,2)"))
    found = {r.start: r["count"] for r in w.tumbling(s, 0.1).collect()}
    filled = {r.start: r["count"] for r in w.tumbling_filled(s, 0.1).collect()}
    assert {k: v for k, v in filled.items() if v} == found and len(filled) > len(found)


def test_a_cluster_needs_a_shared_folder(spark):
    class Session:
        conf = spark.conf
        sparkContext = type("Context", (), {"master": "spark://somewhere:7077"})  # noqa: N815

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="share"):
            shared_root(Session)
