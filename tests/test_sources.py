from datetime import datetime

from pyspark.sql import functions as F

from weftline.functions import scalars
from weftline.operators import metrics, relational
from weftline.series import Series
from weftline.sources import sinks
from weftline.sources.prices import read_prices, stream_prices
from weftline.sources.series import logical_clock
from weftline.streaming.folders import drain

TEXT = """observation_date,CLOSE
2021-07-01,14522.38
2021-07-05,
x,5
2021-07-06,NULL
2021-07-07,abc
2021-07-08, 14559.78
,7
2021-7-9,1_0.5
2021-13-01,8
2021-07-12,5d
2021-07-13,1e2
"""
KEPT = [
    (datetime(2021, 7, 1), 14522.38),
    (datetime(2021, 7, 8), 14559.78),
    (datetime(2021, 7, 9), 10.5),
    (datetime(2021, 7, 13), 100.0),
]


def test_prices(spark, tmp_path):
    for header in ("observation_date", "observation date"):
        folder = tmp_path / header.replace(" ", "-")
        folder.mkdir()
        (folder / "prices.csv").write_text(TEXT.replace("observation_date", header))
        assert sorted(map(tuple, read_prices(spark, str(folder), "CLOSE").collect())) == KEPT
        live = stream_prices(spark, str(folder), "CLOSE", [header, "CLOSE"])
        assert sorted(map(tuple, drain(live, str(folder) + "-out").collect())) == KEPT


def numbers(spark, n=12):
    rows = [(datetime(2024, 1, 1, 0, 0, i), i, float(i * i % 7), i % 2) for i in range(n)]
    return spark.createDataFrame(rows, "ts timestamp, seq long, value double, k int")


def test_logical_clock(spark):
    got = logical_clock(Series(numbers(spark)), 0.5).rows().collect()
    assert {r.seq: r.ts for r in got} == {i: i * 0.5 for i in range(12)}


def test_selection_and_projection(spark):
    s = Series(numbers(spark))
    kept = relational.select(s, [("value", ">=", 2), (1, "!=", 4)]).rows().collect()
    assert sorted(r.seq for r in kept) == [i for i in range(12) if i * i % 7 >= 2 and i * i % 7 != 4]
    assert relational.select(s, []).df.count() == 12
    assert relational.project(s, ["value", "value"]).columns == ["ts", "value", "value_2"]
    assert relational.project(s, [1, 0]).columns == ["value", "ts"]


def test_latest_rows(spark):
    s = Series(numbers(spark))
    for by in ((), ("k",)):
        keyed = Series(s.df, by=by)
        few = {r.seq for r in relational.keep_latest(keyed, 4).collect()}
        assert few == (set(range(8, 12)) if not by else set(range(4, 12)))
    many = relational.keep_latest(Series(s.df, by="k"), 2000, rows_per_slice=2)
    assert many.count() == 12
    relational._SMALL, kept = 1, relational._SMALL
    try:
        by_rank = relational.keep_latest(s, 5, rows_per_slice=2)
        assert {r.seq for r in by_rank.collect()} == set(range(7, 12))
    finally:
        relational._SMALL = kept
    shed = relational.shed_count(Series(s.df, by="k"), 4).collect()
    assert {r.k: r.shed for r in shed} == {0: 2, 1: 2}
    assert relational.first_rows(s.df, 3, "ts", "seq").count() == 3


def test_sinks(spark, tmp_path):
    s = Series(numbers(spark))
    for _ in range(2):
        assert sinks.append_results(s.rows(), str(tmp_path / "rows")) == 12
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 24
    flushed = sinks.flush_by_count(s, 5, rows_per_slice=3).groupBy("flush").count().collect()
    assert {r.flush: r["count"] for r in flushed} == {0: 5, 1: 5, 2: 2}
    ends = sinks.flush_by_time(s, 6).groupBy("flush").count().collect()
    assert sorted(r["count"] for r in ends) == [6, 6]
    sinks.write_report(spark.createDataFrame([("a", 1.005, 3)], "operator string, x double, n int"), str(tmp_path / "csv"))
    text = spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()
    assert [tuple(r) for r in text] == [("a", "1.01", "3")]


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.clamp(F.lit(120.0), 0, 100).alias("clamped"),
        scalars.watt_hours(F.lit(10.0), F.lit(36)).alias("wh"),
        scalars.reading_or_fallback(F.lit(None).cast("double"), "pressure").alias("pressure"),
        scalars.nearest_of_two(F.lit(2), F.lit("a"), F.lit("b"), F.lit(1), F.lit(3)).alias("tie"),
        scalars.nearest_of_two(F.lit(2), F.lit("a"), F.lit("b"), F.lit(1), F.lit(4)).alias("near"),
    ).first()
    assert tuple(row) == (100.0, 0.1, 1013.25, "b", "a")
    s = Series(numbers(spark))
    assert sorted(r[0] for r in s.df.select(scalars.relative_time(s)).collect()) == list(range(12))


def test_metrics(spark):
    samples = spark.createDataFrame(
        [("j", 1.0, 5.0, {"s": 1, "t": 4}), ("j", 2.0, 3.0, {"s": 2, "t": 0}), ("w", 1.0, 0.0, {"s": 0})],
        "op string, t double, mb double, held map<string,int>",
    )
    got = {r.op: r for r in metrics.run_summary(samples, "op", "t", ["mb"]).collect()}
    assert (got["j"].peak_mb, got["j"].avg_mb, got["j"].final_mb) == (5.0, 4.0, 3.0)
    peaks = metrics.peak_occupancy(samples, "op", "held").collect()
    assert {r.op: r.peak_occupancy for r in peaks} == {"j": "s=2; t=4", "w": "s=0"}
    counted, total = metrics.observed(samples)
    counted.write.format("noop").mode("overwrite").save()
    assert total.get["rows"] == 3
    rate = spark.range(1).select(metrics.throughput(F.lit(6), F.lit(0.0)), metrics.throughput(F.lit(6), F.lit(4.0)))
    assert tuple(rate.first()) == (0.0, 1.5)


def test_columns_are_read_by_name(spark, tmp_path):
    (tmp_path / "p.csv").write_text("symbol,observation_date,CLOSE\nA,2021-07-01,\t5\nB,2021-07-02, 6 \n")
    want = [(datetime(2021, 7, 1), 5.0), (datetime(2021, 7, 2), 6.0)]
    assert sorted(map(tuple, read_prices(spark, str(tmp_path), "CLOSE").collect())) == want
    live = drain(stream_prices(spark, str(tmp_path), "CLOSE"), str(tmp_path) + "-out")
    assert sorted(map(tuple, live.collect())) == want
