import json
import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weftline.operators import queue_joins as q
from weftline.operators import relational
from weftline.operators import windows as w
from weftline.operators.delta_joins import minimal_delta_join
from weftline.operators.turn_joins import alternating_delta_join, three_way_delta_join
from weftline.series import Series
from weftline.sources.series import logical_clock
from weftline.streaming import lines, ordered
from weftline.streaming.folders import Closing, drain, drain_watched, flush, flushed, read_folder

FILES = 3
START = datetime(2024, 1, 1)
SCHEMA = "user int, ts timestamp, seq long, kind string, value double"


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """State of so few keys needs few tasks."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def stream(spark, tmp_path_factory):
    """Rows in several files in time order, shuffled within a file; a last row closes the rest."""
    folder = str(tmp_path_factory.mktemp("stream"))
    rows = [
        (i * 7 % 4, START + timedelta(milliseconds=i * 1900 + i * i % 700), i, "ab"[(i * i // 3) % 2], float(i * 37 % 50))
        for i in range(150)
    ]
    for k in range(FILES):
        part = rows[k * 50 : (k + 1) * 50]
        spark.createDataFrame(sorted(part, key=lambda r: r[2] * 11 % 50), SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/f{k}")
    # a microsecond past the watermark, which is in whole milliseconds: never due
    end = [(u, START + timedelta(days=1, microseconds=1), 1000, "z", 0.0) for u in range(4)]
    spark.createDataFrame(end, SCHEMA).coalesce(1).write.parquet(f"{folder}/f{FILES}")
    batch = spark.createDataFrame(rows, SCHEMA)
    for k in range(FILES + 1):  # one file per trigger, oldest first
        for name in os.listdir(f"{folder}/f{k}"):
            os.utime(f"{folder}/f{k}/{name}", (1_700_000_000 + k * 60,) * 2)
    return batch, read_folder(spark, f"{folder}/*", SCHEMA, files_per_trigger=1)


def check(got, want, tmp_path):
    columns = want.columns
    found = drain(got, str(tmp_path)).select(*columns)
    assert sorted(found.collect(), key=repr) == sorted(want.collect(), key=repr)
    assert want.count() > 10


def of(df, kind=None):
    """A series; the closing rows keep their key but belong to no kind."""
    return Series(df.where(F.col("kind") == kind) if kind else df.where("kind <> 'z'"), by="user")


def test_tumbling(stream, tmp_path):
    batch, live = stream
    got = ordered.tumbling(Series(live, by="user"), 10)
    check(got, w.tumbling(of(batch), 10).unionByName(last_windows(batch)), tmp_path)


def last_windows(batch):
    """The closing rows also close the window that is open at the end of the batch."""
    closed = w.tumbling(of(batch), 10)
    rows = batch.groupBy("user", F.window("ts", "10 seconds").alias("w")).agg(
        F.count("*").alias("count"), (F.sum("value") / F.count("*")).alias("avg")
    )
    every = rows.select("user", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "count", "avg")
    return every.join(closed, ["user", "start"], "left_anti")


# --- finished inputs: six files, one a trigger, rows out of order and with all kinds of values ---

KINDS = "user int, ts timestamp_ntz, seq string, kind string, value double, exact decimal(12,3), list array<int>"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Rows with equal times, null and NaN values, null times and text as seq, null too; a micro-batch goes on where the one before ended."""
    folder = str(tmp_path_factory.mktemp("odd"))
    rows = []
    for i in range(180):
        ts = None if i % 31 == 9 else START + timedelta(milliseconds=700 * (i // 3))
        value = None if i % 7 == 3 else float("nan") if i % 23 == 5 else float(i * 37 % 50)
        seq = None if i in (4, 100) else f"{chr(97 + i * 5 % 7)}-{i * 11 % 180:03d}"
        rows.append((i * 7 % 3, ts, seq, "abc"[i * i // 5 % 3], value, None if i % 11 == 2 else Decimal(i * 31 % 97) / 8, [i]))
    batch = spark.createDataFrame(rows, KINDS)
    for k in range(6):
        part = rows[k * 30 : (k + 1) * 30]
        spark.createDataFrame(sorted(part, key=lambda r: r[6][0] * 11 % 30), KINDS).coalesce(1).write.parquet(f"{folder}/f{k}")
        for name in os.listdir(f"{folder}/f{k}"):
            os.utime(f"{folder}/f{k}/{name}", (1_700_000_000 + k * 60,) * 2)
    return batch, lambda: read_folder(spark, f"{folder}/*", batch.schema, files_per_trigger=1)


def ended(odd, *kinds, values=("value",)):
    """Batch series, streaming series, and what ends the streams."""
    batch, read = odd
    closing = Closing()
    some = [Series(batch.where(F.col("kind") == k) if k else batch, values=values, by="user") for k in kinds]
    live = [read().where(F.col("kind") == k) if k else read() for k in kinds]
    return some, [Series(closing.add(df, "ts"), values=values, by="user") for df in live], closing


def same(got, want, closing, folder, *leave_out):
    rows = drain(got, str(folder), closing)
    rows = rows.withColumns({n: F.col(n).cast("timestamp_ntz") for n, k in rows.dtypes if k == "timestamp"})
    assert dict(rows.dtypes) == {n: k for n, k in want.dtypes if n not in leave_out} | {n: k for n, k in rows.dtypes if n in leave_out}
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, want.select(*rows.columns).collect()))
    assert want.count() > 5


@pytest.mark.parametrize(
    "live, batch",
    [
        (lambda s: ordered.count_sliding(s, 5), lambda s: w.count_sliding(s, 5)),
        (lambda s: ordered.moving_average(s, 4), lambda s: w.moving_average(s, 4)),
        (lambda s: ordered.window_extrema(s, 3, largest=False), lambda s: w.window_extrema(s, 3, largest=False)),
        (ordered.record_extrema, w.record_extrema),
    ],
)
def test_odd_values_in_windows(odd, tmp_path, live, batch):
    (s,), (stream,), closing = ended(odd, None)
    same(live(stream), batch(s), closing, tmp_path)


@pytest.mark.parametrize(
    "live, batch",
    [
        (ordered.fuzzy_merge_join, q.fuzzy_merge_join),
        (ordered.fuzzy_merge_drops, q.fuzzy_merge_drops),
        (lambda d, n: ordered.bufferless_join(d, n, newest=True), q.bufferless_newest_join),
        (lambda d, n: ordered.bufferless_join(d, n, newest=False), q.bufferless_oldest_join),
        (ordered.alternating_delta_join, alternating_delta_join),
        (ordered.minimal_delta_join, minimal_delta_join),
    ],
)
def test_odd_values_in_joins(odd, tmp_path, live, batch):
    some, streams, closing = ended(odd, "a", "b", values=("exact", "list"))
    same(live(*streams), batch(*some), closing, tmp_path)


def test_odd_values_in_three_streams(odd, tmp_path):
    some, streams, closing = ended(odd, "a", "b", "c", values=("exact",))
    some, streams = ([Series(s.df, values=s.values) for s in each] for each in (some, streams))
    same(ordered.three_way_delta_join(*streams, single_key=True), three_way_delta_join(*some), closing, tmp_path)


def test_chained_clocks(odd, tmp_path):
    some, streams, closing = ended(odd, "a", "b", values=("exact",))
    one, two = (logical_clock(s, step) for s, step in zip(some, (1.0, 0.5)))
    live = [ordered.logical_clock(s, step) for s, step in zip(streams, (1.0, 0.5))]
    chosen = [(0, ">", 2), (1, ">=", 3)]
    want = minimal_delta_join(relational.select(one, chosen), two)
    same(ordered.minimal_delta_join_on_clocks(relational.select(live[0], chosen), live[1]), want, closing, tmp_path)


def test_a_flush_that_is_run_again_leaves_the_same_rows(odd, tmp_path):
    (s,), (stream,), closing = ended(odd, None)
    live, folder = ordered.running_min_max(stream), str(tmp_path)
    flush(live, folder).awaitTermination()
    closing.close()
    flush(live, folder).awaitTermination()
    want = sorted(map(repr, w.running_min_max(s).collect()))
    got = flushed(live, folder)
    assert sorted(map(repr, got.drop("flush").collect())) == want
    assert got.select("flush").distinct().count() > 3
    # the last micro-batch was written, but not noted as done
    last = max(int(n) for n in os.listdir(f"{folder}/progress/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{folder}/progress/commits/{name}"):
            os.unlink(f"{folder}/progress/commits/{name}")
    flush(live, folder).awaitTermination()
    assert os.path.exists(f"{folder}/progress/commits/{last}")
    assert sorted(map(repr, flushed(live, folder).drop("flush").collect())) == want


def test_filled_windows_and_progress_of_all_batches(odd, tmp_path):
    batch, read = odd
    s = Series(batch.where("NOT isnan(value)").drop("seq").withColumn("seq", F.col("list")[0]), by="user")
    live = Series(read().where("NOT isnan(value)").withColumn("seq", F.col("list")[0]), by="user")
    got, progress = drain_watched(ordered.tumbling_filled(live, 0.5), str(tmp_path))
    want = w.tumbling_filled(s, 0.5)
    assert sorted(map(repr, got.select(*[F.col(c).cast("timestamp_ntz") if k == "timestamp" else c for c, k in got.dtypes]).collect())) == sorted(map(repr, want.collect()))
    assert sum(p["input_rows"] for p in progress) == 180 and all(p["late_rows"] == 0 for p in progress)
    assert want.where("count = 0").count() > 0


def test_a_stream_without_a_key_has_to_be_asked_for(odd):
    _, (stream,), _ = ended(odd, None)
    with pytest.raises(ValueError, match="single_key"):
        ordered.landmark(Series(stream.df, values=("exact",)))


class Parts(dict):
    """A map state in memory."""

    def getValue(self, key):
        return dict.get(self, key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


@pytest.mark.parametrize("taking", [0.3, 0.5, 0.7])
def test_lines_are_queues(monkeypatch, taking):
    monkeypatch.setattr(lines, "SIZE", 8)
    rng, parts, ends, held = random.Random(4), Parts(), {}, []
    for step in range(6000):
        if step % 10 == 0:  # as between two micro-batches
            ends = json.loads(json.dumps(ends))
            line = lines.Line(lines.Store(parts), "x", ends)
        if held and rng.random() < taking:
            i = rng.randrange(len(held))
            assert line[i] == held[i] and line.newest() == held[-1]
            assert line.take() == held.pop(0) if rng.random() < 0.6 else line.pop() == held.pop()
        else:
            line.push([step, "r"])
            held.append([step, "r"])
        assert len(line) == len(held) and len(ends["tail"]) <= 2 * 8 + 32
    assert list(line) == held and len(parts) <= len(held) // 8 + 2
    line.clear()
    assert len(line) == 0 and not parts


def test_state_work_is_that_of_the_rows_touched():
    """A long line: pushing and taking a row reads and writes at most an entry."""
    parts, ends = Parts(), {}
    line = lines.Line(lines.Store(parts), "x", ends)
    for i in range(100_000):
        line.push([i])
    touched = []

    class Watched(Parts):
        def getValue(self, key):
            touched.append(key)
            return parts.getValue(key)

        def updateValue(self, key, value):
            touched.append(key)

    line = lines.Line(lines.Store(Watched()), "x", json.loads(json.dumps(ends)))
    for i in range(200):
        assert line.take() == [i]
        line.push([0])
    assert len(touched) <= 3 and len(json.dumps(ends)) < 10_000
