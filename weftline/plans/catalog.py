"""Every operator as a query over the test tables, with the SQL it has to agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.folders import settled
from weftline.functions import scalars
from weftline.operators import metrics, relational, windows
from weftline.operators import queue_joins as queues
from weftline.operators.delta_joins import minimal_delta_join
from weftline.operators.turn_joins import alternating_delta_join, three_way_delta_join
from weftline.plans import oracles
from weftline.plans.tables import all_events, events, order_status, orders, plain, shipments, table
from weftline.series import Series
from weftline.sources import sinks
from weftline.sources.prices import parse_prices, read_prices
from weftline.sources.series import logical_clock
from weftline.streaming import ordered
from weftline.streaming.folders import Closing, drain, drain_watched, flush, flushed, read_folder, shared_folder, use_rocksdb

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(run(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return run

    return register


_VALUE = "CAST(value AS DECIMAL(18,2))"
_DOUBLE = f"CAST({_VALUE} AS DOUBLE)"


def _mean(total: str, count: str) -> str:
    return f"CAST({total} AS DOUBLE) / {count}"


# --- sources and sinks -------------------------------------------------------------

_RAW_PRICES = """SELECT event_id AS seq,
  CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 19 = 0 THEN 'x' ELSE strftime(ts, '%Y-%m-%d') END AS a,
  CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d') END AS b,
  CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 7 = 0 THEN 'null' WHEN event_id % 11 = 0 THEN 'abc'
    ELSE '  ' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ' ' END AS price FROM events"""


@query(
    "s1_price_rows",
    f"""SELECT seq, CAST(try_strptime(coalesce(nullif(a, ''), b), '%Y-%m-%d') AS TIMESTAMP) AS ts,
  TRY_CAST(trim(price) AS DOUBLE) AS price FROM ({_RAW_PRICES})
WHERE try_strptime(coalesce(nullif(a, ''), b), '%Y-%m-%d') IS NOT NULL AND TRY_CAST(trim(price) AS DOUBLE) IS NOT NULL""",
)
def s1_price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of a price file made from the events, parsed."""
    raw = _raw_prices(spark, sf_dir)
    return parse_prices(raw, "close", "seq").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as the text of a price file with the usual defects."""
    seq, day = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf_dir, "events").select(
        seq.alias("seq"),
        F.when(seq % 3 == 0, "").when(seq % 19 == 0, "x").otherwise(day).alias("observation_date"),
        F.when(seq % 3 == 0, day).alias("observation date"),
        F.when(seq % 5 == 0, "")
        .when(seq % 7 == 0, "null")
        .when(seq % 11 == 0, "abc")
        .otherwise(F.concat(F.lit("  "), F.col("value").cast("decimal(18,2)").cast("string"), F.lit(" ")))
        .alias("close"),
    )


@query(
    "s1_price_file",
    f"""SELECT strptime(day, '%Y-%m-%d') AS ts, TRY_CAST(trim(price) AS DOUBLE) AS price
FROM (SELECT *, coalesce(nullif(a, ''), b) AS day FROM ({_RAW_PRICES}))
WHERE try_strptime(day, '%Y-%m-%d') IS NOT NULL AND TRY_CAST(trim(price) AS DOUBLE) IS NOT NULL""",
)
def s1_price_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same text, written as CSV files and read by name."""
    path = shared_folder(spark)
    _raw_prices(spark, sf_dir).drop("seq").write.option("header", True).csv(path)
    return read_prices(spark, path, "close").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("s2_named_series", f"SELECT ts, event_id AS seq, {_DOUBLE} AS value FROM events WHERE event_type = 'view'")
def s2_named_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir, "view").rows()


def _clock_sql(key: str | None) -> str:
    over = f"PARTITION BY {key} ORDER BY ts, event_id" if key else "ORDER BY ts, event_id"
    keyed = f"{key}, " if key else ""
    return (
        f"SELECT {keyed}(row_number() OVER ({over}) - 1) * CAST(0.5 AS DOUBLE) AS ts, event_id AS seq, "
        f"{_DOUBLE} AS value FROM events"
    )


@query("s3_logical_clock", _clock_sql("user_id"))
def s3_logical_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logical_clock(all_events(spark, sf_dir, "user_id"), 0.5).rows()


@query("s3_logical_clock_unkeyed", _clock_sql(None))
def s3_logical_clock_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logical_clock(all_events(spark, sf_dir), 0.5).rows()


@query(
    "s4_keep_latest",
    f"""SELECT user_id, ts, event_id AS seq, {_DOUBLE} AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 8""",
)
def s4_keep_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.keep_latest(all_events(spark, sf_dir, "user_id"), 8)


@query(
    "s4_keep_latest_unkeyed",
    f"SELECT ts, event_id AS seq, {_DOUBLE} AS value FROM events ORDER BY ts DESC, event_id DESC LIMIT 2500",
)
def s4_keep_latest_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.keep_latest(all_events(spark, sf_dir), 2500)


@query("s4_shed_count", "SELECT user_id, greatest(count(*) - 60, 0) AS shed FROM events GROUP BY user_id")
def s4_shed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.shed_count(all_events(spark, sf_dir, "user_id"), 60)


_PURCHASE, _VIEW = oracles.events("purchase"), oracles.events("view")


def _joined(spark: SparkSession, sf_dir: str, *by: str) -> Series:
    """Purchases with views by fuzzy merge, again as a series."""
    pairs = queues.queue_pairs(
        events(spark, sf_dir, "purchase", *by), events(spark, sf_dir, "view", *by), newest=False
    )
    rows = pairs.select(
        *by,
        F.col("_row0.ts").alias("ts"),
        F.col("_row0.seq").alias("seq"),
        F.col("_row0.value").alias("s_value"),
        F.col("_row1.value").alias("t_value"),
    )
    return Series(rows, values=("s_value", "t_value"), by=by)


_JOINED = oracles.fuzzy_merge(_PURCHASE, _VIEW, "user_id", ", s.seq AS seq")


@query(
    "s5_collected_results",
    f"SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) AS total FROM ({_JOINED})",
)
def s5_collected_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.running_total(_joined(spark, sf_dir, "user_id"))


@query("s6_first_results", f"SELECT * FROM ({_JOINED}) ORDER BY ts, seq LIMIT 30")
def s6_first_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.first_rows(_joined(spark, sf_dir, "user_id").rows(), 30, "ts", "seq")


_SUMMARY_SQL = f"""SELECT event_type, CAST(max({_VALUE}) AS DOUBLE) AS peak_value,
  {_mean(f'sum({_VALUE})', 'count(value)')} AS avg_value, CAST(max_by({_VALUE}, ts) AS DOUBLE) AS final_value
FROM events GROUP BY event_type"""


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = all_events(spark, sf_dir, "event_type").rows()
    return metrics.run_summary(samples, "event_type", "ts", ["value"])


@query(
    "s7_report",
    f"""SELECT event_type, printf('%.2f', peak_value) AS peak_value, printf('%.2f', avg_value) AS avg_value,
  printf('%.2f', final_value) AS final_value FROM ({_SUMMARY_SQL})""",
)
def s7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.two_decimals(_summary(spark, sf_dir))


@query("s8_flush_by_time", f"SELECT *, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS flush FROM ({_JOINED})")
def s8_flush_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.flush_by_time(_joined(spark, sf_dir, "user_id"), 6 * 3600)


@query(
    "s8_flush_by_count",
    f"SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, seq) - 1) // 4 AS flush FROM ({_JOINED})",
)
def s8_flush_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.flush_by_count(_joined(spark, sf_dir, "user_id"), 4)


# --- selection, projection, scalars ------------------------------------------------


@query(
    "p1_selection",
    f"""SELECT user_id, ts, event_id AS seq, {_DOUBLE} AS value FROM events
WHERE ts > TIMESTAMP '2024-01-02 00:00:00' AND {_VALUE} >= 20 AND {_VALUE} != 25""",
)
def p1_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = all_events(spark, sf_dir, "user_id")
    start = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    return relational.select(s, [(0, ">", start), (1, ">=", 20), ("value", "!=", 25)]).rows()


@query("p2_projection", f"SELECT ts, {_DOUBLE} AS value, {_DOUBLE} AS value_2 FROM events")
def p2_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.project(all_events(spark, sf_dir), [1, 1])


@query("p3_identity", f"SELECT ts, event_id AS seq, {_DOUBLE} AS value FROM events")
def p3_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.identity(all_events(spark, sf_dir))


def _event_columns(spark: SparkSession, sf_dir: str, **columns) -> DataFrame:
    df = all_events(spark, sf_dir).df.withColumn("value", F.col("value").cast("double"))
    return df.select("seq", *[c.alias(n) for n, c in columns.items()])


@query("p4_watt_hours", f"SELECT event_id AS seq, {_DOUBLE} * 20 / 3600 AS wh FROM events")
def p4_watt_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_columns(spark, sf_dir, wh=scalars.watt_hours(F.col("value"), F.lit(20)))


@query("p5_clamp", f"SELECT event_id AS seq, greatest(10.0::DOUBLE, least(100.0::DOUBLE, {_DOUBLE})) AS value FROM events")
def p5_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_columns(spark, sf_dir, value=scalars.clamp(F.col("value"), 10.0, 100.0))


@query(
    "p6_reading_or_fallback",
    f"SELECT event_id AS seq, coalesce(CASE WHEN event_type <> 'error' THEN {_DOUBLE} END, 50.0::DOUBLE) AS value FROM events",
)
def p6_reading_or_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error event counts as a failed reading."""
    reading = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), scalars.reading_or_fallback(reading, "humidity").alias("value")
    )


@query(
    "p7_relative_time",
    "SELECT event_id AS seq, (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) / 1e6::DOUBLE AS since FROM events",
)
def p7_relative_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = all_events(spark, sf_dir)
    return s.df.select("seq", scalars.relative_time(s).alias("since"))


@query(
    "p7_relative_date",
    """SELECT o_orderkey AS seq, CAST(date_diff('day', (SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
  CAST(o_orderdate AS DATE)) * 86400 AS DOUBLE) AS since FROM orders""",
)
def p7_relative_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time as a date."""
    s = orders(spark, sf_dir)
    s = s.with_df(s.df.withColumn("ts", F.col("ts").cast("date")))
    return s.df.select("seq", scalars.relative_time(s).alias("since"))


@query("p8_time_label", "SELECT event_id AS seq, strftime(ts, '%H:%M:%S') AS label FROM events")
def p8_time_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_columns(spark, sf_dir, label=scalars.time_label(F.col("ts")))


@query(
    "p9_bucket_start",
    """SELECT event_id AS seq, time_bucket(INTERVAL 10 SECOND, ts) AS bucket,
  CAST(date_trunc('second', ts) AS TIMESTAMP) AS second FROM events""",
)
def p9_bucket_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_events(spark, sf_dir).df.select(
        "seq",
        scalars.bucket_start("ts", 10).alias("bucket"),
        scalars.floor_second("ts").cast("timestamp_ntz").alias("second"),
    )


@query(
    "p10_nearest_of_two",
    """SELECT event_id AS seq, CASE WHEN epoch_us(ts) - epoch_us(h) < epoch_us(h) + 3600000000 - epoch_us(ts)
  THEN h ELSE h + INTERVAL 1 HOUR END AS hour
FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS h FROM events)""",
)
def p10_nearest_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearer full hour of every event."""
    s = all_events(spark, sf_dir)
    hours = s.df.withColumn("a", scalars.bucket_start("ts", 3600))
    hours = hours.withColumn("b", F.col("a") + F.expr("INTERVAL 1 HOUR"))
    at = {c: Series(hours, ts=c).ticks() for c in ("ts", "a", "b")}
    near = scalars.nearest_of_two(at["ts"], F.col("a"), F.col("b"), at["a"], at["b"])
    return hours.select("seq", near.alias("hour"))


# --- windows -----------------------------------------------------------------------


def _tumbling_sql(source: str, key: str | None, ts: str, width: str, value: str) -> str:
    keyed = f"{key}, " if key else ""
    return f"""SELECT {keyed}start, start + INTERVAL {width} AS "end", count(*) AS count,
  {_mean('sum(v)', 'count(*)')} AS avg
FROM (SELECT *, time_bucket(INTERVAL {width}, {ts}) AS start, CAST({value} AS DECIMAL(18,2)) AS v FROM {source})
WHERE start + INTERVAL {width} <= (SELECT max({ts}) FROM {source})
GROUP BY {keyed}start"""


@query("w1_tumbling", _tumbling_sql("events", "event_type", "ts", "1 HOUR", "value"))
def w1_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling(all_events(spark, sf_dir, "event_type"), 3600)


_VIEWS = "(SELECT * FROM events WHERE event_type = 'view')"


@query("w1_tumbling_unkeyed", _tumbling_sql(_VIEWS, None, "ts", "10 SECOND", "value"))
def w1_tumbling_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling(events(spark, sf_dir, "view"), 10)


@query("w1_tumbling_shipments", _tumbling_sql("lineitem", "l_suppkey", "l_shipdate", "1 DAY", "l_extendedprice"))
def w1_tumbling_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling(shipments(spark, sf_dir, "l_suppkey"), 86_400)


_FILLED = _tumbling_sql("events", "event_type", "ts", "10 MINUTE", "value")


@query(
    "w2_tumbling_filled",
    f"""WITH w AS ({_FILLED}),
g AS (SELECT event_type, unnest(generate_series(min(start), max(start), INTERVAL 10 MINUTE)) AS start FROM w GROUP BY event_type)
SELECT g.event_type, g.start, g.start + INTERVAL 10 MINUTE AS "end", coalesce(w.count, 0) AS count, coalesce(w.avg, 0) AS avg
FROM g LEFT JOIN w ON w.event_type = g.event_type AND w.start = g.start""",
)
def w2_tumbling_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tumbling_filled(all_events(spark, sf_dir, "event_type"), 600)


@query(
    "w2_tumbling_filled_clock",
    """WITH c AS (
  SELECT event_type, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) * 0.35::DOUBLE AS t,
    event_id, CAST(value AS DECIMAL(18,2)) AS v FROM events),
r AS (SELECT event_type, CAST(floor(t / 0.1::DOUBLE) AS BIGINT) AS k, t, v FROM c),
w AS (
  SELECT event_type, k, count(*) AS n, CAST(sum(v) AS DOUBLE) / count(*) AS a FROM r
  WHERE k * 0.1::DOUBLE + 0.1::DOUBLE <= (SELECT max(t) FROM r) GROUP BY event_type, k),
g AS (SELECT event_type, unnest(generate_series(min(k), max(k))) AS k FROM w GROUP BY event_type)
SELECT g.event_type, g.k * 0.1::DOUBLE AS start, g.k * 0.1::DOUBLE + 0.1::DOUBLE AS "end", coalesce(n, 0) AS count,
  coalesce(a, 0) AS avg FROM g LEFT JOIN w ON w.event_type = g.event_type AND w.k = g.k""",
)
def w2_tumbling_filled_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logical clock with a step and a window that are no binary fractions, and gaps."""
    return windows.tumbling_filled(logical_clock(all_events(spark, sf_dir, "event_type"), 0.35), 0.1)


def _over(key: str | None, order: str) -> str:
    return f"PARTITION BY {key} ORDER BY {order}" if key else f"ORDER BY {order}"


def _sliding_sql(source: str, key: str | None, order: str, ts: str, value: str, n: int) -> str:
    keyed = f"{key}, " if key else ""
    v = f"CAST({value} AS DECIMAL(18,2))"
    return f"""SELECT {keyed}first({ts}) OVER w AS oldest_ts, {ts} AS newest_ts, count(*) OVER w AS count,
  {_mean(f'sum({v}) OVER w', 'count(*) OVER w')} AS avg, CAST(min({v}) OVER w AS DOUBLE) AS min,
  CAST(max({v}) OVER w AS DOUBLE) AS max
FROM {source} WINDOW w AS ({_over(key, order)} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"""


@query("w3_count_sliding", _sliding_sql("events", "user_id", "ts, event_id", "ts", "value", 10))
def w3_count_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_sliding(all_events(spark, sf_dir, "user_id"), 10)


@query("w3_count_sliding_unkeyed", _sliding_sql("events", None, "ts, event_id", "ts", "value", 30))
def w3_count_sliding_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_sliding(all_events(spark, sf_dir), 30)


_GAPPY = "(SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN value END AS value) FROM events)"


@query(
    "w3_count_sliding_nulls",
    _sliding_sql(_GAPPY, "user_id", "ts, event_id", "ts", "value", 4).replace(
        "AS DOUBLE) / count(*) OVER w", "AS DOUBLE) / nullif(count(value) OVER w, 0)"
    ),
)
def w3_count_sliding_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error event has no value; averages are over the values there are."""
    s = all_events(spark, sf_dir, "user_id", "event_type")
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return windows.count_sliding(Series(s.df.withColumn("value", value), by="user_id"), 4)


_SHIPPED = "l_shipdate, l_orderkey, l_linenumber, l_partkey"


@query(
    "w3_count_sliding_shipments",
    _sliding_sql("lineitem", "l_suppkey", _SHIPPED, "l_shipdate", "l_extendedprice", 10),
)
def w3_count_sliding_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.count_sliding(shipments(spark, sf_dir, "l_suppkey"), 10)


def _landmark_sql(key: str | None) -> str:
    keyed = f"{key}, " if key else ""
    part = f"PARTITION BY {key}" if key else ""
    return f"""SELECT {keyed}landmark, ts, count(*) OVER w AS count, CAST(sum(v) OVER w AS DOUBLE) AS sum,
  {_mean('sum(v) OVER w', 'count(*) OVER w')} AS avg
FROM (SELECT *, {_VALUE} AS v, first(ts) OVER ({part} ORDER BY event_id) AS landmark FROM events)
WHERE ts >= landmark
WINDOW w AS ({_over(key, 'ts, event_id')} ROWS UNBOUNDED PRECEDING)"""


@query("w4_landmark", _landmark_sql("user_id"))
def w4_landmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.landmark(all_events(spark, sf_dir, "user_id"))


@query("w4_landmark_unkeyed", _landmark_sql(None))
def w4_landmark_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.landmark(all_events(spark, sf_dir))


@query(
    "w5_landmark_points",
    f"""SELECT user_id, CAST(date_trunc('second', landmark) AS TIMESTAMP) AS landmark, ts, count, avg
FROM ({_landmark_sql('user_id')}) WHERE count <= 50""",
)
def w5_landmark_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.landmark_points(all_events(spark, sf_dir, "user_id"), 50)


def _average_sql(key: str | None) -> str:
    keyed = f"{key}, " if key else ""
    return f"""SELECT {keyed}ts, event_id AS seq, {_DOUBLE} AS value,
  CASE WHEN count(*) OVER w < 20 THEN 'NaN'::DOUBLE ELSE {_mean(f'sum({_VALUE}) OVER w', '20')} END AS moving_avg
FROM events WINDOW w AS ({_over(key, 'ts, event_id')} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""


@query("w6_moving_average", _average_sql("user_id"))
def w6_moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.moving_average(all_events(spark, sf_dir, "user_id"), 20)


@query("w6_moving_average_unkeyed", _average_sql(None))
def w6_moving_average_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.moving_average(all_events(spark, sf_dir), 20)


@query(
    "w7_running_min_max",
    f"""SELECT user_id, CAST(min({_VALUE}) OVER w AS DOUBLE) AS min, CAST(max({_VALUE}) OVER w AS DOUBLE) AS max
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def w7_running_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.running_min_max(all_events(spark, sf_dir, "user_id"))


@query(
    "w7_running_min_max_unkeyed",
    f"""SELECT CAST(min({_VALUE}) OVER w AS DOUBLE) AS min, CAST(max({_VALUE}) OVER w AS DOUBLE) AS max
FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def w7_running_min_max_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.running_min_max(all_events(spark, sf_dir))


def _records_sql(aggregate: str, op: str, key: str | None = "user_id") -> str:
    keyed, part = (f"{key}, ", f"PARTITION BY {key} ") if key else ("", "")
    return f"""SELECT {keyed}ts, event_id AS seq, {_DOUBLE} AS value FROM (
  SELECT *, {aggregate}({_VALUE}) OVER ({part}ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM events)
WHERE best IS NULL OR {_VALUE} {op} best"""


@query("w8_record_highs", _records_sql("max", ">"))
def w8_record_highs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.record_extrema(all_events(spark, sf_dir, "user_id"), largest=True)


@query("w8_record_lows", _records_sql("min", "<"))
def w8_record_lows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.record_extrema(all_events(spark, sf_dir, "user_id"), largest=False)


@query("w8_record_highs_unkeyed", _records_sql("max", ">", None))
def w8_record_highs_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.record_extrema(all_events(spark, sf_dir), largest=True)


def _extrema_sql(order: str, key: str | None = "user_id") -> str:
    part = f"PARTITION BY {key} " if key else ""
    keyed, same = (f"a.{key}, ", f"b.{key} = a.{key} AND ") if key else ("", "")
    ranked = f"(SELECT *, {_VALUE} AS v, row_number() OVER ({part}ORDER BY ts, event_id) AS r FROM events)"
    return f"""SELECT {keyed}a.ts AS at_ts, b.ts AS ts, CAST(b.v AS DOUBLE) AS value
FROM {ranked} a JOIN {ranked} b ON {same}b.r >= a.r - 7 AND b.r <= a.r AND b.r // 8 >= a.r // 8 - 1 AND b.r // 8 <= a.r // 8
QUALIFY row_number() OVER (PARTITION BY {keyed}a.r ORDER BY b.v {order}, b.ts, b.event_id) = 1"""


@query("w9_window_highs_unkeyed", _extrema_sql("DESC", None))
def w9_window_highs_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_extrema(all_events(spark, sf_dir), 8, largest=True)


@query("w9_window_highs", _extrema_sql("DESC"))
def w9_window_highs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_extrema(all_events(spark, sf_dir, "user_id"), 8, largest=True)


@query("w9_window_lows", _extrema_sql("ASC"))
def w9_window_lows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_extrema(all_events(spark, sf_dir, "user_id"), 8, largest=False)


# --- joins -------------------------------------------------------------------------
# Each join by user (many short streams), without a key (one stream that is sliced), and on
# orders by priority (five long streams with many equal times).


def _join_queries(name: str, join, sql, streams: int = 2) -> None:
    kinds = ["purchase", "view", "click"][:streams]
    statuses = ["O", "F", "P"][:streams]

    def by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
        return join(*[events(spark, sf_dir, k, "user_id") for k in kinds])

    def unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
        return join(*[events(spark, sf_dir, k) for k in kinds])

    def on_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
        return join(*[order_status(spark, sf_dir, s) for s in statuses])

    query(name, sql(*[oracles.events(k) for k in kinds], "user_id"))(by_user)
    query(f"{name}_unkeyed", sql(*[oracles.events(k, "0") for k in kinds], None))(unkeyed)
    query(f"{name}_orders", sql(*[oracles.order_status(s) for s in statuses], "o_orderpriority"))(on_orders)


def _flat_three_way(one: Series, two: Series, three: Series) -> DataFrame:
    joined = three_way_delta_join(one, two, three)
    return joined.select(*one.by, "dominant.ts", "dominant.value", "joined.*")


_join_queries("j1_fuzzy_merge_join", queues.fuzzy_merge_join, oracles.fuzzy_merge)
_join_queries("j2_fuzzy_merge_drops", queues.fuzzy_merge_drops, oracles.fuzzy_merge_drops)
_join_queries("j3_bufferless_newest_join", queues.bufferless_newest_join, oracles.bufferless_newest)
_join_queries("j4_bufferless_drops", queues.bufferless_drops, oracles.bufferless_drops)
_join_queries("j5_bufferless_oldest_join", queues.bufferless_oldest_join, oracles.bufferless_oldest)
_join_queries("j6_alternating_delta_join", alternating_delta_join, oracles.alternating)
_join_queries("j7_minimal_delta_join", minimal_delta_join, oracles.symmetric)
_join_queries("j8_three_way_delta_join", _flat_three_way, oracles.three_way, streams=3)


@query(
    "j9_select_then_join",
    oracles.symmetric(
        oracles.clocked("click", 1.0, "ts > 1 AND v >= 20"), oracles.clocked("signup", 0.5), "user_id"
    ),
)
def j9_select_then_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demonstrator: clocked readings, selected by time and value, joined to a second stream."""
    first = logical_clock(events(spark, sf_dir, "click", "user_id"), 1.0)
    second = logical_clock(events(spark, sf_dir, "signup", "user_id"), 0.5)
    return minimal_delta_join(relational.select(first, [(0, ">", 1), (1, ">=", 20)]), second)


@query(
    "j9_select_then_join_unkeyed",
    oracles.symmetric(
        oracles.clocked("click", 1.0, "ts > 1 AND v >= 20", "0"), oracles.clocked("signup", 0.5, key="0"), None
    ),
)
def j9_select_then_join_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = logical_clock(events(spark, sf_dir, "click"), 1.0)
    second = logical_clock(events(spark, sf_dir, "signup"), 0.5)
    return minimal_delta_join(relational.select(first, [(0, ">", 1), (1, ">=", 20)]), second)


def _gap(sql: str) -> str:
    """An event whose number is divisible by 13 has lost its time."""
    return f"SELECT * FROM ({sql}) WHERE seq % 13 <> 0"


def _gappy(spark: SparkSession, sf_dir: str, kind: str) -> Series:
    s = events(spark, sf_dir, kind, "user_id")
    return s.with_df(s.df.withColumn("ts", F.when(F.col("seq") % 13 != 0, F.col("ts"))))


for _name, _join, _sql in [
    ("j1_fuzzy_merge_untimed", queues.fuzzy_merge_join, oracles.fuzzy_merge),
    ("j7_minimal_delta_untimed", minimal_delta_join, oracles.symmetric),
]:
    query(_name, _sql(_gap(oracles.events("purchase")), _gap(oracles.events("view")), "user_id"))(
        lambda spark, sf_dir, join=_join: join(_gappy(spark, sf_dir, "purchase"), _gappy(spark, sf_dir, "view"))
    )


# --- run metrics -------------------------------------------------------------------


@query("m1_run_summary", _SUMMARY_SQL)
def m1_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summary(spark, sf_dir)


@query(
    "m2_peak_occupancy",
    """WITH c AS (SELECT event_type, date_trunc('day', ts) AS day, 'buffer ' || (user_id % 4) AS name, count(*) AS n
  FROM events GROUP BY ALL),
p AS (SELECT event_type, name, max(n) AS n FROM c GROUP BY ALL)
SELECT event_type, string_agg(name || '=' || n, '; ' ORDER BY name) AS peak_occupancy FROM p GROUP BY event_type""",
)
def m2_peak_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample per type and day: how many events of each of four user groups."""
    name = F.concat(F.lit("buffer "), F.col("user_id") % 4)
    counts = table(spark, sf_dir, "events").groupBy(
        "event_type", F.date_trunc("day", "ts").alias("day"), name.alias("name")
    ).agg(F.count(F.lit(1)).cast("int").alias("n"))
    samples = counts.groupBy("event_type", "day").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "n"))).alias("occupancy")
    )
    return metrics.peak_occupancy(samples, "event_type", "occupancy")


@query(
    "m3_throughput",
    """SELECT event_type, count(*) / ((max(epoch_us(ts)) - min(epoch_us(ts))) / 1e6::DOUBLE) AS per_second
FROM events GROUP BY event_type""",
)
def m3_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = all_events(spark, sf_dir, "event_type")
    spans = s.df.withColumn("_t", s.ticks()).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), ((F.max("_t") - F.min("_t")) / 1e6).alias("seconds")
    )
    return spans.select("event_type", metrics.throughput(F.col("n"), F.col("seconds")).alias("per_second"))


@query("m4_output_count", f"SELECT user_id, count(*) AS rows FROM ({_JOINED}) GROUP BY user_id")
def m4_output_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined, _ = metrics.observed(_joined(spark, sf_dir, "user_id").rows(), "joined")
    return joined.groupBy("user_id").agg(F.count(F.lit(1)).alias("rows"))


@query("m4_observed_count", f"SELECT count(*) AS rows FROM ({_JOINED})")
def m4_observed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the counter saw while the results were written."""
    joined, counter = metrics.observed(_joined(spark, sf_dir, "user_id").rows(), "joined")
    settled(joined)
    return spark.createDataFrame([(counter.get["rows"],)], "rows long")


@query(
    "m5_state_bytes",
    """SELECT user_id, ts, 64 * count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS bytes FROM events""",
)
def m5_state_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = windows.count_sliding(all_events(spark, sf_dir, "user_id"), 30)
    return held.select("user_id", F.col("newest_ts").alias("ts"), metrics.state_bytes(F.col("count")).alias("bytes"))


# --- streams -----------------------------------------------------------------------
# The events file as a stream, run until everything is read; results go to the shared folder.


def _live_events(spark: SparkSession, sf_dir: str, kind: str | None, *by: str) -> Series:
    schema = table(spark, sf_dir, "events").schema
    df = read_folder(spark, sf_dir, schema, pattern="events.parquet")
    df = df.where(F.col("event_type") == kind) if kind else df
    value = F.col("value").cast("decimal(18,2)").alias("value")
    return Series(df.select(*by, "ts", F.col("event_id").alias("seq"), value), by=by)


@query("w1_tumbling_stream", ORACLES["w1_tumbling"])
def w1_tumbling_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = ordered.tumbling(_live_events(spark, sf_dir, None, "event_type"), 3600)
    closed = drain(live, shared_folder(spark))
    return closed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


def _finished(spark: SparkSession, sf_dir: str, closing: Closing, kind: str | None, *by: str) -> Series:
    s = _live_events(spark, sf_dir, kind, *by)
    return s.with_df(closing.add(s.df, "ts"))


def _drained(spark: SparkSession, live: DataFrame, closing: Closing | None) -> DataFrame:
    """All rows of a finished stream, with times as the batch operators have them."""
    rows = drain(live, shared_folder(spark), closing)
    return rows.withColumns({n: F.col(n).cast("timestamp_ntz") for n, k in rows.dtypes if k == "timestamp"})


def _stream(name: str, sql: str, *kinds: str | None, operator, ends: bool = True) -> None:
    """A stream operator over streams of events by user, which end, has to give what the batch operator gives."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_rocksdb(spark)
        closing = Closing() if ends else None
        read = [_finished(spark, sf_dir, closing, k, "user_id") if ends else _live_events(spark, sf_dir, k, "user_id") for k in kinds]
        return _drained(spark, operator(*read), closing)

    query(name, sql)(run)


_TWO = ("purchase", "view")
_stream("j1_fuzzy_merge_stream", ORACLES["j1_fuzzy_merge_join"], *_TWO, operator=ordered.fuzzy_merge_join)
_stream("j2_fuzzy_merge_drops_stream", ORACLES["j2_fuzzy_merge_drops"], *_TWO, operator=ordered.fuzzy_merge_drops)
_stream(
    "j3_bufferless_newest_stream",
    ORACLES["j3_bufferless_newest_join"],
    *_TWO,
    operator=lambda d, n: ordered.bufferless_join(d, n, newest=True),
)
_stream("j4_bufferless_drops_stream", ORACLES["j4_bufferless_drops"], *_TWO, operator=lambda d, n: ordered.queue_drops(n, d))
_stream(
    "j5_bufferless_oldest_stream",
    ORACLES["j5_bufferless_oldest_join"],
    *_TWO,
    operator=lambda d, n: ordered.bufferless_join(d, n, newest=False),
)
_stream("j6_alternating_delta_stream", ORACLES["j6_alternating_delta_join"], *_TWO, operator=ordered.alternating_delta_join)
_stream("j7_minimal_delta_join_stream", ORACLES["j7_minimal_delta_join"], *_TWO, operator=ordered.minimal_delta_join)
_stream(
    "j8_three_way_stream",
    ORACLES["j8_three_way_delta_join"],
    *["purchase", "view", "click"],
    operator=lambda *s: ordered.three_way_delta_join(*s).select("user_id", "dominant.ts", "dominant.value", "joined.*"),
)
_stream("w3_count_sliding_stream", ORACLES["w3_count_sliding"], None, operator=ordered.count_sliding)
_stream("w5_landmark_points_stream", ORACLES["w5_landmark_points"], None, operator=lambda s: ordered.landmark_points(s, 50))
_stream("w6_moving_average_stream", ORACLES["w6_moving_average"], None, operator=ordered.moving_average)
_stream("w7_running_min_max_stream", ORACLES["w7_running_min_max"], None, operator=ordered.running_min_max)
_stream("w8_record_highs_stream", ORACLES["w8_record_highs"], None, operator=lambda s: ordered.record_extrema(s, largest=True))
_stream("w9_window_highs_stream", ORACLES["w9_window_highs"], None, operator=lambda s: ordered.window_extrema(s, 8, largest=True))
_stream(
    "s4_shed_stream",
    f"""SELECT user_id, ts, event_id AS seq, {_DOUBLE} AS value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS shed_so_far
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) > 20""",
    None,
    operator=lambda s: ordered.shed_oldest(s, 20),
)


@query("s3_logical_clock_stream", ORACLES["s3_logical_clock"])
def s3_logical_clock_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_rocksdb(spark)
    closing = Closing()
    stamped = ordered.logical_clock(_finished(spark, sf_dir, closing, None, "user_id"), 0.5)
    return _drained(spark, stamped.rows().withColumnRenamed("clock", "ts"), closing)


@query("s8_flush_stream", ORACLES["j1_fuzzy_merge_join"])
def s8_flush_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joined pairs, handed on flush by flush."""
    use_rocksdb(spark)
    closing = Closing()
    live = ordered.fuzzy_merge_join(*[_finished(spark, sf_dir, closing, k, "user_id") for k in _TWO])
    folder = shared_folder(spark)
    flush(live, folder).awaitTermination()
    closing.close()
    flush(live, folder).awaitTermination()
    return flushed(live, folder).drop("flush").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("j9_select_then_join_stream", ORACLES["j9_select_then_join"])
def j9_select_then_join_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demonstrator live: two clocks, each kept in state, a selection, and the join as a third stateful operator behind them."""
    use_rocksdb(spark)
    closing = Closing()
    first = ordered.logical_clock(_finished(spark, sf_dir, closing, "click", "user_id"), 1.0)
    second = ordered.logical_clock(_finished(spark, sf_dir, closing, "signup", "user_id"), 0.5)
    joined = ordered.minimal_delta_join_on_clocks(relational.select(first, [(0, ">", 1), (1, ">=", 20)]), second)
    return _drained(spark, joined, closing)


@query("w2_tumbling_filled_stream", ORACLES["w2_tumbling_filled"])
def w2_tumbling_filled_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows go out on timers; the last one of a key without any further row."""
    use_rocksdb(spark)
    live = ordered.tumbling_filled(_live_events(spark, sf_dir, None, "event_type"), 600)
    return _drained(spark, live, None)


@query(
    "m5_stream_state",
    """SELECT count(*) + 1 AS input_rows, CAST(0 AS BIGINT) AS late_rows, count(DISTINCT user_id) AS keys,
  true AS state_is_counted FROM events""",
)
def m5_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What Spark reports of a stream's input and state over all micro-batches; the closing row counts as read, and leaves no state."""
    use_rocksdb(spark)
    closing = Closing()
    live = ordered.running_min_max(_finished(spark, sf_dir, closing, None, "user_id"))
    _, progress = drain_watched(live, shared_folder(spark), closing)
    total = (
        sum(p["input_rows"] for p in progress),
        sum(p["late_rows"] for p in progress),
        progress[-1]["state_rows"],
        # RocksDB reports no less than what the keys' memories hold
        max(p["state_bytes"] for p in progress) >= 64 * progress[-1]["state_rows"],
    )
    return spark.createDataFrame([total], "input_rows long, late_rows long, keys long, state_is_counted boolean")


_SHUFFLED = "(SELECT * REPLACE (event_id * 7919 % 1000003 AS event_id) FROM events)"


@query("w4_landmark_stream", _landmark_sql("user_id").replace("FROM events)", f"FROM {_SHUFFLED})"))
def w4_landmark_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival order is not time order: rows before the first arrival are dropped."""
    use_rocksdb(spark)
    closing = Closing()
    s = _live_events(spark, sf_dir, None, "user_id")
    s = s.with_df(closing.add(s.df.withColumn("seq", F.col("seq") * 7919 % 1000003), "ts"))
    return _drained(spark, ordered.landmark(s), closing)
