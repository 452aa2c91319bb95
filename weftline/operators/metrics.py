"""Summaries of metric samples and of operator runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weftline.series import Series, mean

# Fixed value: estimated bytes of one buffered row.
ROW_BYTES = 64


def run_summary(samples: DataFrame, operator: str, ts: str, gauges: list[str]) -> DataFrame:
    """Peak, average and final value of every gauge, per operator."""
    aggs = []
    for g in gauges:
        aggs += [
            F.max(g).alias(f"peak_{g}"),
            mean(F.sum(g), F.count(g)).alias(f"avg_{g}"),
            F.max_by(g, ts).alias(f"final_{g}"),
        ]
    return samples.groupBy(operator).agg(*aggs)


def peak_occupancy(samples: DataFrame, operator: str, occupancy: str) -> DataFrame:
    """Highest count per buffer name, as ``name=count; name=count`` sorted by name."""
    exploded = samples.select(operator, F.explode(occupancy).alias("_name", "_count"))
    peaks = exploded.groupBy(operator, "_name").agg(F.max("_count").alias("_peak"))
    # one entry per buffer name, and an operator has a handful of buffers
    names = F.sort_array(F.collect_list(F.struct("_name", "_peak")))
    parts = F.transform(names, lambda e: F.concat_ws("=", e["_name"], e["_peak"]))
    return peaks.groupBy(operator).agg(F.array_join(parts, "; ").alias("peak_occupancy"))


def throughput(rows: Column, seconds: Column) -> Column:
    """Rows per second, 0 for no duration."""
    return F.when(seconds > 0, rows / seconds).otherwise(F.lit(0.0))


def state_bytes(rows: Column) -> Column:
    """Estimated size of that many buffered rows."""
    return rows * ROW_BYTES


def untimed(s: Series) -> DataFrame:
    """How many rows without a time the windows and joins leave out, per key."""
    return s.df.groupBy(*s.by).agg(F.count(F.when(F.col(s.ts).isNull(), 1)).alias("untimed"))


def observed(df: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """``df`` with a counter that is ready once an action has run: ``observation.get["rows"]``."""
    counter = Observation(name)
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter
