"""Where results go: collecting, numbered flushes, and CSV reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.metrics import observed
from weftline.operators.windows import ranked
from weftline.series import Series


def append_results(df: DataFrame, path: str) -> int:
    """Append to a parquet folder; returns the number of rows written."""
    counted, total = observed(df, "sink")
    counted.write.mode("append").parquet(path)
    return total.get["rows"]


def running_total(s: Series, rows_per_slice: int | None = None) -> DataFrame:
    """Every result with the number of results so far."""
    return ranked(s, "total", rows_per_slice)


def flush_by_time(s: Series, seconds: float) -> DataFrame:
    """Every result with the time window at whose end it is flushed.

    A flush stays a set of rows: one window may hold any share of the results.
    """
    window = F.window(s.ts, f"{round(seconds * 1_000_000)} microseconds")
    return s.rows().withColumn("_w", window).select(*s.columns, F.col("_w.end").alias("flush"))


def flush_by_count(s: Series, size: int = 51, rows_per_slice: int | None = None) -> DataFrame:
    """Every result with the number of its flush, ``size`` results each, from 0 on."""
    counted = ranked(s, "_rank", rows_per_slice)
    return counted.select(*s.columns, F.expr(f"(_rank - 1) div {size}").alias("flush"))


def two_decimals(df: DataFrame) -> DataFrame:
    """Report form: doubles and decimals as text with two decimals."""
    return df.select(
        *[
            F.format_string("%.2f", F.col(name).cast("double")).alias(name)
            if kind == "double" or kind.startswith("decimal")
            else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def write_report(df: DataFrame, path: str) -> None:
    """CSV with a header and two-decimal numbers."""
    two_decimals(df).write.mode("overwrite").option("header", True).csv(path)
