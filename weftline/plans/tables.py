"""The test tables as series. Values are exact decimals, so sums do not depend on their order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.series import Series
from weftline.sources.series import named_series


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, kind: str, *by: str) -> Series:
    """One event type as a series."""
    value = F.col("value").cast("decimal(18,2)")
    return named_series(
        table(spark, sf_dir, "events"), kind, "event_type", "ts", "event_id", {"value": value}, by
    )


def all_events(spark: SparkSession, sf_dir: str, *by: str) -> Series:
    df = table(spark, sf_dir, "events").select(
        *by, "ts", F.col("event_id").alias("seq"), F.col("value").cast("decimal(18,2)").alias("value")
    )
    return Series(df, by=by)


def orders(spark: SparkSession, sf_dir: str, *by: str) -> Series:
    """Orders by date: many rows share a time."""
    df = table(spark, sf_dir, "orders").select(
        *by,
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("value"),
    )
    return Series(df, by=by)


def order_status(spark: SparkSession, sf_dir: str, status: str) -> Series:
    """Orders of one status, one stream per priority: few, long streams with many ties."""
    s = orders(spark, sf_dir, "o_orderpriority", "o_orderstatus")
    return Series(s.df.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), by="o_orderpriority")


def shipments(spark: SparkSession, sf_dir: str, *by: str, value: str = "l_extendedprice") -> Series:
    """Line items by ship date, the largest series."""
    df = table(spark, sf_dir, "lineitem").select(
        *by,
        F.col("l_shipdate").alias("ts"),
        # order, line and part: no two rows of a supplier share all three; text of fixed width sorts as the numbers do
        F.concat(*[F.lpad(F.col(c).cast("string"), 19, "0") for c in ("l_orderkey", "l_linenumber", "l_partkey")]).alias("seq"),
        F.col(value).cast("decimal(18,2)").alias("value"),
    )
    return Series(df, by=by)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the way results are reported."""
    return df.select(
        *[F.col(n).cast("double").alias(n) if k.startswith("decimal") else F.col(n) for n, k in df.dtypes]
    )
