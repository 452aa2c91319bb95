"""Daily price files: CSV with a date and one value column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two spellings of the date header.
DATE_HEADERS = ("observation_date", "observation date")

_DIGITS = r"\d(?:_?\d)*"
_NUMBER = (
    rf"^[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf(?:inity)?|nan))$"
)


def _number(text: Column) -> Column:
    """Double value of a decimal literal, null for anything else."""
    plain = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(plain.rlike(_NUMBER), F.regexp_replace(plain, "_", "").try_cast("double"))


def parse_prices(df: DataFrame, value: str, *keep: str) -> DataFrame:
    """``(keep..., ts, price)`` of all rows with a valid date and a numeric value."""
    dates = [F.when(F.col(f"`{h}`") != "", F.col(f"`{h}`")) for h in DATE_HEADERS if h in df.columns]
    day = F.coalesce(*dates) if len(dates) > 1 else dates[0]
    ts = F.when(day.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_timestamp(day, F.lit("yyyy-M-d")))
    parsed = df.select(*keep, ts.alias("ts"), _number(F.col(f"`{value}`")).alias("price"))
    return parsed.where(F.col("ts").isNotNull() & F.col("price").isNotNull())


def _named(reader, columns: list[str]):
    """All columns of a file as text; a file whose header names other columns in that order is an error."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return reader.schema(schema).option("header", True).option("enforceSchema", False)


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the files, read from their first line."""
    return spark.read.option("header", True).csv(path).columns


def read_prices(spark: SparkSession, path: str, value: str) -> DataFrame:
    """``(ts, price)`` from CSV files of one header, by name."""
    return parse_prices(_named(spark.read, header(spark, path)).csv(path), value)


def stream_prices(spark: SparkSession, path: str, value: str, columns: list[str] | None = None) -> DataFrame:
    """``(ts, price)`` from CSV files as they arrive in a folder, by name.

    ``columns`` is their header, in order; without it, it is read from the files that are there.
    """
    return parse_prices(_named(spark.readStream, columns or header(spark, path)).csv(path), value)
