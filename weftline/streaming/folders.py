"""File streams in and out, below the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.folders import shared_folder

__all__ = ["CLOSING", "Closing", "drain", "drain_watched", "flush", "flushed", "read_folder", "shared_folder", "use_rocksdb"]

#: The column that tells a closing row from the others.
CLOSING = "_closing"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep keyed state of all streams of this session in RocksDB, which the in-order processors need."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def read_folder(spark: SparkSession, path: str, schema, files_per_trigger: int = 100, pattern: str = "*.parquet") -> DataFrame:
    """Parquet files as they arrive; ``files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(path)


class Closing:
    """The end of finished inputs: one more row for each, in the year 2250 (pandas ends in 2262), that lets the watermark pass all
    rows. It only comes when ``close`` is called, after all real rows have been read: a row that came earlier would make
    those of later micro-batches late. ``drain`` does that. Rows at or after 2250 are not waited for.
    """

    def __init__(self):
        self._rows: list[tuple[DataFrame, str]] = []

    def add(self, live: DataFrame, ts: str) -> DataFrame:
        """``live`` with the source of its closing row, empty as yet, and the column that marks it."""
        spark = live.sparkSession
        path = shared_folder(spark)
        end = F.lit("2250-01-01 00:00:00").cast(live.schema[ts].dataType)
        columns = [end.alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in live.schema]
        row = spark.range(1).select(*columns, F.lit(True).alias(CLOSING))
        row.where("false").write.parquet(path)
        self._rows.append((row, path))
        schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in live.schema], T.StructField(CLOSING, T.BooleanType())])
        return live.withColumn(CLOSING, F.lit(False)).unionByName(spark.readStream.schema(schema).parquet(path))

    def close(self) -> None:
        for row, path in self._rows:
            row.write.mode("append").parquet(path)
        self._rows = []


def drain(df: DataFrame, folder: str, closing: Closing | None = None) -> DataFrame:
    """Run a stream over all that is there, append the results to parquet, and read them; then, if there is an end, once more with it."""
    return drain_watched(df, folder, closing)[0]


def drain_watched(df: DataFrame, folder: str, closing: Closing | None = None) -> tuple[DataFrame, list[dict]]:
    """As ``drain``, and per micro-batch what Spark reports of input and state: rows read, rows and bytes of state,
    and rows that came behind the watermark."""
    progress = _run(df, folder)
    if closing is not None:
        closing.close()
        progress += _run(df, folder)
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows"), progress


def _run(df: DataFrame, folder: str) -> list[dict]:
    run = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/rows")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    # Spark keeps the last hundred reports only, so they are fetched while it runs
    seen = {}
    while True:
        ended = run.awaitTermination(1)
        for p in run.recentProgress:
            seen[p.batchId, p.timestamp] = p
        if ended:
            break
    return [
        {
            "batch": p.batchId,
            "input_rows": p.numInputRows,
            "state_rows": sum(o.numRowsTotal for o in p.stateOperators),
            "state_bytes": sum(o.memoryUsedBytes for o in p.stateOperators),
            "late_rows": sum(o.numRowsDroppedByWatermark for o in p.stateOperators),
        }
        for p in seen.values()
    ]


def flush(df: DataFrame, folder: str, seconds: float | None = None):
    """Start a stream that hands on its results every so many seconds, or, without a number, all that is there, and then forgets
    them. Each flush is a folder of its own, named by the number of the micro-batch and written over as a whole: one that is run again
    after a failure leaves the same rows, not twice as many."""

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/rows/flush={number}")

    trigger = {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}
    started = df.writeStream.foreachBatch(write).option("checkpointLocation", f"{folder}/progress").trigger(**trigger)
    return started.start()


def flushed(df: DataFrame, folder: str) -> DataFrame:
    """The rows that ``flush`` has written, with the number of their flush."""
    schema = T.StructType([*df.schema.fields, T.StructField("flush", T.LongType())])
    return df.sparkSession.read.schema(schema).parquet(f"{folder}/rows")
