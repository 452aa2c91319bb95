"""Helpers of the corpus operators: the shared folder, written tables, Arrow batches of bounded size."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from weftline.folders import shared_root

#: What a word is: a run of anything but blank and the five control characters from tab on.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one numpy step handles; a longer text is a step of its own.
STEP_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: later steps, and retries, read the same rows."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def steps(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about STEP_BYTES of text each, at least one row, so that scratch arrays stay small."""
    texts = batch.column(column)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, int(offsets[at]) + STEP_BYTES, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield batch.slice(at, to - at)
        at = to


def arrow_map(
    df: DataFrame, function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """mapInArrow without a barrier; the function gets the task's batches and yields batches."""
    return df.mapInArrow(function, schema)
