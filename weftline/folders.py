"""The folder that driver and executors share: intermediate rows, stream results and stream progress go below it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; else a temporary folder on a local master, or the warehouse on a cluster's store."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return tempfile.gettempdir()
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") or "://" not in warehouse:
        raise ValueError(f"set {CHECKPOINT_CONF}: executors do not share {warehouse}")
    return warehouse.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_root(spark)}/weftline-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once and read from there: its plan runs once, and retries read the same rows."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
