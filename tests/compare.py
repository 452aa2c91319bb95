"""Run registered queries against their SQL in DuckDB. ``python -m tests.compare [sf] [names]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb


def connect(sf_dir):
    con = duckdb.connect(config={"temp_directory": "", "memory_limit": "8GB"})
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, sf_dir, run, sql):
    """None if both sides agree, else a short description."""
    df = run(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    con.execute(sql)
    names = [d[0] for d in con.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(names, con.fetchall())
    if got == want:
        return None
    off = [(g, w) for g, w in zip(got, want) if g != w][:2]
    return f"{len(got)} rows, expected {len(want)}; first differences {off}"


def main():
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = oracle_sql()
    for name, run in queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        started = time.time()
        try:
            result = difference(spark, con, sf_dir, run, sql[name]) if name in sql else "no SQL"
        except Exception as e:
            result = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name:34s} {time.time() - started:6.1f}s {result or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
