"""Random cases as keyed series: every case is one key, so one job checks them all."""

from __future__ import annotations

from collections import defaultdict

from weftline.series import Series


def as_series(spark, cases, side) -> Series:
    rows = [(c, ts, seq, float(seq)) for c, sides in cases.items() for ts, seq in sides[side]]
    df = spark.createDataFrame(rows, "case int, ts bigint, seq bigint, value double")
    return Series(df, by="case")


def by_case(df, *columns):
    found = defaultdict(list)
    for row in df.collect():
        found[row["case"]].append(tuple(row[c] for c in columns))
    return {k: sorted(v, key=repr) for k, v in found.items()}


def expected(cases, rows_of):
    out = {c: sorted(rows_of(sides), key=repr) for c, sides in cases.items()}
    return {c: rows for c, rows in out.items() if rows}
