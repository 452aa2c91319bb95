"""Empty windows of a stream, put between those that Spark has counted."""

from collections import Counter

import pandas as pd

from weftline.series import Series
from weftline.streaming import ordered


class Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Handle:
    def getValueState(self, name, kind):
        return Value()


def test_gaps_between_windows():
    p = ordered.Gaps(10)
    p.init(Handle())
    columns = ["in_key", "in_t", "in_count", "in_avg"]
    first = [pd.DataFrame([("a", 30, 2, "1.5")], columns=columns), pd.DataFrame([("a", 0, 1, "NaN")], columns=columns)]
    got = pd.concat(p.handleInputRows(("a",), iter(first), None))
    assert got.values.tolist() == [["a", 0, 1, "NaN"], ["a", 10, 0, "0.0"], ["a", 20, 0, "0.0"], ["a", 30, 2, "1.5"]]
    later = list(p.handleInputRows(("a",), iter([pd.DataFrame([("a", 100_040, 1, "2.0")], columns=columns)]), None))
    assert max(map(len, later)) <= ordered._BLOCK
    assert pd.concat(later)["in_t"].tolist() == list(range(40, 100_041, 10))


def test_only_windows_go_through_the_operator_that_fills_gaps(spark, tmp_path):
    """rows are counted by Spark's aggregation, below the stateful operator."""
    spark.createDataFrame([], "user int, ts timestamp, seq long, value double").write.parquet(str(tmp_path / "x"))
    live = spark.readStream.schema("user int, ts timestamp, seq long, value double").parquet(str(tmp_path / "x"))
    plan = ordered.tumbling_filled(Series(live, by="user"), 10)._jdf.queryExecution().analyzed().toString()
    kinds = Counter("Aggregate" if "Aggregate" in line else "State" for line in plan.splitlines() if "Aggregate" in line or "TransformWithState" in line)
    assert kinds["Aggregate"] == 1 and plan.index("TransformWithState") < plan.index("Aggregate")
