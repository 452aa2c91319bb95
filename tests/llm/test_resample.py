"""Importance resampling against plain loops and a plain sort."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftline.llm import resample
from weftline.llm.common import table


def test_weights_match_plain_models(spark):
    texts = [(1, "a b a", "k"), (2, "b c", "k"), (3, None, "k"), (4, "", "k"), (5, "a b a", "k"), (5, "a b a", "k"), (None, "c c", "k")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, kept string")
    targets = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (99, 1)], "doc_id long, quality int")
    buckets, orders = 64, (1, 2)
    grams = {t: Counter(resample.features(pa.array([t], pa.string()), buckets, orders)[0].tolist()) for _, t, _ in texts}
    assert sum(grams["a b a"].values()) == 5
    raw, target = np.ones(buckets), np.ones(buckets)
    for i, t, _ in texts:
        for g, n in grams[t].items():
            raw[g] += n
            target[g] += n * (i in (1, 2))
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    got = resample.resample(docs, targets, buckets=buckets, fraction=0.5).collect()
    want = {t: sum(ratio[g] * n for g, n in grams[t].items()) for t in grams}
    assert len(got) == len(texts)
    text_of = {i: t for i, t, _ in texts}
    for r in got:
        assert r.log_weight == pytest.approx(want[text_of[r.doc_id]], abs=1e-9)
    order = sorted((r.noisy for r in got), reverse=True)
    assert sorted(r.noisy for r in got if r.kept) == sorted(x for x in order if x >= order[math.ceil(0.5 * len(got)) - 1])


def test_no_targets_and_empty(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert [r.log_weight for r in resample.resample(docs, none).collect()] == [0.0]
    assert resample.resample(docs.limit(0), none).collect() == []


def test_kth_highest_of_any_longs(spark):
    rng = np.random.default_rng(5)
    values = [*rng.integers(-(2**63), 2**63 - 1, 300).tolist(), 0, 0, -1, -1, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(v,) for v in values], "_bits long")
    for k in (1, 2, 150, 151, 152, len(values)):
        assert resample.kth_highest(df, k) == sorted(values, reverse=True)[k - 1]
    assert resample.kth_highest(df, len(values) + 1) is None


def test_doubles_keep_their_order(spark):
    values = [-1e300, -1.5, -1.0, -1e-300, -0.0, 0.0, 1e-300, 1.0, 1e300]
    rows = resample._places(spark, spark.createDataFrame([(v,) for v in values], "_key double")).collect()
    bits = [r._bits for r in sorted(rows, key=lambda r: values.index(r._key))]
    assert sorted(bits) == bits and len(set(bits)) == len(values) - 1


def test_query_keeps_good_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = resample.op5_importance_resampling(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left").collect()
    docs = table(spark, sf, "documents").count()
    assert len(rows) == docs and sum(r.kept for r in rows) == math.ceil(0.8 * docs)
    order = sorted((r.noisy for r in rows), reverse=True)
    assert min(r.noisy for r in rows if r.kept) == order[math.ceil(0.8 * docs) - 1]
    share = lambda q, t: np.mean([r.kept for r in rows if (r.quality, r.toxic) == (q, t)])
    assert share(1, 0) > 0.95 and share(0, 0) < 0.2
    again = resample.op5_importance_resampling(spark, sf).where(F.col("kept")).select("doc_id").collect()
    assert {r.doc_id for r in again} == {r.doc_id for r in rows if r.kept}
