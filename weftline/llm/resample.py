"""Importance resampling: log ratio of two hashed n-gram models, sampled by Gumbel top-k.

Each text is a bag of its words and word pairs, hashed into `buckets`. The raw model has the bucket shares over all documents;
the target model those over target documents, which are labelled rows, at most `max_targets` of them by lowest hash of
doc_id. Both are smoothed by `smooth` counts a bucket. A text's log weight is the sum over its n-grams of log(target / raw).
To each, Gumbel noise is added that depends on seed and doc_id alone; the k rows with the highest sum are drawn, which samples
without replacement in proportion to the weights. k is `fraction` of all rows, rounded up.

The k-th highest sum is found by counting: sums become 64-bit integers in the same order, and four rounds of counts by 16
bits narrow the range down to one value. Each round brings at most 65,536 counts to the driver, whatever the input.

Rules. Null or wordless text has log weight 0. Without any target row all log weights are 0. Rows that repeat get the same
weight and noise; rows equal to the k-th sum are all drawn, so repeated rows at the border can make the sample a little
larger. A row without doc_id gets noise of its own id, null. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import arrow_map, steps, table, written
from weftline.llm.words import runs, words

_TOP = -(1 << 63)


def features(texts: pa.Array, buckets: int, orders: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the given orders in a step, and the text each belongs to."""
    found = words(texts, lower=True)
    owner, hashes, owners = found.owners, [], []
    for n in orders:
        every = runs(found.hashes, n)
        inside = owner[: len(every)] == owner[n - 1 :]
        hashes.append(every[inside])
        owners.append(owner[: len(every)][inside])
    return (np.concatenate(hashes) % np.uint64(buckets)).astype(np.int64), np.concatenate(owners)


def _bucket_counts(batches, buckets: int, orders: tuple[int, ...]):
    """One row per bucket that a task met: n-grams of all texts and of target texts."""
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for batch in batches:
        for part in steps(batch):
            bucket, owner = features(part.column("text"), buckets, orders)
            raw += np.bincount(bucket, minlength=buckets)
            wanted = np.asarray(part.column("_target"))[owner]
            target += np.bincount(bucket[wanted], minlength=buckets)
    met = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (met, raw[met], target[met])], ["bucket", "raw", "target"])


def log_ratios(
    docs: DataFrame, targets: DataFrame, *, buckets: int, orders: tuple[int, ...], max_targets: int, smooth: float
) -> np.ndarray:
    """log(target share / raw share) of each bucket, from counts over all documents."""
    by_hash = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = targets.select("doc_id").distinct().orderBy(by_hash, "doc_id").limit(max_targets)
    chosen = F.broadcast(chosen.select("doc_id", F.lit(True).alias("_t")))  # at most max_targets ids
    flagged = docs.select("doc_id", "text").join(chosen, "doc_id", "left")
    flagged = flagged.select("text", F.coalesce("_t", F.lit(False)).alias("_target"))
    partial = arrow_map(flagged, lambda it: _bucket_counts(it, buckets, orders), "bucket long, raw long, target long")
    summed = partial.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.full(buckets, smooth), np.full(buckets, smooth)
    at = summed.column("bucket").to_numpy()
    raw[at] += summed.column("raw").to_numpy()
    target[at] += summed.column("target").to_numpy()
    if target.sum() <= smooth * buckets * (1 + 1e-12):
        return np.zeros(buckets)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weights(docs: DataFrame, ratios: np.ndarray, orders: tuple[int, ...]) -> DataFrame:
    """doc_id, n_features, log_weight: one row per row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        ratios = sent.value
        for batch in batches:
            for part in steps(batch):
                bucket, owner = features(part.column("text"), len(ratios), orders)
                n = part.num_rows
                weight = np.bincount(owner, weights=ratios[bucket], minlength=n)
                count = np.bincount(owner, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(count, pa.int64()), pa.array(weight, pa.float64())], ["doc_id", "n_features", "log_weight"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_features long, log_weight double")


def gumbel(doc_id: Column, seed: int) -> Column:
    """Standard Gumbel noise from a 52-bit hash of seed and doc_id."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id.cast("string")), 12)
    return -F.log(-F.log((bits + 0.5) / F.lit(float(1 << 52))))


def _places(spark: SparkSession, values: DataFrame) -> DataFrame:
    """`_bits`: the doubles of `_key` as longs in the same order."""

    def run(batches):
        for batch in batches:
            bits = np.ascontiguousarray(batch.column("_key").to_numpy(zero_copy_only=False) + 0.0).view(np.int64)
            ordered = np.where(bits < 0, np.int64(_TOP) - bits - 1, bits)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(ordered)], [*names, "_bits"]
            )

    names = values.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in values.schema) + ", _bits long"
    return values.mapInArrow(run, schema)


def kth_highest(values: DataFrame, k: int) -> int | None:
    """The k-th highest of a column of longs, by four rounds of at most 65,536 counts; null if there are fewer."""
    known, left = 0, k  # the highest bits settled so far, of the value moved into 0 .. 2**64 - 1
    for shift in (48, 32, 16, 0):
        spread = F.shiftrightunsigned(F.col("_bits").bitwiseXOR(F.lit(_TOP)), shift)
        rows = values.select(spread.alias("_s"))
        if shift < 48:
            rows = rows.where(F.shiftrightunsigned("_s", 16) == known)
        counts = rows.groupBy(F.col("_s").bitwiseAND(0xFFFF).alias("_d")).count().collect()
        for r in sorted(counts, key=lambda r: -r._d):
            if left <= r["count"]:
                known = (known << 16) | r._d
                break
            left -= r["count"]
        else:
            return None
    return known + _TOP


def resample(
    docs: DataFrame,
    targets: DataFrame,
    *,
    fraction: float = 0.8,
    buckets: int = 1 << 16,
    orders: tuple[int, ...] = (1, 2),
    max_targets: int = 20_000,
    smooth: float = 1.0,
    seed: int = 11,
) -> DataFrame:
    """doc_id, n_features, log_weight, noisy (with Gumbel noise), kept (drawn): one row per row of docs."""
    ratios = log_ratios(docs, targets, buckets=buckets, orders=orders, max_targets=max_targets, smooth=smooth)
    weighed = log_weights(docs, ratios, orders).withColumn("_key", F.col("log_weight") + gumbel(F.col("doc_id"), seed))
    weighed = written(_places(docs.sparkSession, weighed), "resample-weights")
    k = math.ceil(fraction * weighed.count())
    least = kth_highest(weighed, k) if k else None
    kept = F.lit(False) if least is None else F.col("_bits") >= least
    return weighed.select("doc_id", "n_features", "log_weight", F.col("_key").alias("noisy"), kept.alias("kept"))


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; target texts are those labelled good and not toxic."""
    labels = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return resample(table(spark, sf_dir, "documents"), labels)
