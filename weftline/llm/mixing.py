"""Mix sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Rules. A document's size is its number of words (null text: 0). Sources are taken by code point, null last, and a null
source is a source like any other; their weights repeat `weights` in that order. Together they share `share` times all
sizes by weight; a source's target stops at `epochs` times its own size, and the excess is shared again by weight among the
rest until none is above. That fixed point is found in closed form: in ascending order of cap / weight, a source is at its
cap as long as what is left for it and all later ones would lift it there.

Of a source with target t and size s, every document is taken t // s times whole, and what is missing comes from one more
pass over its documents in a seeded order (a hash of seed and doc_id, then doc_id, then size), the last of them in part. So
each source takes its rounded target exactly, and a rerun takes the same. Rows that share doc_id and size are alike, so
it doesn't matter which of them comes first. A source or corpus without words has target 0. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.llm.common import WORD, written

#: Bits of the seeded hash that split a source for the running sum: its rows meet in this many groups, not in one.
BUCKET_BITS = 12
#: A table of sources up to this many rows is broadcast (about 100 bytes each); a larger one is joined by shuffle.
BROADCAST_SOURCES = 50_000


def seeded(doc_id: Column, seed: int) -> Column:
    """60 bits of md5 of 'seed:doc_id'."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], share: float, epochs: float) -> DataFrame:
    """source, source_size, target: one row per source. Counts are summed before they are shuffled."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = sums.select(
        "source",
        "source_size",
        F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.lit(float(share)) * F.sum("source_size").over(everything)).alias("pool"),
    ).withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    filled = ranked.select(
        "*",
        (F.col("pool") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
        F.sum("weight").over(onward).alias("weights"),
    ).withColumn("full", F.col("cap") * F.col("weights") <= F.col("left") * F.col("weight"))
    capped = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    level = F.col("weight") * (F.col("pool") - capped) / open_weight
    return filled.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(level).alias("target"))


def _sized(docs: DataFrame, keep: list[str], seed: int) -> DataFrame:
    return docs.select(
        *keep,
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        seeded(F.col("doc_id"), seed).alias("_key"),
    ).withColumn("_bucket", F.shiftright("_key", 60 - BUCKET_BITS).cast("int"))


def mix(
    docs: DataFrame,
    *,
    weights: list[int],
    share: float = 1.5,
    epochs: float = 2.0,
    seed: int = 7,
    keep: list[str] | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per row of docs; see the module for the rules. `keep`
    names further columns of docs to hand on; they must not be called like the results."""
    sizes = written(_sized(docs, ["doc_id", "source"], seed), "mix-sizes")
    targets = written(source_targets(sizes, weights, share, epochs), "mix-targets").select(
        "*", F.floor(F.col("target") + 0.5).alias("_goal")
    )
    whole = F.when(F.col("source_size") > 0, F.expr("_goal div source_size")).otherwise(0)
    targets = targets.withColumn("_whole", whole).withColumn(
        "_rest", F.col("_goal") - F.col("_whole") * F.col("source_size")
    )
    running = Window.partitionBy("source").orderBy("_bucket")
    ends = (
        sizes.groupBy("source", "_bucket")
        .agg(F.sum("size").alias("_sum"))
        .withColumn("_end", F.sum("_sum").over(running))
    )
    # the bucket in which the additional pass ends, and how many words it takes there
    last = (
        ends.alias("e")
        .join(targets.alias("t"), F.col("e.source").eqNullSafe(F.col("t.source")))
        .where(F.col("_end") > F.col("_rest"))
        .groupBy(F.col("t.source").alias("_source"))
        .agg(
            F.min("_bucket").alias("_last"),
            F.min_by(F.col("_rest") - (F.col("_end") - F.col("_sum")), "_bucket").alias("_inside"),
        )
    )
    plan = written(
        targets.join(last, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            F.col("source").alias("_source"), "source_size", "target", "_whole", "_last", "_inside"
        ),
        "mix-plan",
    )
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rows = sizes if keep is None else _sized(docs, list(dict.fromkeys(["doc_id", "source", *keep])), seed)
    planned = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    # only the last bucket of a source needs its rows in order; of the others it takes all or nothing
    within = Window.partitionBy("source").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    free = F.col("_inside") - F.coalesce(F.sum("size").over(within), F.lit(0))
    here = F.coalesce(F.col("_bucket") == F.col("_last"), F.lit(False))
    inside = planned.where(here).withColumn("_part", F.greatest(F.lit(0), F.least(F.col("size"), free)))
    others = planned.where(~here).withColumn(
        "_part", F.when(F.col("_bucket") < F.col("_last"), F.col("size")).otherwise(F.lit(0))
    )
    taken = (F.col("_whole") * F.col("size") + F.col("_part")).cast("long").alias("taken")
    named = [c for c in rows.columns if not c.startswith("_") and c != "size"]
    return others.unionByName(inside).select(*named, "size", "source_size", "target", taken)


def op7_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents, weights 3, 1, 2, 150 % of all words, at most two epochs."""
    from weftline.llm.common import table

    return mix(table(spark, sf_dir, "documents"), weights=[3, 1, 2]).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (
  SELECT source, source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
         1.5::DOUBLE * sum(source_size) OVER () AS pool, 2.0::DOUBLE * source_size AS cap FROM s),
f AS (
  SELECT *, pool - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM r),
g AS (SELECT *, cap * weights <= rest * weight AS is_full FROM f),
t AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE
         weight * (pool - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0))
         / sum(CASE WHEN NOT is_full THEN weight END) OVER () END AS target FROM g),
u AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS goal FROM t),
v AS (SELECT *, CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS whole FROM u),
o AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT o.doc_id, o.size, v.source_size, v.target,
       CAST(whole * size + greatest(0, least(size, goal - whole * source_size - before)) AS BIGINT) AS taken
FROM o JOIN v ON o.source IS NOT DISTINCT FROM v.source
"""
