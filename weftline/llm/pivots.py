"""Embedding near-duplicates by a pivot-permutation index.

A vector is described by the set of its `nearest` nearest reference points; the order of closeness among them is not used, so
more pairs are looked at than an ordered description would leave, and none is lost. Reference points are vectors of a
bounded sample of each length (lowest hashes), taken only if they are not close to one taken before, so that a large group of near copies
does not use them up. Lists of vectors are kept under pairs of pivots: two vectors that share at least two pivots meet in a
list, so the shared-pivot count is two or more for all that meet, and each pair is looked at only in the list of the two
smallest pivots they share. Every vector is indexed; a list longer than `tile` is cut into blocks and handled by pairs
of blocks, so nothing bigger than two blocks of vectors is ever in a task at once. Candidates are verified in double precision.
Counts and links leave a tile summed per vector: one row with the number of partners and one link that holds its group together.

Equal vectors of a label are one class, found by a grouping with partial sums; a class counts its members as linked.

Rules. Only vectors of one label, not null, and one length are compared. A vector that is null, zero, or has a null or
non-finite component links with nothing, and so does a row without label or vec_id; its component is its own vec_id, and it is
kept (without vec_id: component null, not kept). Repeated rows are vectors of their own and link. An empty table gives no rows.
Two classes that share fewer than two of their nearest pivots are missed; at a cosine of 0.93 (64 numbers, random pairs) that is
about 0.3 % with 1,024 pivots and 2.2 % with 8,192, and less for closer ones. The number of pivots follows the table
(`pivots_for`): 1,024 up to 9.6 million vectors of a label, 8,192 from 153 million on; beyond 613 million lists get longer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import arrow_map, table, written
from weftline.llm.components import components


def matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of a list column of one length, as doubles of unit length."""
    if not len(vectors):
        return np.zeros((0, 0))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    largest = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / largest  # so that squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


#: Pivots: FEWEST, doubled until a list of unrelated vectors of one label has at most EXPECTED, and at most MOST.
FEWEST, MOST, EXPECTED = 1024, 8192, 512


def pivots_for(rows: int, nearest: int) -> int:
    """How many pivots keep lists short: `rows` vectors of a label are spread over the pairs of pivots, each in the lists of
    all pairs of its nearest ones."""
    pivots = FEWEST
    while pivots < MOST and rows * nearest * (nearest - 1) > EXPECTED * pivots * pivots:
        pivots *= 2
    return pivots


#: Numbers that the samples of all lengths hold together, unless that of the most frequent length needs more.
SAMPLE_NUMBERS = 1 << 24


def reference_points(classes: DataFrame, *, pivots: int | None, nearest: int, sample: int, apart: float) -> dict[int, np.ndarray]:
    """By length of vectors: up to `pivots` unit vectors (None: as many as the largest label of that length asks for) from at
    most `sample` rows of that length for every 1,024 pivots, no two closer than `apart` if there are enough such. Lengths are
    served by frequency; those for which SAMPLE_NUMBERS leaves nothing are not in it."""
    counts = classes.groupBy("dim", "label").count().groupBy("dim").agg(F.sum("count").alias("n"), F.max("count").alias("most"))
    counts = counts.orderBy(F.desc("n"), "dim").collect()
    left = max(SAMPLE_NUMBERS, sample * counts[0]["dim"]) if counts else 0
    shares, wanted = {}, {}
    for dim, n, most in counts:
        wanted[dim] = pivots or pivots_for(most, nearest)
        if take := min(n, sample * max(1, wanted[dim] // FEWEST), left // dim):
            shares[dim] = (take, min(2.0, (1.1 * take + 200) / n))  # a little more than wanted; cut to it below
            left -= take * dim
    if not shares:
        return {}
    part = classes.sparkSession.createDataFrame([(d, s) for d, (_, s) in shares.items()], "dim int, _share double")
    place = F.xxhash64("cid", "label", "vector")
    rows = classes.join(F.broadcast(part), "dim").withColumn("_place", place)
    rows = rows.where(F.col("_place") / 2.0**64 + 0.5 < F.col("_share")).select("dim", "vector", "_place").toArrow()
    out = {}
    dims, places = np.asarray(rows.column("dim")), np.asarray(rows.column("_place"))
    vectors = rows.column("vector").combine_chunks()
    for dim in sorted(set(dims.tolist())):
        mine = np.flatnonzero(dims == dim)
        mine = mine[np.argsort(places[mine], kind="stable")][: shares[dim][0]]
        units = matrix(vectors.take(pa.array(mine)))
        taken = np.zeros((min(wanted[dim], len(units)), int(dim)))
        n = 0
        for unit in units:
            if n == len(taken):
                break
            if not n or (taken[:n] @ unit).max() < apart:
                taken[n] = unit
                n += 1
        out[int(dim)] = np.vstack([taken[:n], units])[: max(2, n)]
    return out


def _postings(batches, points: dict[int, np.ndarray], nearest: int):
    """One row per vector and pair of its nearest pivots; `tops` is the list of all its nearest ones."""
    names = ["label", "dim", "cid", "mult", "key", "tops"]
    for whole in batches:
        for batch in (whole.slice(i, 2048) for i in range(0, whole.num_rows, 2048)):
            dims = np.asarray(batch.column("dim"))
            for dim in sorted(set(dims.tolist())):
                mine = batch.take(pa.array(np.flatnonzero(dims == dim)))
                if dim in points:
                    close = matrix(mine.column("vector")) @ points[dim].T
                else:  # no reference points: one list for all of this length
                    close = np.zeros((mine.num_rows, 1))
                k = min(nearest, close.shape[1])
                tops = np.sort(np.argsort(-close, axis=1, kind="stable")[:, :k], axis=1).astype(np.int64)
                if k < 2:  # a single reference point is one list
                    tops, k = np.hstack([tops, tops + 1]), 2
                a, b = np.triu_indices(k, 1)
                keys = (tops[:, a] << 20) | tops[:, b]
                n, per = keys.shape
                rows = np.repeat(np.arange(n), per)
                packed = pa.array([t.tobytes() for t in tops.astype(np.int32)], pa.binary())
                columns = [mine.column(c).take(pa.array(rows)) for c in names[:4]]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(keys.reshape(-1)), packed.take(pa.array(rows))], names
                )


def _groups(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each of n places' groups under links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        label = label[label]
        if (label == before).all():
            break
    return label


#: Pairs of a tile that are looked at at once: about 64 bytes each for the shared pivots.
_PAIRS = 1 << 16


def _two_smallest_shared(tops_i: np.ndarray, tops_j: np.ndarray, p: int, q: int) -> np.ndarray:
    """Whether p and q are the two smallest pivots that both rows have; rows are ascending."""
    shared = (tops_i[:, :, None] == tops_j[:, None, :]).any(axis=2)
    rows = np.arange(len(shared))
    first = shared.argmax(axis=1)
    here = shared[rows, first] & (tops_i[rows, first] == p)
    shared[rows, first] = False
    second = shared.argmax(axis=1)
    return here & shared[rows, second] & (tops_i[rows, second] == q)


def _tile(key: int, rows: dict[str, np.ndarray], least: float, step: int = 256):
    """Partners and a link of each vector in one tile: all pairs of one block, or of two."""
    units, tops, block, lo, hi = rows["unit"], rows["tops"], rows["block"], rows["lo"], rows["hi"]
    first = np.flatnonzero(block == lo)
    second = first if lo == hi else np.flatnonzero(block == hi)
    p, q = key >> 20, key & ((1 << 20) - 1)
    pairs = []
    for at in range(0, len(first), step):
        mine = first[at : at + step]
        near = units[mine] @ units[second].T
        i, j = np.nonzero(near >= least - 1e-9)
        cosine = near[i, j]
        i, j = mine[i], second[j]
        if lo == hi:
            i, j, cosine = i[i < j], j[i < j], cosine[i < j]
        for begin in range(0, len(i), _PAIRS):  # a pair counts only in the list of the two smallest shared pivots
            a, b, c = (x[begin : begin + _PAIRS] for x in (i, j, cosine))
            here = np.flatnonzero(_two_smallest_shared(tops[a], tops[b], p, q))
            a, b, c = a[here], b[here], c[here]
            close = np.flatnonzero(c < least + 1e-9)  # summed again in order, as the product's order is not fixed
            c[close] = (units[a[close]] * units[b[close]]).sum(axis=1)
            pairs.append((a[c >= least], b[c >= least]))
    i, j = (np.concatenate(c) for c in zip(*pairs, strict=True)) if pairs else (np.zeros(0, int), np.zeros(0, int))
    n = len(units)
    partners = np.bincount(i, weights=rows["mult"][j], minlength=n) + np.bincount(j, weights=rows["mult"][i], minlength=n)
    return partners.astype(np.int64), _groups(n, i, j)


def _tiles(batches, least: float):
    """Tiles one after another, as the rows of a task are sorted by tile."""
    names = ["cid", "partners", "link"]

    def flush(held):
        t = pa.Table.from_batches(held).combine_chunks()
        key, lo, hi = (t.column(c)[0].as_py() for c in ("key", "lo", "hi"))
        tops = np.frombuffer(b"".join(t.column("tops").to_pylist()), np.int32).reshape(t.num_rows, -1)
        cid = t.column("cid").to_numpy()
        order = np.argsort(cid, kind="stable")  # the smallest place of a group is its smallest id
        rows = {
            "unit": matrix(t.column("vector").combine_chunks())[order],
            "tops": tops[order],
            "block": t.column("block").to_numpy()[order],
            "mult": t.column("mult").to_numpy()[order].astype(np.float64),
            "lo": lo,
            "hi": hi,
        }
        partners, group = _tile(key, rows, least)
        some = np.flatnonzero(partners)
        ids = cid[order]
        return [ids[some], partners[some], ids[group[some]]]

    at, held, out = None, [], []
    for batch in batches:
        ids = list(zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "key", "lo", "hi")), strict=True))
        begin = 0
        for i in range(1, len(ids) + 1):
            if i < len(ids) and ids[i] == ids[begin]:
                continue
            if ids[begin] != at and held:
                out.append(flush(held))
                held = []
            at = ids[begin]
            held.append(batch.slice(begin, i - begin))
            begin = i
        if sum(len(o[0]) for o in out) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names)
            out = []
    if held:
        out.append(flush(held))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names)


def near_duplicates(
    rows: DataFrame,
    *,
    least: float = 0.93,
    pivots: int | None = None,
    nearest: int = 8,
    sample: int = 8192,
    apart: float = 0.6,
    tile: int = 2048,
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of rows (vec_id: long, embedding: array, label)."""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False)
    )
    plain = rows.select("vec_id", F.when(usable, F.col("label")).alias("label"), F.transform(vector, lambda x: x + 0.0).alias("vector"))
    classes = (
        plain.where("label IS NOT NULL")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("mult"))
        .withColumn("dim", F.size("vector"))
    )
    # two labels may share a vec_id: the class is told by both
    classes = written(classes, "pivot-classes")
    points = reference_points(classes, pivots=pivots, nearest=nearest, sample=sample, apart=apart)
    sent = rows.sparkSession.sparkContext.broadcast(points)
    label = classes.schema["label"].dataType.simpleString()
    postings = written(
        arrow_map(
            classes,
            lambda it: _postings(it, sent.value, nearest),
            f"label {label}, dim int, cid long, mult long, key long, tops binary",
        ),
        "pivot-postings",
    )
    lists = ["label", "dim", "key"]
    sizes = postings.groupBy(*lists).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / tile).cast("int")
    block = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    met = postings.join(sizes, lists).withColumn("block", block)
    met = met.select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_other"))
    met = met.select(
        *lists, "cid", "mult", "tops", "block", F.least("block", "_other").alias("lo"), F.greatest("block", "_other").alias("hi")
    )
    held = met.join(classes.select("label", "cid", "vector"), ["label", "cid"])
    tiles = [*lists, "lo", "hi"]
    dealt = held.repartition(*tiles).sortWithinPartitions(*tiles)
    found = written(arrow_map(dealt, lambda it: _tiles(it, least), "cid long, partners long, link long"), "pivot-links")
    counts = found.groupBy("cid").agg(F.sum("partners").alias("_p"))
    groups = components(found.select(F.col("cid").alias("a"), F.col("link").alias("b")))
    named = (
        classes.select("label", "vector", "cid", "mult")
        .join(counts, "cid", "left")
        .join(groups.withColumnRenamed("node", "cid"), "cid", "left")
        .select(
            "label",
            "vector",
            (F.coalesce("_p", F.lit(0)) + F.col("mult") - 1).alias("n_links"),
            F.coalesce("component", "cid").alias("component_id"),
        )
    )
    out = plain.join(named, ["label", "vector"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op3_pivot_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, cosine of 0.93 or more within a label."""
    return near_duplicates(table(spark, sf_dir, "embeddings").withColumn("vec_id", F.col("vec_id").cast("long")))
