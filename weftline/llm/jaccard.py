"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters, verified once per pair.

A text's set holds the 64-bit hashes of its n-word shingles; texts with equal sets are one class (64-bit fingerprint of the
set). Two classes link if 100 * intersection >= percent * union. The work grows with texts, not with pairs:

1. Profile: one pass gives each row's set size and fingerprint, and counts all shingles of all texts in 2**ORDER_BITS buckets.
   The counts are summed and kept as logarithms of one byte; they order shingles from rare to frequent (ties: the hash).
2. Prefixes: a second pass emits the first n - ceil(percent * n / 100) + 1 shingles of each set in that order. Two linked sets
   share at least one of them. They travel packed by target partition, once per class and task; the entries of a shingle
   that the counts show to be very frequent are dealt over several partitions. Shingles met in one class only end here.
3. Stars: each list has a lead, the class whose prefix is shared to the largest part, which in a group of edited copies is
   the one nearest to all. Each class is paired with the lead it shares most with. These pairs, at most one per class, are
   verified and joined to components. That takes in a group of thousands of near copies with as many pairs as it has members.
4. The rest: shingles whose lists still hold two components or more are joined with themselves, on pairs of different
   components that pass the length and positional filters, where the shingle is in the prefix that the two sizes call for. Pairs
   of which either class shares fewer of its prefix shingles with other components, whichever, than the two sizes call for are
   left out, and the others verified once, if they were not before. Pairs inside a component cannot change it.
5. Verification gets one text of either class, compressed, and takes its set anew; for prose that is less than half of the set's
   hashes, which travel where they are shorter. It bounds the overlap of both sets by counts in 16 ranges of hashes (suffix
   filter), then intersects them.

Rules. Null text, and text without words, has an empty set and links with nothing; its component is itself. A text with
fewer than n words is one shingle of all of them. A row without doc_id links with nothing and has no component. Rows that
repeat a doc_id are each judged by their own text. An empty table gives no rows. Two different sets have equal fingerprints
with a chance of 2**-64 a pair.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import STEP_BYTES, arrow_map, steps, table, written
from weftline.llm.components import components
from weftline.llm.words import mixed, shingles, words

#: Buckets of the corpus-wide shingle counts, and the slices they travel in.
ORDER_BITS = 22
SLICES = 64
#: Entries of prefixes that a partition gets on average, that a task holds before it hands them on, and that one
#: partition may get of a single shingle by the counts.
PER_PARTITION = 400_000
PER_FLUSH = 250_000
PER_SHINGLE = 50_000


def sets_of(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    every, bounds = shingles(words(texts, lower=True), n)
    return [np.unique(every[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def fingerprint(one: np.ndarray) -> int:
    """Of a set: a sum and a product-like mix over its members, so it does not depend on their order."""
    total = mixed(one ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(mixed(np.array([total + np.uint64(len(one))], np.uint64)).view(np.int64)[0])


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _planes(column: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones and so on: small numbers compress better so."""
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), -1).T.tobytes()


def _unplaned(data: bytes, kind: type, count: int, offset: int = 0) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, count * size, offset).reshape(size, count).T.copy().view(kind).reshape(-1)


def _profile(batches, n: int, percent: int):
    counts = np.zeros(1 << ORDER_BITS, np.uint32)
    names = ["doc_id", "n", "fp", "slice", "counts"]
    for batch in batches:
        for part in steps(batch):
            sets = sets_of(part.column("text"), n)
            if sets:
                np.add.at(counts, (np.concatenate(sets) >> np.uint64(64 - ORDER_BITS)).astype(np.int64), np.uint32(1))
            rows = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()),
                    pa.nulls(rows, pa.int32()),
                    pa.nulls(rows, pa.binary()),
                ],
                names,
            )
    if counts.any():
        packed = [zlib.compress(_planes(c), 1) for c in counts.reshape(SLICES, -1)]
        none = pa.nulls(SLICES, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, pa.array(range(SLICES), pa.int32()), pa.array(packed, pa.binary())], names
        )


def _summed(batches):
    """Counts of the slices that a task gets, batch by batch; at most 8 bytes a bucket."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, packed in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            one = _unplaned(zlib.decompress(packed), np.uint32, (1 << ORDER_BITS) // SLICES)
            sums[i] = sums[i] + one if i in sums else one.astype(np.uint64)
    levels = [np.minimum(255, np.round(4 * np.log2(1.0 + s))).astype(np.uint8).tobytes() for s in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array(levels, pa.binary())], ["slice", "levels"])


def shingle_levels(profile: DataFrame) -> np.ndarray:
    """Four times the binary logarithm of each bucket's count, one byte a bucket: 4 MB whatever the input."""
    rows = profile.where("slice IS NOT NULL").select("slice", "counts").repartition(SLICES, "slice")
    levels = np.zeros((SLICES, (1 << ORDER_BITS) // SLICES), np.uint8)
    for r in arrow_map(rows, _summed, "slice int, levels binary").collect():
        levels[r["slice"]] = np.frombuffer(r["levels"], np.uint8)
    return levels.reshape(-1)


def _packed(entries: list[tuple], parts: int, levels: np.ndarray):
    """Entries dealt by partition: per row one partition's shingles, positions, fingerprints and sizes."""
    shingle, level, fp, size, position = (np.concatenate(c) for c in zip(*entries, strict=True))
    lists = np.ceil(np.exp2(level / 4.0) / PER_SHINGLE).astype(np.uint64)
    salt = mixed(fp.view(np.uint64)) % np.maximum(lists, np.uint64(1))
    part = (mixed(shingle + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    ends = np.r_[cuts[1:], len(part)]
    columns = [shingle[order], (lists > 1)[order], fp[order], size[order], position[order]]
    blobs = [[] for _ in range(2)]
    for a, b in zip(cuts.tolist(), ends.tolist(), strict=True):
        blobs[0].append(columns[0][a:b].tobytes())
        spread, fps, *small = (c[a:b] for c in columns[1:])
        blobs[1].append(zlib.compress(spread.tobytes() + fps.tobytes() + b"".join(map(_planes, small)), 1))
    return pa.RecordBatch.from_arrays(
        [pa.array(part[cuts].astype(np.int32)), pa.array(blobs[0], pa.binary()), pa.array(blobs[1], pa.binary())],
        ["part", "shingles", "rest"],
    )


def _prefixes(batches, n: int, percent: int, parts: int, levels: np.ndarray):
    held, count, seen = [], 0, set()
    for batch in batches:
        for part in steps(batch):
            ids = part.column("doc_id").is_valid().to_pylist()
            for known, one in zip(ids, sets_of(part.column("text"), n), strict=True):
                if not known or not len(one) or (fp := fingerprint(one)) in seen:
                    continue
                if len(seen) < 1_000_000:  # entries of a class met again only repeat
                    seen.add(fp)
                level = levels[(one >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
                first = np.argsort(level, kind="stable")[: prefix_length(len(one), percent)]
                k = len(first)
                held.append(
                    (one[first], level[first], np.full(k, fp, np.int64), np.full(k, len(one), np.int32), np.arange(k, dtype=np.int32))
                )
                count += k
                if count >= PER_FLUSH:
                    yield _packed(held, parts, levels)
                    held, count = [], 0
    if held:
        yield _packed(held, parts, levels)


def _shared(batches):
    """Entries whose shingle more than one class has, and all of those dealt over several partitions. One partition may
    be several keys of `part`; each key's rows come together because the rows of a task are sorted by it."""

    def flush(held):
        shingle = np.concatenate([np.frombuffer(s, np.uint64) for s, _ in held])
        spread, fp, size, position = [], [], [], []
        for s, rest in held:
            k, data = len(s) // 8, zlib.decompress(rest)
            spread.append(np.frombuffer(data, bool, k))
            fp.append(np.frombuffer(data, np.int64, k, k))
            size.append(_unplaned(data, np.int32, k, 9 * k))
            position.append(_unplaned(data, np.int32, k, 13 * k))
        spread, fp, size, position = map(np.concatenate, (spread, fp, size, position))
        order = np.lexsort((fp, shingle))
        shingle, spread, fp, size, position = (c[order] for c in (shingle, spread, fp, size, position))
        new = np.r_[True, (shingle[1:] != shingle[:-1]) | (fp[1:] != fp[:-1])]
        shingle, spread, fp, size, position = (c[new] for c in (shingle, spread, fp, size, position))
        alike = shingle[1:] == shingle[:-1]
        keep = spread | np.r_[False, alike] | np.r_[alike, False]
        return pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in (shingle.view(np.int64), fp, size, position)], ["shingle", "fp", "n", "pos"]
        )

    at, held = None, []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "shingles", "rest"))
        for part, shingle, rest in zip(*columns, strict=True):
            if part != at and held:
                yield flush(held)
                held = []
            at = part
            held.append((shingle, rest))
    if held:
        yield flush(held)


def _small(df: DataFrame, most: int = 2_000_000) -> DataFrame:
    """A written frame of a few longs a row, marked for broadcast if it has at most `most` rows; else it joins by shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def overlap_needed(a, b, percent: int):
    """Least intersection of sets of these sizes that link: ceil(percent * (a + b) / (100 + percent))."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent))


def shared_needed(a, b, percent: int):
    """Least number of shingles that two linked sets share in their prefixes: common ones up to the smaller of the two last
    prefix shingles are in both prefixes, and behind it at most the rest of one set is left."""
    rest = F.ceil(F.lit(percent) * F.greatest(a, b) / F.lit(100)) - 1
    return F.greatest(F.lit(1), overlap_needed(a, b, percent) - rest)


def _linked(pairs: list[tuple[int, int]], texts: dict[int, bytes], sets: dict[int, np.ndarray], n: int, percent: int):
    bins = (np.arange(1, 16, dtype=np.uint64)) << np.uint64(60)
    if texts:
        sets = sets | dict(zip(texts, sets_of(pa.array(texts.values(), pa.large_binary()), n), strict=True))
    keep = []
    for a, b in pairs:
        x, y = sets[a], sets[b]
        needed = -(-percent * (len(x) + len(y)) // (100 + percent))
        per = [np.diff(np.r_[0, np.searchsorted(s, bins), len(s)]) for s in (x, y)]
        if np.minimum(*per).sum() < needed:
            continue
        merged = np.concatenate([x, y])
        merged.sort()
        if int((merged[1:] == merged[:-1]).sum()) >= needed:
            keep.append((a, b))
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in keep], pa.int64()), pa.array([b for _, b in keep], pa.int64())], ["a", "b"]
    )


def _verified(batches, n: int, percent: int):
    """Texts are unpacked one pair after the other, so that a step holds few bytes however well they compress."""
    for batch in batches:
        pairs, texts, sets, size = [], {}, {}, 0
        for a, b, x, y in zip(*(batch.column(c) for c in ("a", "b", "packed_a", "packed_b")), strict=True):
            pairs.append((a.as_py(), b.as_py()))
            for fp, packed in zip(pairs[-1], (x.as_py(), y.as_py()), strict=True):
                if fp in texts or fp in sets:
                    continue
                if packed[0]:
                    texts[fp] = zlib.decompress(packed[1:])
                    size += len(texts[fp])
                else:
                    sets[fp] = np.frombuffer(packed, np.uint64, offset=1)
                    size += len(packed)
            if size >= STEP_BYTES:
                yield _linked(pairs, texts, sets, n, percent)
                pairs, texts, sets, size = [], {}, {}, 0
        if pairs:
            yield _linked(pairs, texts, sets, n, percent)


def verify(pairs: DataFrame, texts: DataFrame, *, n: int, percent: int) -> DataFrame:
    """The pairs (a, b: fingerprints) that link."""
    left = texts.select(F.col("fp").alias("a"), F.col("packed").alias("packed_a"))
    right = texts.select(F.col("fp").alias("b"), F.col("packed").alias("packed_b"))
    return arrow_map(pairs.join(left, "a").join(right, "b"), lambda it: _verified(it, n, percent), "a long, b long")


def _text_rows(batches, n: int):
    for batch in batches:
        for part in steps(batch):
            sets = sets_of(part.column("text"), n)
            rows = [
                (fingerprint(s), min(b"\0" + s.tobytes(), b"\1" + zlib.compress(t), key=len))
                for s, t in zip(sets, part.column("text").cast(pa.large_binary()).to_pylist(), strict=True)
                if len(s)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([fp for fp, _ in rows], pa.int64()), pa.array([t for _, t in rows], pa.binary())], ["fp", "packed"]
            )


def class_texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """fp, packed of the classes in pairs: a 1 and the whole text of one row of each, compressed, or a 0 and its set if shorter."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct().join(classes, "fp")
    wanted = written(wanted.select(F.col("rep").alias("doc_id")), "jaccard-wanted")
    texts = docs.select("doc_id", "text").join(_small(wanted), "doc_id", "left_semi")
    rows = arrow_map(texts, lambda it: _text_rows(it, n), "fp long, packed binary")
    return written(rows.dropDuplicates(["fp"]), "jaccard-texts")


def other_pairs(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may link; rest: entries (shingle, fp, n, pos, _comp) of all shingles that
    classes of different components share in their prefixes."""
    x, y = rest.alias("x"), rest.alias("y")
    needed = overlap_needed(F.col("x.n"), F.col("y.n"), percent)
    most = F.least("x.pos", "y.pos") + 1 + F.least(F.col("x.n") - F.col("x.pos") - 1, F.col("y.n") - F.col("y.pos") - 1)
    met = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle"))
        & (F.col("x._comp") < F.col("y._comp"))
        & (F.lit(100) * F.least("x.n", "y.n") >= F.lit(percent) * F.greatest("x.n", "y.n"))
        # two sets that share `needed` shingles share one of the first n - needed + 1 of each: for sets of like
        # sizes that is little more than half of the prefix, without its frequent end
        & (F.col("x.pos") <= F.col("x.n") - needed)
        & (F.col("y.pos") <= F.col("y.n") - needed)
        & (most >= needed),
    )
    least = shared_needed(F.col("x.n"), F.col("y.n"), percent).alias("_least")
    pairs = met.select(F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b"), least).distinct()
    # a class that shares few of its prefix shingles with all others together shares no more with any one of them
    own = _small(written(rest.groupBy("fp").agg(F.count(F.lit(1)).alias("_own")), "jaccard-own"))
    for side in ("a", "b"):
        pairs = pairs.join(own.withColumnRenamed("fp", side), side).where("_own >= _least").drop("_own")
    return pairs.select("a", "b")


def class_links(docs: DataFrame, profile: DataFrame, *, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """classes (fp, rep: its smallest doc_id, n) and enough links between them (a, b) for their components to be exact."""
    rows = profile.where("doc_id IS NOT NULL AND fp IS NOT NULL")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "jaccard-classes")
    entries = classes.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-int(entries) // PER_PARTITION))
    sent = docs.sparkSession.sparkContext.broadcast(shingle_levels(profile))
    emitted = arrow_map(
        docs.select("doc_id", "text"),
        lambda it: _prefixes(it, n, percent, parts, sent.value),
        "part int, shingles binary, rest binary",
    )
    dealt = emitted.repartition(parts, "part").sortWithinPartitions("part")
    shared = written(arrow_map(dealt, _shared, "shingle long, fp long, n int, pos int"), "jaccard-shared")

    sizes = lambda x, y: F.lit(100) * F.least(x, y) >= F.lit(percent) * F.greatest(x, y)
    # the original of a group of edited copies shares almost all of its prefix; an edited copy starts with its own shingles
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    share = shared.groupBy("fp").agg((F.count(F.lit(1)) / F.first(prefix)).alias("_share"))
    placed = shared.join(_small(written(share, "jaccard-share")), "fp")
    first = placed.groupBy("shingle").agg(F.max_by(F.struct("fp", "n"), F.struct("_share", "fp")).alias("lead"))
    stars = (
        shared.join(first, "shingle")
        .where((F.col("fp") != F.col("lead.fp")) & sizes(F.col("n"), F.col("lead.n")))
        .groupBy("fp", "n", F.col("lead.fp").alias("lead"), F.col("lead.n").alias("lead_n"))
        .agg(F.count(F.lit(1)).alias("_c"))
        .where(F.col("_c") >= shared_needed(F.col("n"), F.col("lead_n"), percent))
        .groupBy("fp")
        .agg(F.max_by("lead", F.struct("_c", "lead")).alias("lead"))
        .select(F.least("fp", "lead").alias("a"), F.greatest("fp", "lead").alias("b"))
        .distinct()
    )
    stars = written(stars, "jaccard-stars")
    links = written(verify(stars, class_texts(docs, classes, stars, n), n=n, percent=percent), "jaccard-links")
    found = components(links).select(F.col("node").alias("fp"), F.col("component").alias("_comp"))
    placed = shared.join(_small(found), "fp", "left").withColumn("_comp", F.coalesce("_comp", "fp"))
    uneven = placed.groupBy("shingle").agg(F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi")).where("_lo != _hi")
    uneven = written(uneven.select("shingle"), "jaccard-uneven")
    rest = written(placed.join(_small(uneven), "shingle", "left_semi"), "jaccard-rest")
    pairs = other_pairs(rest, percent).join(stars, ["a", "b"], "left_anti")
    pairs = written(pairs, "jaccard-pairs")
    more = written(verify(pairs, class_texts(docs, classes, pairs, n), n=n, percent=percent), "jaccard-more")
    return classes, links.unionByName(more)


def jaccard_join(docs: DataFrame, *, n: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links): one row per row of docs; doc_id is a long."""
    profile = written(
        arrow_map(
            docs.select("doc_id", "text"),
            lambda it: _profile(it, n, percent),
            "doc_id long, n long, fp long, slice int, counts binary",
        ),
        "jaccard-profile",
    )
    classes, links = class_links(docs, profile, n=n, percent=percent)
    found = components(links).select(F.col("node").alias("fp"), F.col("component").alias("_comp"))
    named = classes.join(found, "fp", "left").withColumn("_comp", F.coalesce("_comp", "fp"))
    least = named.groupBy("_comp").agg(F.min("rep").alias("_least"))
    named = written(named.join(least, "_comp").select("fp", "_least"), "jaccard-components")
    rows = profile.where("slice IS NULL").select("doc_id", F.col("n").alias("n_shingles"), "fp")
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("_least", "doc_id"))
    return rows.join(named, "fp", "left").select("doc_id", "n_shingles", alone.alias("component_id"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, five words, Jaccard of 0.75 or more."""
    return jaccard_join(table(spark, sf_dir, "documents"))
