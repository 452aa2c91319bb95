"""Ranked lexical search with equal bags scored once.

For a set of items only the words that some item holds matter. So a document is restricted to the items' vocabulary: its bag
is its tf vector over that vocabulary, and its length enters as the whole number m. Documents with the same bag and the same m
score alike for every item, so they form a class: classes are found by a 64-bit hash and verified on the whole bag, each class
is scored once, and only the classes that reach some item's best are expanded to their members by ascending doc_id.

1. One pass over the texts writes each document's number of terms and its bag; from these the counts N, L and df follow.
2. Classes are a `groupBy` of (hash, bag, m) with the smallest doc_id. A class with very many members is one row from the
   map side on.
3. Scores are sums of whole numbers below 2**53, so a matrix product in doubles is exact. Terms that many items hold go
   through dense products, the others through lists of items; either way each posting counts. A task keeps, per item, the
   `top` classes by score and smallest doc_id: no document can rank before the first member of its class, so the `top`
   documents of an item are members of these classes.
4. The surviving classes (at most `top` an item) are joined to the documents; of each the first `top` members count.

Items are taken in blocks of at most `PAIRS` (item, term) pairs: a block's vocabulary and weights are what is broadcast.

Rules. Terms are runs of ASCII digits and letters and of characters beyond ASCII; only A-Z is lower-cased. Null and empty
texts have no terms. Rows of one item_id are one item with the terms of all of them, each once; items without item_id are left out. Rows
of documents without doc_id count in N, L and df but are not ranked; rows that repeat a doc_id are ranked each. Without
documents or items there are no rows. Long texts are split into terms `CHUNK` bytes at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.llm.common import arrow_map, steps, table, written

TOP = 10
#: Most (item, term) pairs of a block of items; 1 M pairs are about 50 MB in a task.
PAIRS = 1 << 20
#: Cells of a score table (classes x items) that a task holds at once.
CELLS = 1 << 20
#: Bytes of text that are split into terms at once.
CHUNK = 1 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# every byte as it stands in a term, or a blank between terms
_BYTES = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower()
)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of about CHUNK bytes."""
    flat = text.translate(_BYTES)
    at = 0
    while at < len(flat):
        to = at + CHUNK
        if to < len(flat):
            cut = flat.find(b" ", to)
            to = len(flat) if cut < 0 else cut
        yield flat[at:to].split()
        at = to


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term: the terms of each item, once each."""
    found = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    return items.where("item_id IS NOT NULL").select("item_id", F.explode(found).alias("term")).distinct()


def bags(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms of the text), bag: sorted pairs (term's place in the vocabulary, tf) as 32-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        place = {t: i for i, t in enumerate(shared.value)}
        for batch in batches:
            for part in steps(batch):
                n, packed = [], []
                for text in part.column("text").cast(pa.large_binary()).to_pylist():
                    held, total = Counter(), 0
                    for some in terms(text or b""):
                        total += len(some)
                        held.update(filter(place.__contains__, some))
                    n.append(total)
                    pairs = sorted((place[t], tf) for t, tf in held.items())
                    packed.append(np.array(pairs, "<u4").tobytes())
                columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "bag"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, n long, bag binary")


def document_counts(bagged: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary is: one row per task and term, summed by Spark."""

    def run(batches):
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for bag in batch.column("bag").to_pylist():
                counts[np.frombuffer(bag, "<u4")[::2]] += 1
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["term", "df"])

    rows = arrow_map(bagged.select("bag"), run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    counts = np.zeros(size, np.int64)
    for r in rows:
        counts[r.term] = r.df
    return counts


class Weights:
    """The items' terms with their weights: a dense table of the terms that many items hold, lists of items for the rest."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weight: np.ndarray, n_items: int, n_terms: int):
        order = np.argsort(term, kind="stable")
        self.items, sorted_terms = item[order], term[order]
        self.n_items = n_items
        self.bounds = np.searchsorted(sorted_terms, np.arange(n_terms + 1))
        self.weight = weight  # by term
        sizes = np.diff(self.bounds)
        # a dense row costs as much as a list of about a sixteenth of the items; the table stays below CELLS cells
        common = np.flatnonzero(sizes * 16 >= max(n_items, 16))
        common = common[np.argsort(-sizes[common], kind="stable")][: max(CELLS // max(n_items, 1), 1)]
        self.dense_row = np.full(n_terms, -1)
        self.dense_row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), n_items))
        for row, t in enumerate(common.tolist()):
            self.dense[row, self.items[self.bounds[t] : self.bounds[t + 1]]] = weight[t]

    def scores(self, owner: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """classes x items: sums of weight * ((10**9 tf) div (1000 tf + 8 m)), exact."""
        part = (1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])
        row = self.dense_row[term]
        common = row >= 0
        table_ = np.zeros((len(m), len(self.dense)))
        table_[owner[common], row[common]] = part[common]
        out = table_ @ self.dense
        rare = ~common
        owner, term, part = owner[rare], term[rare], part[rare]
        sizes = self.bounds[term + 1] - self.bounds[term]
        at = np.repeat(self.bounds[term] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        cells = np.repeat(owner, sizes) * self.n_items + self.items[at]
        add = np.repeat(part * self.weight[term], sizes).astype(float)
        out += np.bincount(cells, weights=add, minlength=out.size).reshape(out.shape)
        return out


class Best:
    """Per item the best classes so far, by score and then by the smallest doc_id."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.score = np.zeros((n_items, 0))
        self.first = np.zeros((n_items, 0), np.int64)
        self.hash = np.zeros((n_items, 0), np.int64)

    def add(self, scores: np.ndarray, first: np.ndarray, hashes: np.ndarray) -> None:
        n_items = len(self.score)
        if self.score.shape[1] == self.top:  # only classes that can reach some item's best
            reach = (scores >= self.score[:, -1]).any(axis=1)
            scores, first, hashes = scores[reach], first[reach], hashes[reach]
        score = np.c_[self.score, scores.T]
        first_ = np.c_[self.first, np.broadcast_to(first, (n_items, len(first)))]
        hash_ = np.c_[self.hash, np.broadcast_to(hashes, (n_items, len(hashes)))]
        by = np.lexsort((first_, -score), axis=1)[:, : self.top]
        self.score, self.first, self.hash = (np.take_along_axis(c, by, 1) for c in (score, first_, hash_))


def best_classes(classes: DataFrame, weights: Weights, top: int) -> DataFrame:
    """item (its place), score, h, first: the best classes of each task."""
    shared = classes.sparkSession.sparkContext.broadcast(weights)
    step = max(CELLS // max(weights.n_items, len(weights.dense), 1), 1)

    def run(batches):
        found = shared.value
        best = Best(found.n_items, top)
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                packed = part.column("bag").to_pylist()
                pairs = np.frombuffer(b"".join(packed), "<u4").reshape(-1, 2).astype(np.int64)
                owner = np.repeat(np.arange(len(packed)), [len(b) // 8 for b in packed])
                m = part.column("m").to_numpy()
                scores = found.scores(owner, pairs[:, 0], pairs[:, 1], m)
                best.add(scores, part.column("first").to_numpy(), part.column("h").to_numpy())
        item, place = np.nonzero(best.score > 0)
        chosen = [c[item, place] for c in (best.score.astype(np.int64), best.hash, best.first)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (item, *chosen)], ["item", "score", "h", "first"])

    return arrow_map(classes.select("h", "bag", "m", "first"), run, "item long, score long, h long, first long")


def _ranked(df: DataFrame, by: list[str], order: list, top: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, block: DataFrame, items: list, pairs: list, top: int) -> DataFrame:
    """The ranking of one block of items: `items` are their ids, `pairs` their (item_id, term)."""
    vocabulary = sorted({t.encode() for _, t in pairs})
    place = {t: i for i, t in enumerate(vocabulary)}
    number = {item: i for i, item in enumerate(items)}
    bagged = written(bags(docs, vocabulary), "search-bags")
    total = bagged.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = document_counts(bagged, len(vocabulary))
    weight = np.floor(1000 * np.log((2 * total.docs + 2) / (2 * df + 1))).astype(np.int64)
    m = F.expr(f"100 - 90 + ((90 * n * {total.docs}L) div {max(total.terms, 1)}L)")
    held = bagged.where("doc_id IS NOT NULL AND length(bag) > 0").select(
        F.col("doc_id").cast("long").alias("doc_id"), m.cast("long").alias("m"), "bag"
    ).withColumn("h", F.xxhash64("bag", "m"))
    classes = written(held.groupBy("h", "bag", "m").agg(F.min("doc_id").alias("first")), "search-classes")
    weights = Weights(
        np.array([number[i] for i, _ in pairs]), np.array([place[t.encode()] for _, t in pairs]), weight, len(items), len(vocabulary)
    )
    best = _ranked(best_classes(classes, weights, top), ["item"], [F.desc("score"), "first", "h"], top).drop("rank")
    best = written(best, "search-best")
    # the bags of the chosen classes, at most `top` an item, and of each class its first members
    chosen = classes.join(best.select("h", "first").distinct(), ["h", "first"]).select("h", "bag", "m", "first")
    members = held.join(chosen, ["h", "bag", "m"]).select("h", "first", "doc_id")
    members = _ranked(members, ["h", "first"], ["doc_id"], top).drop("rank")
    ranking = _ranked(best.join(members, ["h", "first"]), ["item"], [F.desc("score"), "doc_id"], top)
    return ranking.join(block, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, pairs_per_block: int = PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of each item, at most `top`, with a score above 0."""
    spark = docs.sparkSession
    wanted = written(item_terms(items), "search-items")
    sizes = wanted.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n"))
    most = sizes.agg(F.sum("_n").alias("all"), F.max("_n").alias("one")).first()
    n_blocks = -(-2 * (most["all"] or 0) // pairs_per_block) if (most["all"] or 0) > pairs_per_block else 1
    number = F.pmod(F.xxhash64("item_id"), F.lit(n_blocks))
    out = None
    kind = items.schema["item_id"].dataType.simpleString()
    for k in range(n_blocks):
        pairs = [tuple(r) for r in wanted.where(number == k).collect()]  # half of pairs_per_block on average
        if not pairs:
            continue
        ids = sorted({i for i, _ in pairs})
        block = spark.createDataFrame(list(enumerate(ids)), f"item long, item_id {kind}")
        found = _search_block(docs, block, ids, pairs, top)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}')) AS term
  FROM documents),
i AS (
  SELECT DISTINCT item_id, term FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '{term}')) AS term FROM benchmark)),
c AS (SELECT count(DISTINCT r) AS n_docs, count(*) AS n_terms FROM w),
l AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM w GROUP BY r),
p AS (SELECT r, term, count(*) AS tf FROM w GROUP BY r, term),
f AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM p, c GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 100 - 90 + ((90 * n * n_docs) // n_terms) AS m FROM l, c),
s AS (
  SELECT item_id, doc_id, m.r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN p USING (term) JOIN f USING (term) JOIN m ON m.r = p.r GROUP BY item_id, doc_id, m.r)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
""".replace("{term}", TERM)
