"""Language identification by prediction with partial matching over bytes.

Each language has a tree of contexts of 0 to `order` bytes with the counts of the bytes that followed. A byte costs
-log2(c / (n + d)) bits in the longest context seen, where n bytes of d kinds followed and this one c times; if it never did,
leaving the context costs -log2(d / (n + d)) and the next shorter context goes on, down to 8 bits for any byte. Counts are
frozen after training, so the code length of a text in a language is a plain sum, and the shortest code wins.

Training takes at most `max_docs` labelled rows per language, those with the lowest hash of doc_id; they are learnt whole.
For all contexts with their bytes that any language has seen, the code length per language is worked out once. So scoring
looks up the longest context with its byte and goes down only where no language knows it.

Rules. Languages are the labels met in training; ties go to the first by code point. Text that is null or has no letter is
`und` with score 0, and so is everything if nothing was learnt. Otherwise score is the winner's share of the probability,
with code lengths divided by the bytes and scaled by `sharpness`, so that it does not depend on length. A row without doc_id
is never learnt and not held out. Rows that repeat count each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import arrow_map, steps, table
from weftline.llm.words import text_bytes

_LETTER = regex.compile(r"\p{L}")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def remainder(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string")) % 4


def training_rows(docs: DataFrame, max_docs: int) -> DataFrame:
    """lang, text of the rows to learn: a bounded number per language, cut on the map side before the shuffle."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id")) != 2))
    light = usable.select("lang", "doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("_h"))
    # first within 64 parts of a language, then among those that are left: a common language is never one group
    in_part = Window.partitionBy("lang", F.pmod("_h", F.lit(64))).orderBy("_h", "doc_id")
    light = light.withColumn("_r", F.row_number().over(in_part)).where(F.col("_r") <= max_docs)
    first = Window.partitionBy("lang").orderBy("_h", "doc_id")
    chosen = light.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= max_docs)
    # at most max_docs ids per language
    return usable.join(F.broadcast(chosen.select("lang", "doc_id").distinct()), ["lang", "doc_id"]).select("lang", "text")


def windows(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Each position's last `width` bytes as one number, the length in the lowest place; shorter at the start of a text."""
    keys = np.zeros(len(data), np.uint64)
    depth = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(width):
        moved = np.zeros(len(data), np.uint64)
        moved[back:] = data[: len(data) - back] if back else data
        keys |= np.where(depth >= back, moved + np.uint64(1), np.uint64(0)) << np.uint64(9 * back)
    return keys


def _tree_counts(batches, order: int):
    """Counts of each context with its byte, for every length, of a task's texts."""
    for batch in batches:
        for part in steps(batch):
            langs = part.column("lang").to_pylist()
            data, offsets = text_bytes(part.column("text"))
            keys = windows(data, offsets, order + 1)
            rows = ([], [], [])
            for lang in sorted(set(langs)):
                spans = [keys[offsets[i] : offsets[i + 1]] for i, x in enumerate(langs) if x == lang]
                mine = np.concatenate(spans)
                for width in range(1, order + 2):
                    mask = np.uint64((1 << (9 * width)) - 1)
                    full = mine[(mine >> np.uint64(9 * (width - 1))) > 0] & mask
                    values, counts = np.unique(full, return_counts=True)
                    rows[0].extend([lang] * len(values))
                    rows[1].append(values.astype(np.int64))
                    rows[2].append(counts.astype(np.int64))
            if rows[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0]), pa.array(np.concatenate(rows[1])), pa.array(np.concatenate(rows[2]))],
                    ["lang", "key", "n"],
                )


def _width(keys: np.ndarray) -> np.ndarray:
    """How many bytes a key holds."""
    out = np.zeros(len(keys), np.int64)
    while (live := keys > 0).any():
        out += live
        keys = keys >> np.uint64(9)
    return out


class Trees:
    """Frozen code lengths of all languages: by width, keys with a row of costs, and contexts with a row of exits."""

    def __init__(self, langs: list[str], keys: np.ndarray, lang: np.ndarray, counts: np.ndarray, order: int):
        self.langs, self.order = langs, order
        self.costs: list[tuple] = [()]
        self.exits: list[tuple] = []
        width = _width(keys)
        shorter = np.full((1, len(langs)), 8.0)  # of any byte in no context
        shorter_keys = np.zeros(1, np.uint64)
        for w in range(1, order + 2):
            here = width == w
            every, at = np.unique(keys[here], return_inverse=True)
            seen = np.zeros((len(every), len(langs)))
            seen[at, lang[here]] = counts[here]
            contexts, of = np.unique(every >> np.uint64(9), return_inverse=True)
            total, kinds = np.zeros((len(contexts), len(langs))), np.zeros((len(contexts), len(langs)))
            np.add.at(total, of, seen)
            np.add.at(kinds, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                exits = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                direct = -np.log2(seen / (total + kinds)[of])
            if w == 1:
                below = np.full((len(every), len(langs)), 8.0)
            else:  # the same byte in the next shorter context is in the tree too
                tail = every & np.uint64((1 << (9 * (w - 1))) - 1)
                below = shorter[np.searchsorted(shorter_keys, tail)]
            costs = np.where(seen > 0, direct, exits[of] + below)
            self.costs.append(_lookup(every, costs))
            self.exits.append(_lookup(contexts, exits))
            shorter, shorter_keys = costs, every

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text in each language."""
        keys = windows(data, offsets, self.order + 1)
        total = np.zeros((len(data), len(self.langs)), np.float32)
        left = np.arange(len(data))
        top = _width_at(data, offsets, self.order + 1)
        for w in range(self.order + 1, 0, -1):
            mine = left[top[left] >= w]
            cut = keys[mine] & np.uint64((1 << (9 * w)) - 1)
            row = _find(self.costs[w], cut)
            hit = row >= 0
            total[mine[hit]] += self.costs[w][2][row[hit]]
            missed, cut = mine[~hit], cut[~hit] >> np.uint64(9)
            row = _find(self.exits[w - 1], cut)
            known = row >= 0
            total[missed[known]] += self.exits[w - 1][2][row[known]]
            done = np.zeros(len(data), bool)
            done[mine[hit]] = True
            left = left[~done[left]]
        total[left] += np.float32(8.0)
        sums = np.zeros((len(data) + 1, len(self.langs)))
        np.cumsum(total, axis=0, dtype=np.float64, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]


def _width_at(data: np.ndarray, offsets: np.ndarray, most: int) -> np.ndarray:
    depth = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    return np.minimum(depth + 1, most)


def _lookup(keys: np.ndarray, rows: np.ndarray) -> tuple:
    """Open addressing: (slots with keys plus one, slot -> row, rows, shift)."""
    bits = max(4, int(len(keys) * 2).bit_length())
    shift = np.uint64(64 - bits)
    slots, at = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
    todo = np.arange(len(keys))
    place = ((keys * _MULTIPLIER) >> shift).astype(np.int64)
    while len(todo):
        free = slots[place[todo]] == 0
        first = np.full(len(slots), -1, np.int64)
        first[place[todo[free]][::-1]] = todo[free][::-1]
        won = todo[free][first[place[todo[free]]] == todo[free]]
        slots[place[won]] = keys[won] + np.uint64(1)
        at[place[won]] = won
        taken = np.zeros(len(keys), bool)
        taken[won] = True
        todo = todo[~taken[todo]]
        place[todo] = (place[todo] + 1) & (len(slots) - 1)
    return slots, at, rows.astype(np.float32), shift


def _find(lookup: tuple, keys: np.ndarray) -> np.ndarray:
    """Row of each key, -1 if there is none."""
    slots, at, _, shift = lookup
    out = np.full(len(keys), -1, np.int64)
    place = ((keys * _MULTIPLIER) >> shift).astype(np.int64)
    want = keys + np.uint64(1)
    held = slots[place]
    same = held == want
    out[same] = at[place[same]]
    todo = np.flatnonzero(~same & (held != 0))
    while len(todo):
        place[todo] = (place[todo] + 1) & (len(slots) - 1)
        held = slots[place[todo]]
        same = held == want[todo]
        out[todo[same]] = at[place[todo[same]]]
        todo = todo[~same & (held != 0)]
    return out


def train(docs: DataFrame, *, order: int = 4, max_docs: int = 300) -> Trees:
    """Context trees of a bounded sample; the driver gets the summed counts of that sample alone."""
    counted = arrow_map(training_rows(docs, max_docs), lambda it: _tree_counts(it, order), "lang string, key long, n long")
    summed = counted.groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(summed.column("lang").to_pylist()), key=lambda x: x.encode())
    number = {x: i for i, x in enumerate(langs)}
    lang = np.array([number[x] for x in summed.column("lang").to_pylist()], np.int64)
    keys = summed.column("key").to_numpy().astype(np.uint64)
    return Trees(langs, keys, lang, summed.column("n").to_numpy(), order)


def predict(docs: DataFrame, trees: Trees, *, sharpness: float = 8.0, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """lang_pred, score, bits (per byte, of the winner) after the columns of `keep`, which are handed on unread: one row per
    row of docs. Only text is read."""
    results = ["lang_pred", "score", "bits"]
    if clash := set(keep) & set(results):
        raise ValueError(f"columns {sorted(clash)} would appear twice")
    narrow = docs.select(*dict.fromkeys([*keep, "text"]))
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        trees = sent.value
        for batch in batches:
            for part in steps(batch):
                texts = part.column("text")
                data, offsets = text_bytes(texts)
                ok = np.array([bool(t and _LETTER.search(t)) for t in texts.to_pylist()], bool) & bool(trees.langs)
                names, scores, bits = ["und"] * len(ok), np.zeros(len(ok)), np.full(len(ok), np.nan)
                if ok.any():
                    per = trees.code_lengths(data, offsets) / np.maximum(np.diff(offsets), 1)[:, None]
                    best = per.argmin(axis=1)
                    least = per.min(axis=1)
                    share = 1 / np.exp2(-sharpness * (per - least[:, None])).sum(axis=1)
                    names = [trees.langs[b] if o else "und" for b, o in zip(best.tolist(), ok.tolist(), strict=True)]
                    scores, bits = np.where(ok, share, 0.0), np.where(ok, least, np.nan)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in keep),
                        pa.array(names, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(bits, pa.float64(), from_pandas=True),
                    ],
                    [*keep, *results],
                )

    added = T.StructType.fromDDL("lang_pred string, score double, bits double")
    return narrow.mapInArrow(run, T.StructType(narrow.select(*keep).schema.fields + added.fields))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, learnt from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    return predict(docs, train(docs)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
