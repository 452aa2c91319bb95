"""Quality rules on repetition: suffix arrays of whole texts, longest-common-prefix intervals, covered fraction.

The words of each text get a suffix array by prefix doubling, for all texts of a step at once: ranks start as (text, word), so
no suffix is compared across texts, and only suffixes whose rank is still shared are sorted again. The ranks of every round
are kept; they give the longest common prefix of neighbours in the array by binary descent. The longest repeat at a suffix
is the longer of its two neighbours' prefixes; these are the ends of the LCP intervals, and every maximal repeated substring
begins at such a suffix. Spans of at least `min_words` words are united; a text is kept if they cover at most `max_fraction`
of its words and the longest repeat has at most `max_longest` words.

Rules. Words are equal if their 64-bit hashes are. Null text has no words. Overlapping occurrences count. Lines end at \\n
alone, and a line counts as repeated if it has a word and equals an earlier one to the byte. `base_failed` is true for fewer
than 50 words, or if words in three-word windows found twice or more make up more than half. Rows that repeat are judged
each; an empty table gives no rows. A step holds about 1 MB of text, or one longer text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import arrow_map, steps, table
from weftline.llm.words import Words, runs, words

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _dense(keys: np.ndarray) -> np.ndarray:
    """Ranks of equal keys in sorted order."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def suffix_ranks(symbols: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """ranks[k][i] orders the first 2**k symbols from i on within i's text; the last list has no equals in a text."""
    n = len(symbols)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    rank = _dense(symbols)
    order = np.lexsort((rank, owner))
    change = np.ones(n, bool)
    change[1:] = (rank[order][1:] != rank[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(change, np.arange(n), 0))  # first place of its group
    ranks, step = [rank], 1
    sizes = np.bincount(rank, minlength=n)
    open_ = np.flatnonzero(sizes[rank] > 1)
    while len(open_):
        after = open_ + step
        second = np.full(len(open_), -1, np.int64)
        inside = after < ends[open_]
        second[inside] = rank[after[inside]]
        by = np.lexsort((second, rank[open_]))
        sorted_, first, then = open_[by], rank[open_][by], second[by]
        new_group = np.ones(len(by), bool)
        new_group[1:] = first[1:] != first[:-1]
        new = new_group.copy()
        new[1:] |= then[1:] != then[:-1]
        place = np.arange(len(by))
        begin = np.maximum.accumulate(np.where(new_group, place, 0))
        head = np.maximum.accumulate(np.where(new, place, 0))
        rank = rank.copy()
        rank[sorted_] = first + (head - begin)
        ranks.append(rank)
        sizes = np.bincount(rank[sorted_], minlength=n)
        open_ = sorted_[sizes[rank[sorted_]] > 1]
        step *= 2
    return ranks


def longest_repeats(ranks: list[np.ndarray], bounds: np.ndarray) -> np.ndarray:
    """For each place, the length of the longest substring from it that occurs elsewhere in its text too."""
    n = len(ranks[0])
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    array = np.empty(n, np.int64)
    array[ranks[-1]] = np.arange(n)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    ends = np.repeat(bounds[1:], np.diff(bounds))
    a, b = array[:-1].copy(), array[1:].copy()
    left, right = array[:-1], array[1:]
    length = np.zeros(n - 1, np.int64)
    live = owner[a] == owner[b]
    for k in range(len(ranks) - 1, -1, -1):
        at = np.flatnonzero(live)
        same = at[ranks[k][a[at]] == ranks[k][b[at]]]
        length[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
        live[same] = (a[same] < ends[left[same]]) & (b[same] < ends[right[same]])
    np.maximum.at(best, left, length)
    np.maximum.at(best, right, length)
    return best


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in a span."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + lengths, -1)
    return np.cumsum(marks[:-1]) > 0


def _sum_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _max_by(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, np.int64)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.maximum.reduceat(values, bounds[:-1][some])
    return out


def repeated_windows(found: Words, n: int = 3) -> np.ndarray:
    """Words of each text in windows of n words that the text holds twice or more."""
    counts, total = found.counts, len(found.hashes)
    every = runs(found.hashes, n)
    owner = found.owners
    places = np.flatnonzero(owner[: len(every)] == owner[n - 1 :]) if len(every) else np.zeros(0, np.int64)
    if not len(places):
        return np.zeros(len(counts), np.int64)
    order = places[np.lexsort((every[places], owner[places]))]
    same = (every[order][1:] == every[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = order[twice]
    return _sum_by(_covered(starts, np.full(len(starts), n), total), found.bounds)


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            n += line in seen
            seen.add(line)
    return n


FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long"
)


def measure(texts: pa.Array, min_words: int) -> list[np.ndarray]:
    """The columns of FIELDS for one step of texts."""
    found = words(texts)
    counts = found.counts
    chars = np.r_[0, np.cumsum((found.data & 0xC0) != 0x80)]  # bytes that begin a character
    symbols = np.r_[0, np.cumsum(_SYMBOL[found.data])]
    per_word = chars[found.ends] - chars[found.starts]
    ranks = suffix_ranks(found.hashes, found.bounds)
    longest = longest_repeats(ranks, found.bounds)
    spans = np.flatnonzero(longest >= min_words)
    covered = _covered(spans, longest[spans], len(found.hashes))
    lines = [duplicate_lines(t) if t else 0 for t in texts.to_pylist()]
    return [
        counts,
        _sum_by(per_word, found.bounds),
        symbols[found.offsets[1:]] - symbols[found.offsets[:-1]],
        np.array(lines, np.int64),
        repeated_windows(found),
        _sum_by(covered, found.bounds),
        _max_by(longest, found.bounds),
    ]


def repetition(
    docs: DataFrame, *, min_words: int = 10, max_fraction: float = 0.3, max_longest: int = 100
) -> DataFrame:
    """doc_id, the columns of FIELDS, base_failed, kept: one row per row of docs."""

    def run(batches):
        for batch in batches:
            for part in steps(batch):
                columns = [pa.array(c.astype(np.int64)) for c in measure(part.column("text"), min_words)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *[f.split()[0] for f in FIELDS.split(", ")]]
    measured = arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, {FIELDS}")
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    good = (F.col("covered_words") <= max_fraction * n) & (F.col("longest_repeat") <= max_longest)
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & good)


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    return repetition(table(spark, sf_dir, "documents"))
