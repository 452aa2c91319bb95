"""Fill-in-middle: texts cut at two seeded token boundaries and put in another order, and back.

A token is a run of white space with the word after it, or white space that no word follows. The boundaries of a text, 0 and
the end of every token in code points, form a set laid out as Roaring bitmaps are: one container for every 65,536 positions,
which holds an array, a bitmap or runs, whichever is smallest, and the cumulative cardinalities of the containers. The cut
after k tokens is the k-th member: a binary search over the cumulative cardinalities, then a select inside one container.

The choices of a text hang on its doc_id and the seed alone, so reruns and retries agree: four numbers are read off a SHA-256.
Two give the cuts, one whether the text is changed at all, one the order of the parts.

Rules. Null text is empty. An empty text, and one that holds a mark, stays plain, as nothing could be told apart in it. A
text of white space is one token. A null doc_id counts as an empty number. Rows that repeat give equal rows; an empty table
gives no rows. White space is blank and the five control characters from tab on. A step holds about STEP_BYTES of text, or
one longer text, for which some 40 bytes of scratch a byte are taken.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import arrow_map, steps, table
from weftline.llm.words import text_bytes

SEED = 42
CHANGED_PERCENT = 50
SUFFIX_FIRST_PERCENT = 80

#: Fixed: the marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
RESULTS = "n long, form string, prefix_chars long, middle_chars long, output string"


class ArrayContainer:
    """Up to a few thousand members, as sorted 16-bit numbers."""

    def __init__(self, low: np.ndarray):
        self.values = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """Many members: 65,536 bits in words, with the number of members up to each word's end."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << 16, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.ends = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.ends, k, side="right"))
        word, rest = int(self.words[at]), k - (int(self.ends[at - 1]) if at else 0)
        for _ in range(rest):
            word &= word - 1  # the lowest member goes
        return 64 * at + (word & -word).bit_length() - 1


class RunContainer:
    """Members in few unbroken runs: first members, and the number of members up to each run's end."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.r_[True, np.diff(low) != 1])
        self.starts = low[first].astype(np.uint16)
        self.ends = np.r_[first[1:], len(low)].astype(np.int64)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.ends, k, side="right"))
        return int(self.starts[at]) + k - (int(self.ends[at - 1]) if at else 0)


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container: 2 bytes a member, 8,192 bytes, or 4 bytes a run."""
    n_runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
    sizes = [(2 * len(low), 0, ArrayContainer), (1 << 13, 1, BitmapContainer), (4 * n_runs, 2, RunContainer)]
    return min(sizes)[2](low)


class BoundarySet:
    """Ascending, distinct positions; `select(k)` is the k-th of them, from 0 on."""

    def __init__(self, positions: np.ndarray):
        high = positions >> 16
        starts = np.flatnonzero(np.r_[True, high[1:] != high[:-1]])
        self.keys = high[starts]
        self.ends = np.r_[starts[1:], len(positions)]
        self.containers = [container(positions[a:b] & 0xFFFF) for a, b in zip(starts, self.ends)]

    def __len__(self) -> int:
        return int(self.ends[-1])

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.ends, k, side="right"))
        before = int(self.ends[at - 1]) if at else 0
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - before)


def boundaries(texts: pa.Array) -> list[np.ndarray]:
    """Per text, 0 and the ends of its tokens, in code points."""
    data, offsets = text_bytes(texts)
    space = _SPACE[data]
    chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]  # code points before each byte
    last = ~space
    last[:-1] &= space[1:]
    final = offsets[1:][np.diff(offsets) > 0] - 1
    last[final] = True  # the end of a text ends its last token, be it a word or white space
    ends = np.flatnonzero(last) + 1
    bounds = np.searchsorted(ends, offsets, side="right")
    places = chars[ends]
    return [
        np.r_[0, places[a:b] - chars[at]] for a, b, at in zip(bounds[:-1].tolist(), bounds[1:].tolist(), offsets[:-1].tolist())
    ]


def choices(doc_id, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 from the seed and the doc_id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def cut(text: str, ends: np.ndarray, chosen: tuple[int, int, int, int]) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    n = len(ends) - 1
    h1, h2, h3, h4 = chosen
    if not text or h3 % 100 >= CHANGED_PERCENT or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    cuts = BoundarySet(ends)
    first, second = sorted((cuts.select(h1 % (n + 1)), cuts.select(h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < SUFFIX_FIRST_PERCENT:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, first, second - first, output


def fill_in_middle(docs: DataFrame, *, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """doc_id, n (tokens), form (plain, psm or spm), prefix_chars, middle_chars, output: one row per row of docs.

    `keep` names further columns of docs to hand on; they must not be called like the results.
    """
    kept = [c for c in keep or [] if c != "doc_id"]
    names = [f.split()[0] for f in RESULTS.split(", ")]
    if clash := set(kept) & set(names):
        raise ValueError(f"columns called like results: {sorted(clash)}")

    def run(batches):
        for batch in batches:
            for part in steps(batch, "_text"):
                texts = part.column("_text")
                rows = [
                    cut(text or "", ends, choices(doc_id, seed))
                    for text, ends, doc_id in zip(texts.to_pylist(), boundaries(texts), part.column("doc_id").to_pylist())
                ]
                found = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in ["doc_id", *kept]], *found], ["doc_id", *kept, *names])

    kinds = [pa.int64() if f.endswith("long") else pa.string() for f in RESULTS.split(", ")]
    given = docs.select("doc_id", *kept, F.col("text").alias("_text"))
    schema = ", ".join([f"`{c}` {given.schema[c].dataType.simpleString()}" for c in ["doc_id", *kept]] + [RESULTS])
    return arrow_map(given, run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. The marks stand once each, as no text that is changed holds one."""

    def before(c: Column, mark: str) -> Column:
        return F.substring_index(c, mark, 1)

    def after(c: Column, mark: str) -> Column:
        return F.substring_index(c, mark, -1)

    middle = after(output, MIDDLE)
    parts = before(output, MIDDLE)
    spm = F.concat(after(parts, PREFIX), middle, after(before(parts, PREFIX), SUFFIX))
    psm = F.concat(after(before(parts, SUFFIX), PREFIX), middle, after(parts, SUFFIX))
    return F.when(form == "spm", spm).when(form == "psm", psm).otherwise(output)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; outputs and what is rebuilt from them as digests."""
    cuts = fill_in_middle(table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return cuts.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
t AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
    greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
      THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
