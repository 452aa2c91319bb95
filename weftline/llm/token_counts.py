"""Token counts of a byte-level BPE by a map-side two-tier lookup; no pre-token is ever shuffled.

The count of a text is the sum over its pre-tokens of their lengths in tokens. First tier: a table of frequent pre-tokens
with their lengths, broadcast as two flat arrays. It is found in one pass over all texts: each task keeps bounded counts and
hands on its `summary` most frequent pre-tokens, which are summed and cut to `frequent`. The table only saves work; which
entries it holds never changes a count. Second tier: what the table lacks is encoded by the tokenizer and kept in the
worker's own bounded cache.

Rules. Null text is empty: 0 bytes, 0 tokens. Texts are whole. No begin, end or added tokens; a special token's string
inside a text is one token, as the library has it by default. The split uses the library's own pattern over a range of
characters whose classes have long been settled; a text with any other character is encoded whole by the library. Rows that
repeat are counted each. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import arrow_map, steps, table

#: Fixed: the pre-token pattern of the vocabulary, with white space spelled out.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+|[" + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + "]+"
)
#: Characters whose classes do not depend on the Unicode version of a library.
_UNSETTLED = regex.compile(
    r"[^\x00-\u021f\u0391-\u03a1\u03a3-\u03ce\u0401-\u040c\u040e-\u044f\u0451-\u045c\u045e-\u0481\u05d0-\u05ea\u2010-\u2027"
    r"\u2030-\u203a\u20ac\u2190-\u21ea\u3001\u3002\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]"
)
#: Longer pre-tokens are encoded each time instead of being kept.
_KEEP_CHARS = 64


class Lengths(dict):
    """Pre-token -> number of tokens; starts as the broadcast table, learns misses up to a bound."""

    def __init__(self, path: str, known: dict[str, int], bound: int):
        from tokenizers import Tokenizer

        super().__init__(known)
        self._known, self._bound = known, len(known) + bound
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        specials = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) or r"(?!)")

    def whole(self, text: str) -> int:
        return len(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> int:
        n = self.whole(piece)
        if len(piece) <= _KEEP_CHARS:
            if len(self) >= self._bound:
                self.clear()
                self.update(self._known)
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        if _UNSETTLED.search(text):
            return self.whole(text)
        if not self._special.search(text):
            return sum(map(self.__getitem__, PRE_TOKEN.findall(text)))
        parts = self._special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, PRE_TOKEN.findall(p))) for p in parts)


class _Flat:
    """The frequent table as one string of characters, ends and lengths: a few bytes an entry."""

    def __init__(self, pieces: list[str], lengths: list[int]):
        self.text = "".join(pieces)
        self.ends = np.cumsum([len(p) for p in pieces], dtype=np.int64)
        self.lengths = np.asarray(lengths, np.uint16)

    def known(self) -> dict[str, int]:
        ends = self.ends.tolist()
        return {self.text[a:b]: n for a, b, n in zip([0, *ends], ends, self.lengths.tolist(), strict=False)}


def _summaries(batches, summary: int):
    """The most frequent pre-tokens of a task, from counts that never hold more than 64 times as many."""
    counts: Counter[str] = Counter()
    for batch in batches:
        for part in steps(batch):
            for text in part.column("text").to_pylist():
                if text:
                    counts.update(p for p in PRE_TOKEN.findall(text) if len(p) <= _KEEP_CHARS)
            if len(counts) > 64 * summary:
                counts = Counter(dict(counts.most_common(16 * summary)))
    top = counts.most_common(summary)
    yield pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"]
    )


def frequent_pieces(docs: DataFrame, frequent: int = 65_536, summary: int = 8_192) -> list[str]:
    """At most `frequent` pre-tokens, most frequent first: a bounded list, so it may come to the driver."""
    partial = arrow_map(docs.select("text"), lambda it: _summaries(it, summary), "piece string, n long")
    total = partial.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(frequent)
    return [r.piece for r in total.select("piece").collect()]


def token_counts(docs: DataFrame, path: str, *, frequent: int = 65_536, cache: int = 200_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens: one row per row of docs."""
    pieces = frequent_pieces(docs, frequent)
    encoder = Lengths(path, {}, len(pieces) + 1)
    sent = docs.sparkSession.sparkContext.broadcast(_Flat(pieces, [encoder[p] for p in pieces]))

    def run(batches):
        lengths = Lengths(path, sent.value.known(), cache)
        for batch in batches:
            for part in steps(batch):
                texts = part.column("text")
                n = [lengths.count(t) if t else 0 for t in texts.to_pylist()]
                size = pc.fill_null(pc.cast(pc.binary_length(texts), pa.int64()), 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), size, pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), run, f"doc_id {kind}, n_bytes long, n_tokens long")


def op2_token_counts(spark: SparkSession, sf_dir: str, limit: int = 512) -> DataFrame:
    """All documents, counted with byte_bpe_50k.json."""
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
