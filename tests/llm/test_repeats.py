"""Repetition measures against plain loops."""

import random
import re

import numpy as np
import pyarrow as pa

from weftline.llm import repeats
from weftline.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text, min_words):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    lines, seen = 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(n - 2)]
    twice = {w for w in windows if windows.count(w) > 1} if n < 400 else {
        w for w, c in __import__("collections").Counter(windows).items() if c > 1
    }
    in_windows = {i + k for i, w in enumerate(windows) if w in twice for k in range(3)}

    def repeat(k):
        found = {}
        for i in range(n - k + 1):
            found.setdefault(tuple(words[i : i + k]), []).append(i)
        return [i for at in found.values() if len(at) > 1 for i in at]

    longest = 0
    low, high = 0, n
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if repeat(middle) else (low, middle - 1)
    longest = low
    covered = {i + k for i in repeat(min_words) for k in range(min_words)} if n >= min_words else set()
    symbols = sum(c in "#*$%&|<>" for c in text)
    return [n, sum(map(len, words)), symbols, lines, len(in_windows), len(covered), longest]


def check(texts, min_words):
    got = np.array(repeats.measure(pa.array(texts, pa.string()), min_words)).T.tolist()
    assert got == [plain(t, min_words) for t in texts]


def test_random_texts():
    rng = random.Random(3)
    for _ in range(60):
        texts = [
            None if rng.random() < 0.1 else "".join(rng.choice(["a ", "b ", "c\n", "é ", "#x ", "\t"]) for _ in range(rng.randint(0, 40)))
            for _ in range(8)
        ]
        check(texts, rng.choice([2, 3, 5]))


def test_long_repeats_and_edges():
    check([None, "", " ", "a", "a a", "a " * 700, "a b " * 300, ("x y z w v " * 20 + "\n") * 5, "a b c", "a b c"], 10)
    check([], 10)
    check([None, None], 10)


def test_query_matches_loops(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r for r in repeats.op8_repetition(spark, "/root/testdata/sf0.001").collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        want = plain(r.text, 10)
        g = got[r.doc_id]
        assert [g[f.split()[0]] for f in repeats.FIELDS.split(", ")] == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert g.base_failed == failed
        assert g.kept == (not failed and want[5] <= 0.3 * want[0] and want[6] <= 100)


def test_clashing_columns_and_empty_table(spark):
    rows = [(1, "a b " * 60, "k"), (1, "a b " * 60, "k"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    assert sorted((r.doc_id or 0, r.longest_repeat, r.kept) for r in repeats.repetition(docs).collect()) == [
        (0, 0, False), (1, 118, False), (1, 118, False),
    ]
    assert repeats.repetition(docs.limit(0)).collect() == []
