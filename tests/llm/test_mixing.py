"""Mixture: targets against a plain loop, words taken, ties and edges."""

import re
from collections import defaultdict
from fractions import Fraction

from weftline.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WEIGHTS = [3, 1, 2]


def targets(sizes, share=Fraction(3, 2), epochs=2):
    """Pour by weight, cap, and share the excess again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    full, left = set(), share * sum(sizes.values())
    while True:
        rest = [s for s in order if s not in full]
        pool = left - sum(epochs * sizes[s] for s in full)
        goal = {s: pool * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if goal[s] >= epochs * sizes[s]}
        if not over or not rest:
            return {s: float(goal[s]) if s in goal else float(epochs * sizes[s]) for s in order}
        full |= over


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, source string, target int")
    got = mixing.mix(docs, weights=WEIGHTS).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    want, taken = targets(sizes), defaultdict(int)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len(WORD.findall(t or ""))) for i, t, _ in rows)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    again = mixing.mix(docs, weights=WEIGHTS).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_sources_of_all_sizes(spark):
    rows = [(i, "w " * (i % 9), f"s{i % 3}") for i in range(120)]
    rows += [(1000 + i, "hot word " * 20, "s0") for i in range(150)] + [(2000, "lone text", "tiny"), (2001, "a b c", None), (2002, None, None)]
    rows += [(2003, None, "empty"), (2004, "", "empty"), (None, "no id here", "s1"), (5, "again", "s2"), (5, "again", "s2"), (2005, "ab " * 40_000, "é")]
    check(spark, rows)


def test_one_source_no_words_and_empty(spark):
    check(spark, [(1, "a b c", "x"), (2, "d", "x")])
    check(spark, [(1, None, "x"), (2, "", None)])
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs, weights=WEIGHTS).collect() == []


def test_many_sources_join_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    check(spark, [(i, "w " * (1 + i % 5), f"s{i % 40}") for i in range(200)])


def test_kept_columns_do_not_change_the_mix(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 4}", i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, more int")
    plain = {r.doc_id: r.taken for r in mixing.mix(docs, weights=WEIGHTS).collect()}
    kept = mixing.mix(docs, weights=WEIGHTS, keep=["more", "text"]).collect()
    assert {r.doc_id: r.taken for r in kept} == plain and all(r.more == r.doc_id for r in kept)
