"""Jaccard components against all pairs on small tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import jaccard
from weftline.llm.common import table
from weftline.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text, n=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def plain(rows, percent=75):
    """doc_id, set size and component of rows (doc_id, text); every pair is compared."""
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if 100 * min(len(sets[i]), len(sets[j])) < percent * max(len(sets[i]), len(sets[j])):
                continue
            shared = len(sets[i] & sets[j])
            if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(d, len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def same(spark, rows, docs=None):
    docs = docs if docs is not None else spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, fp string")
    got = [tuple(r) for r in jaccard.jaccard_join(docs).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_documents(spark, sf):
    docs = table(spark, f"/root/testdata/sf{sf}", "documents")
    same(spark, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], docs)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"z{rng.randrange(99999)}"
    return " ".join(out)


def test_chains_groups_and_edges(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(900, None), (901, ""), (902, " \n"), (903, "A b c"), (904, "a B c"), (905, "a b"), (None, "a b c"), (906, "x" * 5000)]
    passage = " ".join(f"p{i}" for i in range(60))
    for g in range(12):
        base = [f"w{g}_{i}" for i in range(rng.choice([6, 20, 60, 150]))]
        for k in range(rng.choice([2, 5, 25])):
            # each from the one before: chains in which the ends do not link
            rows.append((g * 50 + k, " ".join(base)))
            base = edited(rng, base, rng.choice([0, 1, 1, 2, 4])).split()
    rows += [(1000 + i, f"{passage} " + " ".join(f"q{rng.randrange(9**6)}" for _ in range(rng.choice([5, 10, 14, 16, 30])))) for i in range(40)]
    rows.append(rows[20])
    rng.shuffle(rows)
    same(spark, rows)
    monkeypatch.setattr(jaccard, "PER_SHINGLE", 2)  # every list is dealt over several partitions
    monkeypatch.setattr(jaccard, "PER_FLUSH", 50)
    same(spark, rows)


def frames(monkeypatch):
    """Names and frames of all that the join writes from here on."""
    kept, written = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda df, name: kept.append((name, out := written(df, name))) or out)
    return kept


def test_classes_of_pairs_are_written_in_less_than_their_hashes(spark, monkeypatch):
    rng, kept = random.Random(7), frames(monkeypatch)
    rows, vocabulary = [], ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(1500)]
    for i in range(0, 120, 2):
        text = rng.choices(vocabulary, k=600)
        rows += [(i, " ".join(text)), (i + 1, edited(rng, text, 3))]
    for i in range(200, 210, 2):  # few and long words: their hashes are shorter
        text = [f"{rng.getrandbits(4000):x}" for _ in range(40)]
        rows += [(i, " ".join(text)), (i + 1, " ".join([*text, "more"]))]
    same(spark, rows)
    sizes = {}
    for name, out in kept:
        for column in (c for c, kind in out.dtypes if kind == "binary" and c != "counts"):
            sizes[name] = max(sizes.get(name, 0), out.agg(F.sum(F.octet_length(column))).first()[0] or 0)
    shingles = sum(len(plain_set(t)) for _, t in rows)
    assert shingles < max(sizes.values()) < 4 * shingles, sizes


def test_pairs_that_share_a_rare_line_only_are_not_verified(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "shingle_levels", lambda profile: np.zeros(1 << jaccard.ORDER_BITS, np.uint8))
    rng, kept, rows = random.Random(8), frames(monkeypatch), []
    for i in range(0, 80, 2):
        line = [f"line{i}_{j}" for j in range(7)]
        rows += [(i + k, " ".join([*line, *(f"w{rng.randrange(9**9)}" for _ in range(300))])) for k in range(2)]
    same(spark, rows)
    counts = {name: out.count() for name, out in kept if name in ("jaccard-shared", "jaccard-stars", "jaccard-pairs")}
    assert counts.pop("jaccard-shared") > 20 and counts == {"jaccard-stars": 0, "jaccard-pairs": 0}


def test_other_pairs_keep_all_that_link(spark):
    rng, rows, links = random.Random(9), [], set()
    sets = []
    for _ in range(60):
        base = rng.sample(range(3000), rng.choice([4, 9, 30, 70, 150]))
        for _ in range(4):
            lost = rng.randint(0, len(base) // 6 + 1)
            sets.append(sorted({*base[lost:], *rng.sample(range(3000, 6000), rng.randint(0, len(base) // 6 + 1))}))
    for fp, one in enumerate(sets):
        rows += [(s, fp, len(one), i, fp) for i, s in enumerate(one[: jaccard.prefix_length(len(one), 75)])]
        for other in range(fp):
            shared = len({*one} & {*sets[other]})
            if 100 * shared >= 75 * (len(one) + len(sets[other]) - shared):
                links.add((other, fp))
    lists = Counter(r[0] for r in rows)
    rows = [r for r in rows if lists[r[0]] > 1]
    rest = spark.createDataFrame(rows, "shingle long, fp long, n int, pos int, _comp long")
    got = [tuple(r) for r in jaccard.other_pairs(rest, 75).collect()]
    assert len(links) > 100 and links <= set(got) and len(got) == len(set(got))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_join(docs).collect() == []


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(5, 5), (3, 2), (2, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 7 for i in range(8, 60)} | {3: 2}
    assert got == want
