"""Ranked search against plain loops and SQL."""

import math
import random
import re
from collections import Counter

from tests.compare import connect, difference
from weftline.llm import ranking

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(ranking.TERM)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(docs, items, top):
    found = [(d, Counter(TERM.findall(lower(t)))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in found)
    n_terms = sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(TERM.findall(lower(t)))
    out = []
    for i, held in wanted.items():
        scores = []
        for d, c in found:
            if d is None or not c:
                continue
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            total = 0
            for t in held & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                total += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if total > 0:
                scores.append((-total, d))
        out += [(i, r, d, -s) for r, (s, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out)


def test_terms_are_the_same_in_any_chunks(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(ranking, "CHUNK", 7)
    for _ in range(500):
        text = "".join(rng.choice("aB9 é日_-\n\x00\x7f\x85Z") for _ in range(rng.randint(0, 60)))
        got = [t.decode() for some in ranking.terms(text.encode()) for t in some]
        assert got == TERM.findall(lower(text))


def test_random_tables(spark):
    rng = random.Random(2)
    words = ["the", "The", "a", "é", "É", "x1", "日本", "word", "rare", "of", "in", "z" * 50]
    text = lambda most: rng.choice([" ", "-", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, most)))
    docs = [(i, text(12), "k", 1) for i in range(60)] + [(200 - i, "the word of", None, 2) for i in range(40)]
    docs += [(None, "rare word", "k", 0), (300, None, "k", 0), (301, "", "k", 0), (302, "...", "k", 0), (7, "rare", "k", 0), (7, "rare", "k", 0)]
    docs += [(400, "the rare " * 100_000, "k", 0)]
    items = [(i, text(6), 5) for i in range(20)] + [(50, "nowhere", 1), (51, None, 1), (52, "", 1), (None, "the", 1), (3, "rare too", 1), (3, "rare too", 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score string, rank int")
    q = spark.createDataFrame(items, "item_id long, text string, doc_id int")
    want = plain([r[:2] for r in docs], [r[:2] for r in items], 10)
    assert sorted(map(tuple, ranking.search(d, q).collect())) == want
    # the same in several blocks of items, and for fewer results
    assert sorted(map(tuple, ranking.search(d, q, top=3, pairs_per_block=12).collect())) == plain([r[:2] for r in docs], [r[:2] for r in items], 3)
    for a, b in ((d.limit(0), q), (d, q.limit(0)), (d.where("text = ''"), q)):
        got = ranking.search(a, b)
        assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_matches_sql(spark):
    assert difference(spark, connect(SF_DIR), SF_DIR, ranking.op11_ranked_search, ranking.OP11_SQL) is None
