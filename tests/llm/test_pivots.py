"""Pivot index against all pairs."""

import numpy as np
import pytest

from weftline.llm import pivots
from weftline.llm.common import table


def plain(rows, least=0.93):
    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        return v / np.sqrt((v * v).sum())

    units = [unit(v) for _, v, _ in rows]
    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is None or b is None or len(a) != len(b) or rows[i][0] is None or rows[j][0] is None:
                continue
            if rows[i][2] is None or rows[i][2] != rows[j][2] or float((a * b).sum()) < least:
                continue
            links[i] += 1
            links[j] += 1
            parent[find(i)] = find(j)
    smallest = {}
    for i in range(n):
        if rows[i][0] is not None:
            smallest[find(i)] = min(rows[i][0], smallest.get(find(i), rows[i][0]))
    out = []
    for i in range(n):
        comp = smallest.get(find(i)) if rows[i][0] is not None else None
        out.append((rows[i][0], links[i], comp, rows[i][0] is not None and rows[i][0] == comp))
    return sorted(out, key=repr)


def result(df, **more):
    return sorted((tuple(r) for r in pivots.near_duplicates(df, **more).collect()), key=repr)


def test_documents_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    got = sorted((tuple(r) for r in pivots.op3_pivot_near_duplicates(spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert got == plain(rows)


@pytest.mark.parametrize("tile", [2048, 7])
def test_groups_and_odd_rows(spark, tile):
    rng = np.random.default_rng(1)
    rows, at = [], 100
    for size in (1, 1, 2, 3, 5, 40):
        base = rng.normal(size=16)
        for _ in range(size):
            rows.append((at, (base + rng.normal(size=16) * 0.08).tolist(), at % 2))
            at += 1
    copy = rng.normal(size=16).tolist()
    rows += [(500 + i, copy, 1) for i in range(30)] + [(600, [2 * x for x in copy], 1), (500, copy, 1)]
    rows += [
        (1, None, 1), (2, [0.0] * 16, 1), (3, [float("nan"), *copy[1:]], 1), (4, [None, *copy[1:]], 1), (5, copy, None), (None, copy, 1),
        (6, [float("inf"), *copy[1:]], 1), (7, copy[:8], 1), (8, copy[:8], 1), (9, [], 1), (10, [-0.0, *copy[1:]], 0), (11, [0.0, *copy[1:]], 0),
        (12, [1e300, 1e300], 0), (13, [1e-300, 1e-300], 0),
    ]
    df = spark.createDataFrame([(*r, "k") for r in rows], "vec_id long, embedding array<double>, label int, cid string")
    assert result(df, tile=tile) == plain([r if r[0] not in (12, 13) else (r[0], [1.0, 1.0], 0) for r in rows])


def test_pivots_grow_with_the_table():
    assert [pivots.pivots_for(n, 8) for n in (0, 9_000_000, 10_000_000, 38_000_000, 39_000_000, 150_000_000, 10**10)] == [
        1024, 1024, 2048, 2048, 4096, 4096, 8192
    ]


@pytest.mark.parametrize(("expected", "least"), [(512, 0.97), (0.02, 0.96)])
def test_recall_at_the_limit(spark, monkeypatch, expected, least):
    monkeypatch.setattr(pivots, "EXPECTED", expected)  # the second: 4,096 pivots are asked for, all that are apart are taken
    assert pivots.pivots_for(3000, 8) == (1024 if expected > 1 else 4096)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    r = rng.normal(size=x.shape)
    r -= (r * x).sum(1)[:, None] * x
    r /= np.linalg.norm(r, axis=1)[:, None]
    y = 0.9301 * x + np.sqrt(1 - 0.9301**2) * r
    rows = [(i, v.tolist(), 0) for i, v in enumerate([*x, *y])]
    got = result(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    links = sum(r[1] for r in got)
    assert least * 3000 <= links <= 3000
    assert all(r[1] <= 1 for r in got)


def test_empty_table(spark):
    assert result(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")) == []


@pytest.mark.parametrize("numbers", [1 << 24, 0])
def test_rare_lengths(spark, monkeypatch, numbers):
    # far more classes than sampled rows: of lengths 8 and 5 none, or few, are among the lowest hashes; without numbers left, none is sampled
    monkeypatch.setattr(pivots, "SAMPLE_NUMBERS", numbers)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).tolist(), i % 2) for i in range(120)]
    for size, at in ((8, 200), (5, 300)):
        base = rng.normal(size=size)
        rows += [(at + i, (base + rng.normal(size=size) * 0.02).tolist(), 1) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = result(df, sample=4, tile=7)
    assert got == plain(rows)
    assert sorted(r[1] for r in got if r[0] >= 200) == [3] * 8
