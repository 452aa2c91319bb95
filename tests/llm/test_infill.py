"""Fill-in-middle against slices of plain lists."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from weftline.llm import infill

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"


def plain(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) from lists of tokens."""
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_boundary_set_selects_what_a_list_has():
    rng = np.random.default_rng(1)
    sets = [
        np.array([0]),
        np.array([5, 65535, 65536, 131072, 2**40]),
        np.arange(200_000),
        np.unique(rng.integers(0, 1 << 16, 40_000)),
        np.unique(rng.integers(0, 1 << 22, 50_000)),
        np.r_[np.arange(10, 9000), np.unique(rng.integers(70_000, 131_072, 30_000)), np.arange(140_000, 140_050)],
    ]
    kinds = set()
    for positions in sets:
        found = infill.BoundarySet(positions)
        kinds |= {type(c) for c in found.containers}
        assert len(found) == len(positions)
        for k in {0, len(positions) - 1, *rng.integers(0, len(positions), 300).tolist()}:
            assert found.select(k) == positions[k]
        for k in (-1, len(positions)):
            with pytest.raises(IndexError):
                found.select(k)
    assert kinds == {infill.ArrayContainer, infill.BitmapContainer, infill.RunContainer}


def test_boundaries_of_random_texts():
    rng = random.Random(2)
    for _ in range(300):
        texts = [
            None if rng.random() < 0.1 else "".join(rng.choice(["a", "é", "日本", "😀", " ", "\n", "\t ", "\x0b", "\x85", " ", "<P"]) for _ in range(rng.randint(0, 12)))
            for _ in range(6)
        ]
        ends = infill.boundaries(pa.array(texts, pa.string()))
        want = [np.cumsum([0, *map(len, UNITS.findall(t or ""))]).tolist() for t in texts]
        assert [e.tolist() for e in ends] == want


def test_rows_of_every_kind(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "\n\t", "one", " one ", "a <P> b", "a<S>", "<M>", "a< S><P", "é日 😀\x85 x\x0b", "w " * 150_000, "x" * 200_000]
    texts += ["".join(rng.choice(["ab", "é", " ", "\n", "<", "S>", "P", "M>"]) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    rows = [(i // 2, t, "k", i) for i, t in enumerate(texts + texts)] + [(None, "no id here", None, 0), (7, "same row", "k", 1), (7, "same row", "k", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, other int")
    got = infill.fill_in_middle(docs, keep=["other", "text"])
    found = got.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    with pytest.raises(ValueError, match="form"):
        infill.fill_in_middle(docs, keep=["form"])
    assert infill.fill_in_middle(docs.limit(0)).collect() == []


def test_matches_sql(spark):
    assert difference(spark, connect(SF_DIR), SF_DIR, infill.op13_fill_in_middle, infill.OP13_SQL) is None
