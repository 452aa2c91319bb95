"""Language identification against a plain context tree, and held-out accuracy."""

import math
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from weftline.llm import language
from weftline.llm.common import table


def plain_bits(counts, text, order):
    """Code length with dictionaries: context -> byte -> count."""
    data, bits = text.encode(), 0.0
    for i, byte in enumerate(data):
        for width in range(min(order, i), -1, -1):
            seen = counts.get(data[i - width : i])
            if seen is None:
                continue
            n, d = sum(seen.values()), len(seen)
            if byte in seen:
                bits -= math.log2(seen[byte] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


def plain_counts(texts, order):
    counts = defaultdict(lambda: defaultdict(int))
    for text in texts:
        data = text.encode()
        for i, byte in enumerate(data):
            for width in range(min(order, i) + 1):
                counts[data[i - width : i]][byte] += 1
    return counts


LEARN = [
    (0, "the cat and the hat", "en"), (1, "die katze und der hut", "de"), (3, "is this the end?", "en"),
    (5, "über den fluß", "de"), (7, None, "fr"), (8, "x", None), (9, "the and", "en"), (None, "zz", "xx"),
]
ASK = [(100, "the fluß"), (101, None), (102, ""), (103, "12 34 !"), (104, "ünd the"), (104, "ünd the"), (None, "hat" * 4000)]


def test_code_lengths_match_a_plain_tree(spark):
    train = spark.createDataFrame(LEARN, "doc_id long, text string, lang string")
    trees = language.train(train, order=3)
    kept = [(i, t, x) for i, t, x in LEARN if i is not None and t and x and zlib.crc32(str(i).encode()) % 4 != 2]
    assert trees.langs == sorted({x for *_, x in kept})
    ask = spark.createDataFrame(ASK, "doc_id long, text string").withColumn("lang_pred", F.lit("clash"))
    got = language.predict(ask, trees).collect()
    plain = {x: plain_counts([t for _, t, y in kept if y == x], 3) for x in trees.langs}
    assert len(got) == len(ASK)
    for row in got:
        text = next(t for i, t in ASK if i == row.doc_id)
        if not text or not any(c.isalpha() for c in text):
            assert (row.lang_pred, row.score, row.bits) == ("und", 0.0, None)
            continue
        bits = {x: plain_bits(plain[x], text, 3) / len(text.encode()) for x in trees.langs}
        assert row.lang_pred == min(bits, key=lambda x: (bits[x], x))
        assert row.bits == pytest.approx(min(bits.values()), rel=1e-5)
        assert 0 < row.score <= 1


def test_nothing_learnt(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    trees = language.train(none)
    assert language.predict(none, trees).collect() == []
    ask = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert [r.lang_pred for r in language.predict(ask, trees).collect()] == ["und"]


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = language.op4_language_id(spark, "/root/testdata/sf0.01")
    assert rows.count() == docs.count()
    held = rows.where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    good, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert n > 100 and good > 0.97
