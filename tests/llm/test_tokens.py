"""Token counts and piece codes against the libraries."""

import gc
import random
import sys
import tracemalloc

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm import pieces, token_counts
from weftline.llm.common import table

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_tokens string"
ODD = [
    (1, None, "x"), (2, "", "x"), (3, " ", "x"), (4, "a<|endoftext|>b <|endoftext|><|endoftext|>", "x"), (5, "it's \t\n x", "x"),
    (6, "a\x1c\x85b  　 c☃𝒳é ǅ", "x"), (6, "a\x1c\x85b  　 c☃𝒳é ǅ", "x"), (None, "no id", "x"),
    (7, "thenght" * 30_000, "x"), (8, "word " * 30_000, "x"), (9, "▁a ▁", "x"), (10, "12.5% of (x)!\nNext line…", "x"),
]


def test_counts_match_the_library(spark):
    tokenizer = Tokenizer.from_file(BPE)
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", F.lit("x").alias("n_tokens"))
    docs = docs.unionByName(spark.createDataFrame(ODD, SCHEMA))
    got = sorted(token_counts.token_counts(docs, BPE, frequent=500, cache=300).collect(), key=repr)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = [(i, len(t.encode()), len(tokenizer.encode(t, add_special_tokens=False).ids)) for i, t in texts]
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: f"Row(doc_id={r[0]}, n_bytes={r[1]}, n_tokens={r[2]})")


def test_random_texts_split_as_the_library_does():
    tokenizer, lengths = Tokenizer.from_file(BPE), token_counts.Lengths(BPE, {}, 1000)
    rng = random.Random(1)
    marks = "abAB é'stredlmv  \n\t\r\x0b\x0c\x1c\x1f\x85\xa01²½٣.,!-_<|>endoftx☃日本 　​😀ǅʰ́"
    for _ in range(4000):
        text = "".join(rng.choice(marks) for _ in range(rng.randint(0, 14)))
        assert lengths.count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_codes_match_the_library_and_come_back(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", F.lit("x").alias("n_tokens"))
    docs = docs.unionByName(spark.createDataFrame(ODD, SCHEMA))
    coded = pieces.encode(docs, MODEL, check=True, cache=500)
    got = sorted(((r.doc_id, r.ids) for r in coded.collect()), key=repr)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert got == sorted(((i, model.encode(t)) for i, t in texts), key=repr)
    assert coded.where("not same").count() == 0
    back = sorted(((r.doc_id, r.text) for r in pieces.decode(coded, MODEL).collect()), key=repr)
    assert back == sorted(((i, t.replace("▁", " ")) for i, t in texts), key=repr)


def test_paths_are_committed_early_and_exactly():
    model, coder = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.Coder(MODEL)
    rng = random.Random(2)
    for every in (1, 3, 16, 64):
        for _ in range(20):
            text = "".join(rng.choice("thein ga sor𝒳") for _ in range(200))
            stretch = pieces.SPACE + text.replace(" ", pieces.SPACE)
            want = [p for p in model.encode(text, out_type=str) if not p.startswith("<0x")]
            assert [p for p in coder.stream(stretch, every) if p != "𝒳"] == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert token_counts.token_counts(none, BPE).collect() == []
    assert pieces.encode(none, MODEL).collect() == []


def test_caches_of_a_worker_stay_small():
    """Many different words, as in a large table: what the coder keeps of them is bounded in bytes, and ids stay right."""
    model, coder = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.Coder(MODEL, cache=1 << 15)
    rng = random.Random(3)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(9)) + rng.choice(["", "", ",", "é", "☃"]) for _ in range(40_000)]
    gc.collect()
    tracemalloc.start()
    for text in [" ".join(words[i : i + 200]) for i in range(0, len(words), 200)]:
        coder.encode(text)
    coder._agrees.clear()  # not of words
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept + 41 * (1 << 15) < 4_000_000
    for text in [" ".join(rng.choices(words, k=300)) for _ in range(40)]:
        assert np.frombuffer(coder.encode(text), np.int32).tolist() == model.encode(text)


def test_two_words_of_one_hash_keep_their_ids_apart():
    coder = pieces.Coder(MODEL, cache=4)
    first, other = coder._ids(pieces.SPACE + "the"), coder._ids(pieces.SPACE + "of")
    coder._seen.put(12345, first)
    assert coder._seen.get(12345, pieces.SPACE + "the") == first != other
    assert coder._seen.get(12345, pieces.SPACE + "of") is None


def test_new_words_are_searched_together():
    """Words that were never met, where most of the time goes in a large table: few calls each, not some for each character."""
    model, coder = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.Coder(MODEL)
    rng, calls = random.Random(4), [0]
    parts = ["the", "ing", "tion", "and", "er", "ou", "é", "st", "ent", "aux", "en", "ß"]
    words = ["".join(rng.choices(parts, k=5)) + rng.choice(["", ".", ",", "%%%"]) for _ in range(12_000)]
    words = [*dict.fromkeys(words)]
    coder.encode(" ".join(words[:6000]))

    def count(frame, event, arg):
        calls[0] += event in ("call", "c_call")

    sys.setprofile(count)
    got = coder.encode(" ".join(words[6000:]))
    sys.setprofile(None)
    assert np.frombuffer(got, np.int32).tolist() == model.encode(" ".join(words[6000:]))
    assert calls[0] < 10 * len(words[6000:])


def test_blanks_line_ends_and_long_words_in_steps_and_blocks(monkeypatch):
    """Texts taken together, and one text taken block by block, have the library's ids; long words are not kept."""
    monkeypatch.setattr(pieces, "STEP_BYTES", 200)
    monkeypatch.setattr(pieces, "PER_SEARCH", 300)
    model, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(5)
    marks = "abAB é'stredlmv    \n\n\t\r\x0b\x85\xa0\x00²½.,!-_<>☃日本　😀▁\ufeff"
    texts = [None, "", "\n", " ", "  \n ", "\n\n a", "a  \n", "x" * 65, " " * 70 + "b", "\n" + "y" * 70]
    texts += ["▁", "▁\n▁▁", "\x00", "the " * 300]
    texts += ["".join(rng.choices(marks, k=rng.randint(0, 40))) for _ in range(1500)]
    texts += ["".join(rng.choices("the  ing\nan ", k=900)) for _ in range(10)]
    want = [model.encode(t or "") for t in texts]
    for cache in (60, 400_000):
        coder = pieces.Coder(MODEL, cache)
        got = [p for i in range(0, len(texts), 100) for p in coder.encode_all(texts[i : i + 100])]
        assert [np.frombuffer(p, np.int32).tolist() for p in got] == want
        assert [np.frombuffer(coder.encode(t), np.int32).tolist() for t in texts] == want
        assert max(map(len, [*coder._words, *coder._words_before])) <= 64


def test_numbers_by_key():
    """Keys that meet in one place keep their numbers; a full store starts anew."""
    numbers, rng = pieces.Numbers(1000, np.int8), np.random.default_rng(6)
    keys = rng.choice(1 << 40, 1500, replace=False)
    numbers.put(keys[:1000], (keys[:1000] % 100).astype(np.int8))
    assert (numbers.get(keys) == np.where(np.arange(1500) < 1000, keys % 100, -1)).all()
    numbers.put(keys[1000:], (keys[1000:] % 100).astype(np.int8))
    assert (numbers.get(keys) == np.where(np.arange(1500) < 1000, -1, keys % 100)).all()
