"""The pipeline, stage by stage, against plain loops and the operators' own tests."""

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tests.llm.test_jaccard import plain
from weftline.llm import pieces
from weftline.llm.common import table, written

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    odd = [(9001, None, "en", "src1", 0), (9002, "", None, None, 0), (9003, "1 2 3 !", "en", "src1", 7), (None, "a text without id", "en", None, 17)]
    odd += [(9004, "to be kept one time only, this text here " * 3, "en", "src2", 1)] * 2
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "ngram_jaccard_join", "pii_surrogates", "source_mixture", "sentencepiece_ids"]

    found = written(steps["language_id"](spark, docs, SF), "t")
    assert found.columns == corpus_pipeline.COLUMNS
    ids = [r.doc_id for r in found.collect()]
    gone = {r.doc_id for r in docs.collect() if not any(c.isalpha() for c in r.text or "")}
    assert gone >= {9001, 9002, 9003} and len(ids) == docs.count() - len(gone) and not gone & set(ids)

    single = written(steps["ngram_jaccard_join"](spark, found, SF), "t")
    before = [(r.doc_id, r.text) for r in found.collect()]
    firsts = {i for i, _, c in plain(before) if i is not None and i == c}
    after = [r.doc_id for r in single.collect()]
    assert sorted(i for i in after if i is not None) == sorted(firsts) and after.count(None) == 1

    clean = written(steps["pii_surrogates"](spark, single, SF), "t")
    old, new = {r.doc_id: r.text for r in single.collect()}, {r.doc_id: r for r in clean.collect()}
    assert old.keys() == new.keys() and all(r.n_chars == len(r.text) for r in new.values())
    assert any(r.text != old[i] for i, r in new.items()) and not any("(" + p in r.text for r in new.values() for p in [") 555-6503"])

    mixed = written(steps["source_mixture"](spark, clean, SF), "t")
    assert rows(mixed) == rows(steps["source_mixture"](spark, clean, SF))
    words = lambda df: sum(len(r.text.split()) for r in df.collect())
    assert set(map(tuple, mixed.collect())) <= set(map(tuple, clean.collect()))
    assert abs(words(mixed) / words(clean) - 1.5) < 0.2

    coded = steps["sentencepiece_ids"](spark, mixed, SF)
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert rows(coded.select("doc_id", "ids")) == sorted(((r.doc_id, model.encode(r.text)) for r in mixed.collect()), key=repr)
    back = pieces.decode(coded, public_tokenizers.path("piece_bpe_32k.model"))
    assert rows(back) == rows(mixed.select("doc_id", "text"))


def test_rows_of_one_doc_id_are_settled_by_their_text(spark):
    same = [(7, t, "en", s, n) for t, s, n in [("b text of one", "src1", 13), ("another text of it", "src2", 18), ("another text of it", "src1", 18), (None, "src3", 0)]]
    rest = [(8, "quite other words stand in this one", "en", None, 35), (None, "without an id", "en", "src1", 13), (None, "without an id", "en", "src1", 13)]
    stage = dict(corpus_pipeline.STAGES)["ngram_jaccard_join"]
    for order in (same, same[::-1]):
        docs = spark.createDataFrame([*order, *rest], table(spark, SF, "documents").select(*corpus_pipeline.COLUMNS).schema)
        assert rows(stage(spark, docs, SF)) == sorted([same[2], *rest], key=repr)


def test_run_on_an_empty_table(spark, tmp_path):
    table(spark, SF, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
