"""Corpus pipeline: language ID, one document of each near-duplicate group, surrogates, mixture, SentencePiece ids.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the columns of documents; the last
one adds ids. Each stage's rows are written and read again before the next. Columns that documents lack are not needed: only
doc_id, text, lang, source and n_chars are handed on.

Decisions. Language ID rejects documents whose text is null or has no letter (`und`), and writes the language it finds to lang. Of
each group of near copies the document with the smallest doc_id stays; of rows with one doc_id, that whose text sorts first (null last);
rows without a doc_id link with nothing and stay. Surrogates replace text and n_chars. The mixture takes whole documents: as many copies
as the words that it takes fill, the last one if they fill half of it. A document whose share is less leaves the mixture.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import jaccard, language, mixing, pieces, surrogates
from weftline.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; lang is what was found. Learns from labelled rows of docs that are not held out."""
    docs = docs.select(*COLUMNS)
    return language.predict(docs, language.train(docs), keep=COLUMNS).where("lang_pred != 'und'").select(
        "doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars"
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: five words, Jaccard of 0.75 or more."""
    docs = docs.select(*COLUMNS)
    groups = jaccard.jaccard_join(docs)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    stay = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi")
    first = stay.groupBy("doc_id").agg(F.min(F.struct(F.isnull("text"), *COLUMNS[1:])).alias("_first"))
    return first.select("doc_id", "_first.*").select(*COLUMNS).unionByName(docs.where("doc_id IS NULL"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts with surrogates. A real run takes its key from a secret store."""
    new = surrogates.with_surrogates(docs.select(*COLUMNS), key="a key for tests")
    return new.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    docs = docs.select(*COLUMNS)
    taken = mixing.mix(docs, weights=[3, 1, 2], keep=COLUMNS)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)
    return taken.withColumn("_n", copies).where("_n > 0").select(*COLUMNS, F.explode(F.sequence(F.lit(1), "_n"))).select(*COLUMNS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the ids of the text."""
    return pieces.encode(docs.select(*COLUMNS), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id", "lang", "source"])


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("pii_surrogates", replace_personal_data),
    ("source_mixture", mix_sources),
    ("sentencepiece_ids", encode_pieces),
]

#: None: trained trees, keyed surrogates and vocabulary merges are not SQL; tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
