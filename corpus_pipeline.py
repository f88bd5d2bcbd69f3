"""Corpus preparation pipeline over ``documents``.

Five stages, each one of the corpus operators at work on all that the stage
before it kept: language identification (documents without a letter go),
near duplicates (one document of each group stays), benchmark
decontamination (documents that hold a benchmark item go), mixing (rows are
repeated or left out to meet the sources' targets), and token files. All but
the last return the columns of ``documents``; the last returns one row per
document of the files it wrote and read back.

``ORACLE_SQL`` is None: SQL cannot express the language model, the edit
distances or the tokenizer. The tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendspark.llm import op5_ngram_join, op6_langid, op7_mix, op8_tokens, op10_decontaminate
from lendspark.llm.common import ship, stage, table

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those predicted ``und`` go, which are the
    texts without a letter and no others. Gibberish with letters and texts in a
    language not learned get the nearest language and stay. The model is
    fitted on the training folds of the stage's own input; without labelled
    text there, the same documents go."""
    trees = op6_langid.fit_documents(docs)
    if not trees.langs:
        return docs.filter(op6_langid.has_letter(docs["text"]))
    found = op6_langid.identify(docs, trees, names=("__lang_pred", "__lang_score"))
    return found.filter(found["__lang_pred"] != op6_langid.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group."""
    return op5_ngram_join.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return op10_decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return op7_mix.mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix: start, length and crc32 of each document."""
    return op8_tokens.encode_documents(docs)


STAGES = [
    ("language ID", ship(language_id)),
    ("near duplicates", ship(near_duplicates)),
    ("decontamination", ship(decontamination)),
    ("mixing", mixing),
    ("token files", ship(token_files)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
