"""From raw documents to token ids: language, near-duplicates, benchmark leaks, secrets, encoding.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that works on all documents its predecessor kept. All but
the last return the columns they got. Rejected documents are gone from then on; documents that hold secrets stay, with
the secrets replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pavelake.llm import bpe, dartminhash, decontam, langid, secrets
from pavelake.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled ones; texts that are null, hold no letter or are made of
    strings unlike any of the languages go."""
    judged = langid.identify(docs, langid.samples(docs), into="__language")
    return judged.where(langid.accepted("__language")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return dartminhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets replaced in their texts."""
    return secrets.mask(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    return bpe.digest(docs, ids=True)


STAGES = [
    ("language_id", language),
    ("minhash_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_masking),
    ("bpe", encoding),
]

ORACLE_SQL = None  # neither cross-parsing nor the tokenizer can be put in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = written(docs, name)
    return docs
