"""The training corpus in five stages: quality, exact and near duplicates, benchmark items, tokens.

Each stage takes what the one before kept, as a stored table. Decisions are by row, named by ``doc_id`` and text; rows without a
``doc_id`` are compared like others and rank last. The last stage gives the tokens' digests of every document that stayed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.llm import bpe, decontaminate, dedup, language, quality, simhash
from slotflow.llm.common import prepare, store


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose score is at least 0.5, by a model of the labelled ones that are not held out."""
    labels = prepare(spark).read.parquet(f"{folder}/labels.parquet")
    model = quality.learn(docs, labels, language.fold("doc_id", 3) != 1)
    # the columns travel as one struct, so none clashes with the score
    scored = docs.select(F.struct("*").alias("_row"), quality.score_column(model).alias("_score"))
    return scored.where("_score >= 0.5").select("_row.*")


def exact_once(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of texts that are equal without blanks."""
    prepare(spark)
    return dedup.without_duplicates(docs, keyless=True)


def near_once(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each component of fingerprints within two bits of each other."""
    prepare(spark)
    return simhash.without_near_duplicates(docs, words=3, distance=2)


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item to 0.8 or more of its five-word shingles."""
    return decontaminate.clean(docs, prepare(spark).read.parquet(f"{folder}/benchmark.parquet"), words=5, threshold=0.8)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Number and digests of the tokens of every document."""
    prepare(spark)
    return bpe.bpe_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_once),
    ("SimHash near-dedup", near_once),
    ("benchmark decontamination", decontaminated),
    ("BPE encoding and decoding", encoded),
]

#: SQL has neither the classifier nor the 64-bit hash; tests/llm holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the whole table; what each keeps is written to the shared folder and read again."""
    docs = prepare(spark).read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, folder)
        docs = docs if name == STAGES[-1][0] else store(docs)
    return docs
