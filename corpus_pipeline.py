"""From raw documents to packed token sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns the columns of documents, but for the last, which returns the
pieces of sequences. Results are written to the shared folder and read again,
so a lost executor costs tasks, not stages.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartfold.llm import jaccard, language, packing, secrets, toxicity
from chartfold.shared import settled_from

# Documents with more words of no learned language than this share go.
MOST_UNKNOWN = 0.8
# Documents that score at least this go.
TOXIC = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter, or hardly a word of any.

    The languages are learned from the documents' own `lang`.
    """
    told = language.identify(docs, language.learn(docs))
    speaks = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("unknown") <= MOST_UNKNOWN)
    return told.filter(speaks).select(docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic, learned from the table of labels."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model, into="_toxicity").filter(F.col("_toxicity") < TOXIC).drop("_toxicity")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return jaccard.first_of_each(docs, jaccard.classes(docs))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents and replaces the secrets in their texts."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Learned scores, minima of hashes and token ids are beyond SQL; the stages are
# tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        # What a stage settles on its way goes as soon as its result is written.
        docs = settled_from(spark, partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
