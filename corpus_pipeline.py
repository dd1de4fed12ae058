"""A training corpus from ``documents``: five stages, each calling one operator of ``roomledger.llm``.

Every stage takes the documents its predecessor kept and returns documents with the same columns; the
last returns their token ids. ``run`` writes each stage's result as Parquet in the shared folder and
reads it again for the next. The stages cannot be expressed in SQL, so ``ORACLE_SQL`` is None and
``tests/llm`` holds the result against a plain version without Spark.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roomledger.llm import byte_bpe, decontaminate, pii, simhash, toxicity
from roomledger.llm.common import table
from roomledger.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
