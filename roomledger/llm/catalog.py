"""Registered queries of the operators in this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from roomledger.llm import (
    alignment,
    ann,
    byte_bpe,
    chat,
    decontaminate,
    licences,
    packing,
    pii,
    repair,
    sharding,
    simhash,
    token_records,
    toxicity,
)
from roomledger.llm.common import table
from roomledger.llm.repair_sql import REPAIR_SQL

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TEMPLATE_PROBE = "</s>[INST] ok [/INST]"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts hold strings that look like a template's."""
    probe = spark.createDataFrame(
        [(-1, 0, "user", TEMPLATE_PROBE), (-1, 1, "assistant", TEMPLATE_PROBE)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(turns.unionByName(probe)))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.token_records(table(spark, sf_dir, "documents"), WORD_BPE, end_id=2)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_documents(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=24)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE_JSON, public_tokenizers.PATTERN, end_id=1, capacity=2048)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audit(repair.damage(table(spark, sf_dir, "conversations")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, BYTE_BPE_JSON, public_tokenizers.PATTERN, PIECE_BPE)


QUERIES = (
    op1_decontamination,
    op2_nn_descent,
    op3_byte_bpe,
    op4_chat_format,
    op5_pii,
    op6_token_records,
    op7_simhash,
    op8_toxicity,
    op9_licences,
    op10_sharding,
    op11_packing,
    op12_conversation_repair,
    op13_alignment,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express (the others are tested against brute force)."""
    return {"op4_chat_format": CHAT_SQL, "op12_conversation_repair": REPAIR_SQL}


CHAT_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{TEMPLATE_PROBE}'
    UNION ALL SELECT -1, 1, 'assistant', '{TEMPLATE_PROBE}'
), ordered AS (
    SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before FROM turns
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), sized AS (
    SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\\', ''), '<', ''), '|', '')) AS chars,
           length(role) + length(role) - length(replace(replace(replace(role, '\\', ''), '<', ''), '|', '')) AS role_chars
    FROM ordered
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + CASE WHEN before IS NULL OR before <> role THEN role_chars + 8 ELSE 3 END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
