"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A row's shard is a function of its id and the number of shards alone: no ring table, no state. The
hash walks the jump sequence of the id's 64-bit hash and stops before the first jump past the last
shard, so going from n to n + 1 shards moves 1 / (n + 1) of the rows, all of them into the new shard.

Within a shard rows are numbered from 0 without gaps in order of (id, size, checksum). The order is
made by one range shuffle of the narrow rows on (shard, id, size, checksum, input position): a
shard, or an id repeated in a third of all rows, is split over as many partitions as its size asks
for. Only per-partition counts and one first number per shard are broadcast.

Defined results: a null id is hashed like a value of its own (all such rows share a shard); a null
text has size 8 and checksum 0, as an empty one; repeated rows each get a slot; an empty table gives
an empty result; other input columns are ignored (``write_shards`` keeps them, replacing ``shard``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import id_text
from roomledger.operators.numbering import ascending, number_large

ROW_OVERHEAD = 8  # bytes a stored row takes besides its text
_STEP = np.uint64(2862933555777941757)  # multiplier of the published generator


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of 64-bit keys, for a whole batch at once."""
    state = keys.astype(np.uint64)
    bucket = np.zeros(len(state), dtype=np.int64)
    walking = np.arange(len(state))
    while len(walking):
        state[walking] = state[walking] * _STEP + np.uint64(1)
        scale = float(1 << 31) / ((state[walking] >> np.uint64(33)).astype(np.float64) + 1.0)
        landing = ((bucket[walking] + 1) * scale).astype(np.int64)
        inside = landing < shards
        walking = walking[inside]
        bucket[walking] = landing[inside]
    return bucket.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard (0-based) of a 64-bit hash column."""
    if shards < 1:
        raise ValueError("shards must be positive")

    @F.pandas_udf("int")
    def assign(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy().view(np.uint64), shards))

    return assign(key)


def assign_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (the shard among ``shards + 1``)."""
    rows = id_text(docs, id_col, text_col, spread=False).select(
        "doc_id",
        (F.octet_length("text") + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id").alias("_key"),
        F.monotonically_increasing_id().alias("_position"),
    )
    placed = rows.withColumn("shard", shard_of(F.col("_key"), shards)).withColumn(
        "grown_shard", shard_of(F.col("_key"), shards + 1)
    )
    order = ascending(["shard", "doc_id", "size", "text_crc32", "_position"])
    numbered = number_large(placed, order, "_number")
    first = numbered.groupBy("shard").agg(F.min("_number").alias("_first"))  # one row per shard
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_number") - F.col("_first")).alias("slot"),
        "grown_shard",
    )


def write_shards(docs: DataFrame, path: str, shards: int = 24, id_col: str = "doc_id") -> None:
    """Write whole rows under ``path/shard=k``; a shard is split over many tasks by a hash of the row."""
    placed = docs.withColumn("shard", shard_of(F.xxhash64(F.col(id_col).cast("long")), shards))
    placed.repartition("shard", F.monotonically_increasing_id() % 16).write.partitionBy("shard").parquet(path)
