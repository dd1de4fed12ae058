"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spread: bool = True) -> DataFrame:
    """Only the id (long) and the text (null becomes empty): extra columns cannot clash later.

    Where the scan has fewer splits than the cluster has cores (one small file), the rows are spread.
    """
    df = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def digest(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def settled(df: DataFrame) -> DataFrame:
    """``df`` with its columns worked out once per row.

    The optimizer writes a column's expression where the column is used; inside the function of a ``transform`` it
    would then run again for every element. It does not look through a projection that numbers its rows, as long as
    the number is used.
    """
    return df.withColumn("_settled", F.monotonically_increasing_id()).where(F.col("_settled") >= 0).drop("_settled")


def frame(rows: list[tuple], schema: str):
    """A pandas frame of ``rows`` for a schema like ``a long, b string``; whole numbers stay exact beside nulls.

    (Left to itself pandas reads integers beside nulls as doubles, which loses digits beyond 2**53.)
    """
    import pandas as pd

    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pd.DataFrame(
        {n: pd.array(c, dtype="Int64") if kind in ("int", "long") else list(c) for (n, kind), c in zip(fields, columns, strict=True)}
    )


class Recent:
    """A bounded cache of two generations: before a batch that finds the young one full, the old one goes."""

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def fresh(self) -> dict:
        """The young generation, with room for another batch."""
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}
        return self.young

    def missing(self, keys: set) -> list:
        """Those of ``keys`` that neither generation has; the others are then in the young one."""
        absent = keys.difference(self.young)
        again = {key for key in absent if key in self.old}  # set.intersection would go through the whole dict
        self.young.update((k, self.old[k]) for k in again)
        return list(absent.difference(again))


def worker_cache(key: tuple, make):
    """The object made once per Python worker for ``key`` (tokenizers and bounded caches only).

    Spark uses a worker for one stage after the other; what another operator (the key's first part) left
    there is dropped, so the caches of a pipeline's stages do not add up.
    """
    import sys
    import types

    held = sys.modules.setdefault("_roomledger_worker", types.ModuleType("_roomledger_worker")).__dict__
    if key not in held:
        for other in [k for k in held if isinstance(k, tuple) and k[0] != key[0]]:
            del held[other]
            release_memory()
        held[key] = make()
    return held[key]


def release_memory() -> None:
    """Memory that the worker's allocators keep after use goes back to the system, where they offer that."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
