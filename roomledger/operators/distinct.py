"""Exact distinct counts of whole-number and date columns by bitmaps that can be merged across runs.

A value is one bit: Spark's ``bitmap_bucket_number`` says in which bitmap (32,768 values each) and
``bitmap_bit_position`` where. A task sends one bitmap per column and occupied bucket, whatever the number of
rows or of equal values, where counting distinct values sends each value. Bitmaps are kept as a small table:
the state of a new run is merged with the states of earlier ones by OR, so history is not read again, and
merging a run twice changes nothing. For columns whose values are spread thinly over a wide range (hashes, keys
with gaps) a bitmap holds few bits and counting values as such is the better way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def whole_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, WHOLE)]


def state(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, bucket, bits): the values of every column as bitmaps. NULL is no value."""
    columns = whole_columns(df) if columns is None else columns
    dates = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)}

    def number(c: str):
        return (F.unix_date(c) if c in dates else F.col(c)).cast("bigint")

    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), number(c).alias("value")) for c in columns])
    values = df.select(F.explode(cells).alias("cell")).select("cell.column_name", "cell.value").where(F.col("value").isNotNull())
    return (
        values.select("column_name", F.bitmap_bucket_number("value").alias("bucket"), F.bitmap_bit_position("value").alias("place"))
        .groupBy("column_name", "bucket")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
    )


def merge(states: list[DataFrame]) -> DataFrame:
    """The state of all runs together."""
    both = states[0]
    for more in states[1:]:
        both = both.unionByName(more)
    return both.groupBy("column_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(state: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, distinct_values), 0 for a column without values."""
    found = state.groupBy("column_name").agg(F.sum(F.bitmap_count("bits")).alias("distinct_values"))
    names = state.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(F.broadcast(found), "column_name", "left").fillna(0, subset=["distinct_values"])
