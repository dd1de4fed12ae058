"""Dense 1..n numbering of rows in a total order, at any size.

``ROW_NUMBER() OVER (ORDER BY ...)`` without PARTITION BY makes Spark move every row into a single
task. That is fine for a table whose size has been checked to be small (the dimensions), and
wrong for the fact table. The scalable form used here:

1. range-partition the rows on the ordering (Spark samples the keys to pick the bounds, so
   partitions are balanced even when one leading key value holds a third of all rows: the bounds
   then split inside that value on the following columns), sort within each partition;
2. tag every row with ``monotonically_increasing_id()``, whose documented layout is
   ``partition index << 33 | position within the partition``;
3. write the tagged rows to the shared folder, so the ids are fixed even if executors are lost
   and a stage is recomputed (range bounds come from sampling and could change on recompute);
4. count rows per partition (one tiny aggregate), turn the counts into starting offsets with a
   window over at most ``#partitions`` rows, and add ``offset + position + 1`` through a
   broadcast join of that small table.

No step holds more than one range partition's rows in a task, and no data passes the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.session import stage

SINGLE_TASK_ROWS_CONF = "roomledger.numbering.singleTaskMaxRows"
DEFAULT_SINGLE_TASK_ROWS = 1_000_000
_POSITION_BITS = 33


def ascending(columns) -> list[Column]:
    """Ascending order with NULLs last (the warehouse's default; Spark's default is NULLs first)."""
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in columns]


def number_small(df: DataFrame, order: list[Column], key: str) -> DataFrame:
    """Single-task ROW_NUMBER; only for inputs whose size the caller has checked."""
    return df.select(F.row_number().over(Window.orderBy(*order)).alias(key), *df.columns)


def number_large(df: DataFrame, order: list[Column], key: str, partitions: int | None = None) -> DataFrame:
    """Distributed dense numbering 1..n in ``order`` (which must be total, or ties identical)."""
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    tagged = ranged.sortWithinPartitions(*order).withColumn("_row_id", F.monotonically_increasing_id())
    staged = stage(tagged, "numbering")
    part = F.shiftright(F.col("_row_id"), _POSITION_BITS)
    position = F.col("_row_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    counts = staged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition: the running total is computed in one task over a bounded table.
    offsets = counts.select(
        "_part",
        (F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_rows")).alias(
            "_offset"
        ),
    )
    numbered = staged.join(F.broadcast(offsets), part == F.col("_part"), "inner")
    return numbered.select((F.col("_offset") + position + F.lit(1)).alias(key), *df.columns)


def number_rows(
    df: DataFrame, order, key: str, rows: int | None = None, partitions: int | None = None
) -> DataFrame:
    """Number ``df`` 1..n by ``order``; small inputs (measured) in one task, others distributed."""
    order = ascending(order)
    limit = int(df.sparkSession.conf.get(SINGLE_TASK_ROWS_CONF, str(DEFAULT_SINGLE_TASK_ROWS)))
    n = df.count() if rows is None else rows
    if n <= limit:
        return number_small(df, order, key)
    return number_large(df, order, key, partitions)
