"""Exact order statistics of many numeric columns at once, from value counts.

A quantile is a value at a rank, so nothing needs every row in order: it is enough to know how often each
value occurs and how many rows lie below it.

1. rows are unpivoted to (column, value) and counted; partial aggregation leaves one row per value and
   task, so a value that a third of all rows share is one row in the shuffle;
2. the counts are range-partitioned and sorted by (column, value) and written to the shared folder, which
   fixes the partitions. Rows per (column, partition), added up over partitions, say how many rows lie
   below each partition: a table of (columns x partitions) rows;
3. a rank is looked up in that small table first; only the partitions that hold a wanted rank (at most
   one per rank) are read for a running total.

No task holds more than one range partition of distinct values. NULL and NaN are left out; -0.0 is 0.0;
values are compared as doubles, so whole numbers must stay below 2**53. Quantiles interpolate linearly between the
two neighbouring rows, as SQL's ``percentile_cont`` does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomledger.session import stage


@dataclass
class RankedCounts:
    """Value counts in order, with the rows that lie below each partition."""

    counts: DataFrame  # column_name, value, n, part
    offsets: DataFrame  # column_name, part, below, rows
    totals: DataFrame  # column_name, total: one row per column


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n) of every value of every column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    pairs = df.select(F.explode(cells).alias("cell")).select("cell.column_name", "cell.value")
    pairs = pairs.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return counted(pairs.withColumn("n", F.lit(1).cast("bigint")))


def counted(pairs: DataFrame) -> DataFrame:
    """Counts of (column_name, value, n) rows added up per value."""
    zero = F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value"))
    return pairs.select("column_name", zero.alias("value"), "n").groupBy("column_name", "value").agg(F.sum("n").alias("n"))


def rank(counts: DataFrame) -> RankedCounts:
    """Order the counts and find out how many rows lie below each partition."""
    once = stage(counts, "value-counts")  # the range bounds are sampled, which would count everything twice
    ranged = once.repartitionByRange("column_name", "value").sortWithinPartitions("column_name", "value")
    ordered = stage(ranged.withColumn("part", F.spark_partition_id()), "ranked-counts")
    rows = ordered.groupBy("column_name", "part").agg(F.sum("n").alias("rows"))
    below = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.withColumn("below", F.coalesce(F.sum("rows").over(below), F.lit(0)))
    return RankedCounts(ordered, offsets, rows.groupBy("column_name").agg(F.sum("rows").alias("total")))


def at_ranks(ranked: RankedCounts, wanted: DataFrame) -> DataFrame:
    """``wanted`` (column_name, rank from 1, other columns; few rows) with the value at each rank."""
    low = F.col("below")
    own = F.col("column_name") == F.col("_column")
    asked = ranked.offsets.join(
        F.broadcast(wanted.withColumnRenamed("column_name", "_column")),
        own & (F.col("rank") > low) & (F.col("rank") <= low + F.col("rows")),
    ).drop("_column", "rows")
    near = ranked.counts.join(F.broadcast(asked.select("column_name", "part").distinct()), ["column_name", "part"], "left_semi")
    upto = Window.partitionBy("column_name", "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = near.withColumn("_upto", F.sum("n").over(upto))
    last = F.col("below") + F.col("_upto")
    found = running.join(F.broadcast(asked), ["column_name", "part"])
    return found.where((F.col("rank") > last - F.col("n")) & (F.col("rank") <= last)).drop("part", "n", "_upto", "below")


def quantiles(ranked: RankedCounts, shares: dict[str, float]) -> DataFrame:
    """One row per column with values: column_name, total and a column for each of ``shares`` (name -> share)."""
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(share)).alias("share")) for name, share in shares.items()])
    asked = ranked.totals.select("column_name", "total", F.explode(wanted).alias("q")).select(
        "column_name", "total", "q.name", (F.col("q.share") * (F.col("total") - 1)).alias("place")
    )
    sides = F.array(F.floor("place").cast("bigint") + 1, F.ceil("place").cast("bigint") + 1)
    ends = at_ranks(ranked, asked.withColumn("rank", F.explode(F.array_distinct(sides))))
    ends = ends.groupBy("column_name", "total", "name", "place").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    between = F.col("low") + (F.col("high") - F.col("low")) * (F.col("place") - F.floor("place"))
    return ends.groupBy("column_name", "total").agg(*[F.max(F.when(F.col("name") == n, between)).alias(n) for n in shares])


def exact_sum(value: Column, times: Column) -> Column:
    """Sum of ``value`` x ``times`` in decimals with ten fractional digits, independent of the order of rows."""
    return F.sum(value.cast("decimal(23,10)") * times.cast("decimal(14,0)")).cast("double")
