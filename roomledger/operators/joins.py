"""Joins against small tables with a checked size.

A side is broadcast only after its row count has been measured and found below a bound; beyond
the bound the join is left to Spark's planner (sort-merge or shuffled hash join, with AQE's
skew-join splitting hot keys). Dimension tables of the star schema are bounded by the number of
distinct business members (hotels, countries x customer types, room-type pairs, ...), so in
practice they are broadcast and the fact is joined without any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS_CONF = "roomledger.broadcast.maxRows"
DEFAULT_BROADCAST_ROWS = 2_000_000


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(BROADCAST_ROWS_CONF, str(DEFAULT_BROADCAST_ROWS)))


def small_side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has at most the configured number of rows.

    ``rows`` is a count the caller already has (e.g. from writing the table); otherwise the rows
    are counted here, which for a small table is a cheap job.
    """
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= broadcast_limit(df) else df


def join_small(
    big: DataFrame, small: DataFrame, on: Column | list | str, how: str = "inner", rows: int | None = None
) -> DataFrame:
    return big.join(small_side(small, rows), on, how)
