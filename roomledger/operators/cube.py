"""A small cube that answers the dashboard's cards under any slicers.

The fact is read once and summed up into *cells*, one per combination of the four slicer attributes that occurs.
Every combination of slicers is then a grouping set over the cells, not over the fact (Spark's ``cube`` copies its
input once per grouping set, 16 times here, so it gets the small table). Only measures that can be
added are kept (counts and exact decimal sums); rates and means are recomputed from them at every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions.measures import exact, percent, sum_where
from roomledger.operators.gold import Dimension
from roomledger.operators.joins import small_side
from roomledger.operators.views import Slicers

ATTRIBUTES = ("full_date", "customer_type", "hotel", "distribution_channel")
ADDITIVE = ("total_bookings", "canceled_bookings", "total_nights", "lead_time_sum", "lead_time_count", "adr_sum", "adr_count", "revenue_sum")


def cells(fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """Additive measures per date, customer type, hotel and channel.

    A dimension's attribute is taken once per key, so a date that the date dimension lists twice (with two
    week numbers) does not multiply bookings.
    """
    rows = fact
    for name, key, attribute in (
        ("dim_date", "date_key", "full_date"),
        ("dim_customer", "customer_key", "customer_type"),
        ("dim_hotel", "hotel_key", "hotel"),
        ("dim_channel", "channel_key", "distribution_channel"),
    ):
        rows = rows.join(small_side(dims[name].df.select(key, attribute).distinct(), dims[name].rows), key)
    return rows.groupBy(*ATTRIBUTES).agg(
        F.count(F.lit(1)).alias("total_bookings"),
        sum_where(F.col("is_canceled") == 1).alias("canceled_bookings"),
        F.sum("total_nights").alias("total_nights"),
        F.sum("lead_time").alias("lead_time_sum"),
        F.count("lead_time").alias("lead_time_count"),
        F.sum(exact(F.col("adr"))).alias("adr_sum"),
        F.count("adr").alias("adr_count"),
        F.sum(exact(F.col("estimated_revenue"))).alias("revenue_sum"),
    )


def kpi_cube(cells: DataFrame) -> DataFrame:
    """The additive measures at all 16 levels; ``level`` has a bit for each attribute that is summed over
    (8, 4, 2, 1 in the order of ``ATTRIBUTES``), which tells such a NULL from a member without a value."""
    return cells.cube(*ATTRIBUTES).agg(F.grouping_id().cast("int").alias("level"), *[F.sum(m).alias(m) for m in ADDITIVE])


def rates() -> list[Column]:
    """The dashboard's figures from additive measures."""
    adr = F.col("adr_sum") / F.nullif(F.col("adr_count"), F.lit(0)).cast("decimal(20,0)")
    lead_time = F.col("lead_time_sum").cast("double") / F.nullif(F.col("lead_time_count"), F.lit(0))
    return [
        F.round(adr, 2).cast("double").alias("avg_adr"),
        F.round(lead_time, 2).alias("avg_lead_time"),
        F.col("revenue_sum").cast("double").alias("total_estimated_revenue"),
        F.col("total_nights"),
        percent(F.col("canceled_bookings"), F.col("total_bookings")).alias("cancellation_rate"),
    ]


def with_rates(cube: DataFrame) -> DataFrame:
    return cube.select(*ATTRIBUTES, "level", "total_bookings", "canceled_bookings", *rates())


def cards_from_cube(cube: DataFrame, slicers: Slicers = Slicers()) -> DataFrame:
    """K1-K5 under any slicers, from the cube alone: the level that keeps just the sliced attributes."""
    wanted = {
        "full_date": None if slicers.period is None else F.col("full_date").between(*(F.lit(d).cast("date") for d in slicers.period)),
        "customer_type": None if slicers.customer_type is None else F.col("customer_type") == slicers.customer_type,
        "hotel": None if slicers.hotel is None else F.col("hotel") == slicers.hotel,
        "distribution_channel": None
        if slicers.distribution_channel is None
        else F.col("distribution_channel") == slicers.distribution_channel,
    }
    level = sum(8 >> n for n, name in enumerate(ATTRIBUTES) if wanted[name] is None)
    rows = cube.where(F.col("level") == level)
    for condition in wanted.values():
        rows = rows if condition is None else rows.where(condition)
    sums = rows.agg(*[F.sum(m).alias(m) for m in ADDITIVE])
    return sums.select(F.coalesce("total_bookings", F.lit(0)).alias("total_bookings"), *rates())
