"""Business views and dashboard datasets over the star schema.

Every view is a ``groupBy().agg()`` (partial aggregation map-side, so a hot group value costs one
row per task before the shuffle) over the fact joined to broadcast dimensions. Money is summed in
exact decimals (see functions/measures.py); rates are recomputed from counts at every grain,
never averaged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions.measures import lead_time_band, mean2, money_mean2, money_sum, percent, sum_where
from roomledger.operators.gold import Dimension
from roomledger.operators.joins import small_side
from roomledger.schema import LEAD_TIME_BANDS, OPEN_LEAD_TIME_BAND


def _canceled() -> Column:
    return F.col("is_canceled") == 1


def _total() -> Column:
    return F.count(F.lit(1))


def _dim(dims: dict[str, Dimension], name: str) -> DataFrame:
    d = dims[name]
    return small_side(d.df, d.rows)


def overview_measures() -> list[Column]:
    return [
        _total().alias("total_bookings"),
        sum_where(_canceled()).alias("canceled_bookings"),
        sum_where(F.col("is_canceled") == 0).alias("confirmed_bookings"),
        percent(sum_where(_canceled()), _total()).alias("cancellation_rate"),
        F.sum("total_guests").alias("total_guests"),
        F.sum("total_nights").alias("total_nights"),
        mean2(F.col("total_nights")).alias("avg_nights_per_booking"),
        mean2(F.col("lead_time")).alias("avg_lead_time"),
        money_mean2(F.col("adr")).alias("avg_adr"),
        money_sum(F.col("estimated_revenue")).alias("total_estimated_revenue"),
        money_mean2(F.col("estimated_revenue")).alias("avg_revenue_per_booking"),
    ]


def segment_measures() -> list[Column]:
    """Measures of the seasonality and channel views."""
    return [
        _total().alias("total_bookings"),
        sum_where(_canceled()).alias("canceled_bookings"),
        percent(sum_where(_canceled()), _total()).alias("cancellation_rate"),
        F.sum("total_nights").alias("total_nights"),
        F.sum("total_guests").alias("total_guests"),
        money_mean2(F.col("adr")).alias("avg_adr"),
        money_sum(F.col("estimated_revenue")).alias("total_estimated_revenue"),
    ]


def booking_overview(fact: DataFrame) -> DataFrame:
    """V1: one row, even on an empty fact."""
    return fact.agg(*overview_measures())


def booking_by_lead_time(fact: DataFrame) -> DataFrame:
    """V2: one row per lead-time band."""
    return (
        fact.withColumn("lead_time_range", lead_time_band(F.col("lead_time")))
        .groupBy("lead_time_range")
        .agg(
            _total().alias("total_bookings"),
            sum_where(_canceled()).alias("canceled_bookings"),
            sum_where(F.col("is_canceled") == 0).alias("confirmed_bookings"),
            percent(sum_where(_canceled()), _total()).alias("cancellation_rate"),
            mean2(F.col("lead_time")).alias("avg_lead_time"),
            money_mean2(F.col("adr")).alias("avg_adr"),
            mean2(F.col("total_nights")).alias("avg_nights"),
            F.sum("total_nights").alias("total_nights"),
            money_sum(F.col("estimated_revenue")).alias("total_estimated_revenue"),
        )
    )


def booking_seasonality_hotel(fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """V3: hotel x year x month."""
    joined = fact.join(_dim(dims, "dim_date"), "date_key").join(_dim(dims, "dim_hotel"), "hotel_key")
    return joined.groupBy("hotel", "year", "month_number", "month_name").agg(*segment_measures())


def booking_by_channel(fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """V4: market segment x distribution channel."""
    joined = fact.join(_dim(dims, "dim_channel"), "channel_key")
    return joined.groupBy("market_segment", "distribution_channel").agg(*segment_measures())


def room_match(fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """V5: reserved x assigned room type; a NULL type counts as neither match nor change."""
    joined = fact.join(_dim(dims, "dim_room"), "room_key")
    same = F.col("reserved_room_type") == F.col("assigned_room_type")
    changed = F.col("reserved_room_type") != F.col("assigned_room_type")
    return joined.groupBy("reserved_room_type", "assigned_room_type").agg(
        _total().alias("total_bookings"),
        sum_where(same).alias("matched_bookings"),
        sum_where(changed).alias("changed_bookings"),
        percent(sum_where(same), _total()).alias("match_rate"),
        percent(sum_where(changed), _total()).alias("change_rate"),
    )


VIEWS = {
    "vw_booking_overview": lambda fact, dims: booking_overview(fact),
    "vw_booking_by_lead_time": lambda fact, dims: booking_by_lead_time(fact),
    "vw_booking_seasonality_hotel": booking_seasonality_hotel,
    "vw_booking_by_channel": booking_by_channel,
    "vw_room_match": room_match,
}


# ---------------------------------------------------------------------------------------------
# The same views as SQL text, for publication beside the tables (A8). ``{table}`` stands for a table of
# the published run; it is bound to that run's files when the views are opened.
# ---------------------------------------------------------------------------------------------

_PERCENT = "round(100.0D * {part} / nullif({whole}, 0), 2)"
_MEAN = "round(sum(cast({x} AS double)) / nullif(count({x}), 0), 2)"
_MONEY = "cast({x} AS decimal(28,10))"
_MONEY_SUM = f"cast(sum({_MONEY}) AS double)"
_MONEY_MEAN = f"cast(round(sum({_MONEY}) / cast(nullif(count({{x}}), 0) AS decimal(20,0)), 2) AS double)"


def _count_if(predicate: str) -> str:
    return f"cast(sum(CASE WHEN {predicate} THEN 1 ELSE 0 END) AS bigint)"


def _sql_measures(*names: str) -> str:
    canceled = _count_if("is_canceled = 1")
    measures = {
        "total_bookings": "count(1)",
        "canceled_bookings": canceled,
        "confirmed_bookings": _count_if("is_canceled = 0"),
        "cancellation_rate": _PERCENT.format(part=canceled, whole="count(1)"),
        "total_guests": "sum(total_guests)",
        "total_nights": "sum(total_nights)",
        "avg_nights_per_booking": _MEAN.format(x="total_nights"),
        "avg_nights": _MEAN.format(x="total_nights"),
        "avg_lead_time": _MEAN.format(x="lead_time"),
        "avg_adr": _MONEY_MEAN.format(x="adr"),
        "total_estimated_revenue": _MONEY_SUM.format(x="estimated_revenue"),
        "avg_revenue_per_booking": _MONEY_MEAN.format(x="estimated_revenue"),
    }
    return ", ".join(f"{measures[name]} AS {name}" for name in names)


def _sql_band() -> str:
    cases = " ".join(f"WHEN lead_time <= {upper} THEN '{label}'" for upper, label in LEAD_TIME_BANDS)
    return f"CASE {cases} ELSE '{OPEN_LEAD_TIME_BAND}' END"


def view_definitions() -> dict[str, str]:
    """SQL text of the business views V1-V5 over ``{fact_booking}`` and the dimensions."""
    segment = _sql_measures(
        "total_bookings", "canceled_bookings", "cancellation_rate", "total_nights", "total_guests", "avg_adr", "total_estimated_revenue"
    )
    same, changed = (f"reserved_room_type {sign} assigned_room_type" for sign in ("=", "<>"))
    return {
        "vw_booking_overview": "SELECT "
        + _sql_measures(
            "total_bookings", "canceled_bookings", "confirmed_bookings", "cancellation_rate", "total_guests", "total_nights",
            "avg_nights_per_booking", "avg_lead_time", "avg_adr", "total_estimated_revenue", "avg_revenue_per_booking",
        )
        + " FROM {fact_booking}",
        "vw_booking_by_lead_time": "SELECT lead_time_range, "
        + _sql_measures(
            "total_bookings", "canceled_bookings", "confirmed_bookings", "cancellation_rate", "avg_lead_time", "avg_adr", "avg_nights",
            "total_nights", "total_estimated_revenue",
        )
        + f" FROM (SELECT *, {_sql_band()} AS lead_time_range FROM {{fact_booking}}) GROUP BY lead_time_range",
        "vw_booking_seasonality_hotel": f"SELECT hotel, year, month_number, month_name, {segment} FROM {{fact_booking}} "
        "JOIN {dim_date} USING (date_key) JOIN {dim_hotel} USING (hotel_key) GROUP BY hotel, year, month_number, month_name",
        "vw_booking_by_channel": f"SELECT market_segment, distribution_channel, {segment} FROM {{fact_booking}} "
        "JOIN {dim_channel} USING (channel_key) GROUP BY market_segment, distribution_channel",
        "vw_room_match": "SELECT reserved_room_type, assigned_room_type, count(1) AS total_bookings, "
        f"{_count_if(same)} AS matched_bookings, {_count_if(changed)} AS changed_bookings, "
        f"{_PERCENT.format(part=_count_if(same), whole='count(1)')} AS match_rate, "
        f"{_PERCENT.format(part=_count_if(changed), whole='count(1)')} AS change_rate FROM {{fact_booking}} "
        "JOIN {dim_room} USING (room_key) GROUP BY reserved_room_type, assigned_room_type",
    }


def bind(definition: str, paths: dict[str, str]) -> str:
    """A view definition over the parquet files of one published run."""
    return definition.format(**{name: f"parquet.`{path}`" for name, path in paths.items()})


def register_views(fact: DataFrame, dims: dict[str, Dimension]) -> dict[str, DataFrame]:
    """Publish every business view as a temp view for SQL users; error if none exist."""
    if not VIEWS:
        raise FileNotFoundError("no business view is defined")
    out = {}
    for name in sorted(VIEWS):
        df = VIEWS[name](fact, dims)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


# ---------------------------------------------------------------------------------------------
# Dashboard (README-only in the reference): slicers and the datasets behind its visuals.
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Slicers:
    """The dashboard's filters; ``None`` means not filtered."""

    period: tuple[str, str] | None = None  # inclusive ISO dates on full_date
    customer_type: str | None = None
    hotel: str | None = None
    distribution_channel: str | None = None


def slice_fact(fact: DataFrame, dims: dict[str, Dimension], slicers: Slicers) -> DataFrame:
    """Keep the fact rows whose dimension members pass every slicer.

    Each slicer filters its (small) dimension first and then semi-joins the fact on the key, so
    a dimension with duplicate keys cannot multiply fact rows and nothing is shuffled.
    """
    filters = []
    if slicers.period is not None:
        start, end = slicers.period
        filters.append(("dim_date", "date_key", F.col("full_date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))))
    if slicers.customer_type is not None:
        filters.append(("dim_customer", "customer_key", F.col("customer_type") == slicers.customer_type))
    if slicers.hotel is not None:
        filters.append(("dim_hotel", "hotel_key", F.col("hotel") == slicers.hotel))
    if slicers.distribution_channel is not None:
        filters.append(("dim_channel", "channel_key", F.col("distribution_channel") == slicers.distribution_channel))
    for name, key, predicate in filters:
        dim = dims[name]
        keys = dim.df.where(predicate).select(key)
        fact = fact.join(small_side(keys, dim.rows), key, "left_semi")
    return fact


def kpi_cards(fact: DataFrame, dims: dict[str, Dimension], slicers: Slicers = Slicers()) -> DataFrame:
    """K1-K5: the dashboard cards, recomputed under the slicers."""
    return slice_fact(fact, dims, slicers).agg(
        _total().alias("total_bookings"),
        money_mean2(F.col("adr")).alias("avg_adr"),
        mean2(F.col("lead_time")).alias("avg_lead_time"),
        money_sum(F.col("estimated_revenue")).alias("total_estimated_revenue"),
        F.sum("total_nights").alias("total_nights"),
        percent(sum_where(_canceled()), _total()).alias("cancellation_rate"),
    )


def bookings_by_month(fact: DataFrame, dims: dict[str, Dimension], slicers: Slicers = Slicers()) -> DataFrame:
    """K6: bookings per calendar month (all hotels)."""
    joined = slice_fact(fact, dims, slicers).join(_dim(dims, "dim_date"), "date_key")
    return joined.groupBy("year", "month_number", "month_name").agg(*segment_measures())


def bookings_by_hotel(fact: DataFrame, dims: dict[str, Dimension], slicers: Slicers = Slicers()) -> DataFrame:
    """K7: bookings per hotel."""
    joined = slice_fact(fact, dims, slicers).join(_dim(dims, "dim_hotel"), "hotel_key")
    return joined.groupBy("hotel").agg(*segment_measures())


def bookings_by_segment(fact: DataFrame, dims: dict[str, Dimension], slicers: Slicers = Slicers()) -> DataFrame:
    """K8: bookings per market segment."""
    joined = slice_fact(fact, dims, slicers).join(_dim(dims, "dim_channel"), "channel_key")
    return joined.groupBy("market_segment").agg(*segment_measures())


def bookings_by_lead_band(fact: DataFrame, dims: dict[str, Dimension], slicers: Slicers = Slicers()) -> DataFrame:
    """K9: bookings per lead-time band (projection of V2 under the slicers)."""
    return booking_by_lead_time(slice_fact(fact, dims, slicers)).select(
        "lead_time_range", "total_bookings", "canceled_bookings", "cancellation_rate"
    )
