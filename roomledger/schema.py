"""Column lists, types and fixed business values of the booking model.

Every stage of the library refers to columns by name through the lists below, so the raw file's
column order is never a contract (the reference's warehouse load was positional).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values. These must equal the reference's values for identical results; they are stated
# plainly and in their natural order.
# ---------------------------------------------------------------------------------------------

# Tokens that pandas.read_csv turns into a missing value by default (exact, case-sensitive match).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# English month names, January = 1 ... December = 12 (exact, case-sensitive).
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# Data-quality labels of the silver layer.
STATUS_VALID = "VALID"
STATUS_INVALID_ADR = "INVALID_ADR"
STATUS_INVALID_EXTREME_ADR = "INVALID_EXTREME_ADR"
STATUS_INVALID_EXTREME_OCCUPANCY = "INVALID_EXTREME_OCCUPANCY"
CANCELED_STATUS = "Canceled"

# Thresholds of the labelling rules and of the silver checks.
EXTREME_ADR = 5000
EXTREME_ADULTS = 20
EXPECTED_MIN_ROWS = 80000
REVENUE_TOLERANCE = 0.01

# Lead-time bands: (inclusive upper bound, label); anything above the last bound, or NULL,
# falls into OPEN_LEAD_TIME_BAND.
LEAD_TIME_BANDS = (
    (7, "0-7 dias"),
    (30, "8-30 dias"),
    (60, "31-60 dias"),
    (90, "61-90 dias"),
    (180, "91-180 dias"),
)
OPEN_LEAD_TIME_BAND = "181+ dias"

# Quarter of a month number: (first month, last month, quarter).
QUARTERS = ((1, 3, 1), (4, 6, 2), (7, 9, 3), (10, 12, 4))

# Sentinel used by the duplicate probe for NULL parts.
EMPTY = ""

# ---------------------------------------------------------------------------------------------
# Columns
# ---------------------------------------------------------------------------------------------

INTEGER_COLUMNS = (
    "is_canceled", "lead_time", "arrival_date_year", "arrival_date_week_number",
    "arrival_date_day_of_month", "stays_in_weekend_nights", "stays_in_week_nights", "adults",
    "children", "babies", "is_repeated_guest", "previous_cancellations",
    "previous_bookings_not_canceled", "booking_changes", "agent", "company",
    "days_in_waiting_list", "required_car_parking_spaces", "total_of_special_requests",
)
DECIMAL_COLUMNS = ("adr",)

RAW_COLUMNS = (
    "hotel", "is_canceled", "lead_time", "arrival_date_year", "arrival_date_month",
    "arrival_date_week_number", "arrival_date_day_of_month", "stays_in_weekend_nights",
    "stays_in_week_nights", "adults", "children", "babies", "meal", "country", "market_segment",
    "distribution_channel", "is_repeated_guest", "previous_cancellations",
    "previous_bookings_not_canceled", "reserved_room_type", "assigned_room_type",
    "booking_changes", "deposit_type", "agent", "company", "days_in_waiting_list",
    "customer_type", "adr", "required_car_parking_spaces", "total_of_special_requests",
    "reservation_status", "reservation_status_date",
)
TEXT_COLUMNS = tuple(c for c in RAW_COLUMNS if c not in INTEGER_COLUMNS + DECIMAL_COLUMNS)

DERIVED_COLUMNS = (
    "arrival_month_num", "arrival_date", "total_nights", "total_guests", "estimated_revenue",
    "data_quality_status",
)
SILVER_COLUMNS = RAW_COLUMNS + DERIVED_COLUMNS


def _raw_type(name: str) -> T.DataType:
    if name in INTEGER_COLUMNS:
        return T.LongType()
    if name in DECIMAL_COLUMNS:
        return T.DoubleType()
    if name == "reservation_status_date":
        return T.DateType()
    return T.StringType()


SILVER_SCHEMA = T.StructType(
    [T.StructField(c, _raw_type(c), True) for c in RAW_COLUMNS]
    + [
        T.StructField("arrival_month_num", T.IntegerType(), True),
        T.StructField("arrival_date", T.DateType(), True),
        T.StructField("total_nights", T.LongType(), True),
        T.StructField("total_guests", T.LongType(), True),
        T.StructField("estimated_revenue", T.DoubleType(), True),
        T.StructField("data_quality_status", T.StringType(), True),
    ]
)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_I, _S, _D, _L, _F = T.IntegerType(), T.StringType(), T.DateType(), T.LongType(), T.DoubleType()

# Gold dimension tables (types and NOT NULL flags of the reference's DDL).
DIM_DATE_SCHEMA = _struct(
    ("date_key", _I, False), ("full_date", _D, False), ("year", _I, False),
    ("month_number", _I, False), ("month_name", _S, False), ("week_number", _I, True),
    ("day_of_month", _I, False), ("quarter", _I, False),
)
DIM_HOTEL_SCHEMA = _struct(("hotel_key", _I, False), ("hotel", _S, False))
DIM_CUSTOMER_SCHEMA = _struct(
    ("customer_key", _I, False), ("country", _S, True), ("customer_type", _S, True),
    ("is_repeated_guest", _I, True),
)
DIM_ROOM_SCHEMA = _struct(
    ("room_key", _I, False), ("reserved_room_type", _S, True), ("assigned_room_type", _S, True),
)
DIM_CHANNEL_SCHEMA = _struct(
    ("channel_key", _I, False), ("market_segment", _S, True), ("distribution_channel", _S, True),
)

DIMENSION_SCHEMAS = {
    "dim_date": DIM_DATE_SCHEMA,
    "dim_hotel": DIM_HOTEL_SCHEMA,
    "dim_customer": DIM_CUSTOMER_SCHEMA,
    "dim_room": DIM_ROOM_SCHEMA,
    "dim_channel": DIM_CHANNEL_SCHEMA,
}

# Natural (business) columns of each dimension, in the order its surrogate key follows.
DIMENSION_MEMBERS = {
    "dim_hotel": ("hotel",),
    "dim_customer": ("country", "customer_type", "is_repeated_guest"),
    "dim_room": ("reserved_room_type", "assigned_room_type"),
    "dim_channel": ("market_segment", "distribution_channel"),
}
DIMENSION_KEYS = {
    "dim_date": "date_key",
    "dim_hotel": "hotel_key",
    "dim_customer": "customer_key",
    "dim_room": "room_key",
    "dim_channel": "channel_key",
}

FACT_KEYS = ("date_key", "hotel_key", "customer_key", "room_key", "channel_key")
FACT_MEASURES = (
    "lead_time", "stays_in_weekend_nights", "stays_in_week_nights", "total_nights",
    "adults", "children", "babies", "total_guests",
    "adr", "estimated_revenue",
    "is_canceled", "is_repeated_guest",
    "previous_cancellations", "previous_bookings_not_canceled", "booking_changes",
    "days_in_waiting_list",
    "required_car_parking_spaces", "total_of_special_requests",
    "meal", "deposit_type",
    "reservation_status", "reservation_status_date",
    "agent", "company",
)
FACT_COLUMNS = ("booking_key",) + FACT_KEYS + FACT_MEASURES

# The reference numbers bookings by these five columns; they are not unique, so the rest of the
# fact row is appended to make the order total (see operators/numbering.py).
BOOKING_ORDER = ("arrival_date", "hotel", "lead_time", "adr", "reservation_status_date")
