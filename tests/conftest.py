from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from roomledger.schema import RAW_COLUMNS  # noqa: E402
from roomledger.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", app="roomledger-tests")
    yield session
    session.stop()


# A valid raw booking as text; tests override single cells.
BASE_ROW = {
    "hotel": "City Hotel",
    "is_canceled": "0",
    "lead_time": "10",
    "arrival_date_year": "2016",
    "arrival_date_month": "July",
    "arrival_date_week_number": "27",
    "arrival_date_day_of_month": "1",
    "stays_in_weekend_nights": "1",
    "stays_in_week_nights": "2",
    "adults": "2",
    "children": "0",
    "babies": "0",
    "meal": "BB",
    "country": "PRT",
    "market_segment": "Online TA",
    "distribution_channel": "TA/TO",
    "is_repeated_guest": "0",
    "previous_cancellations": "0",
    "previous_bookings_not_canceled": "0",
    "reserved_room_type": "A",
    "assigned_room_type": "A",
    "booking_changes": "0",
    "deposit_type": "No Deposit",
    "agent": "9",
    "company": "NULL",
    "days_in_waiting_list": "0",
    "customer_type": "Transient",
    "adr": "100.50",
    "required_car_parking_spaces": "0",
    "total_of_special_requests": "1",
    "reservation_status": "Check-Out",
    "reservation_status_date": "2016-07-04",
}


def raw_frame(spark, rows: list[dict]):
    """Raw bookings (text, missing tokens not yet normalised) from overrides of BASE_ROW."""
    data = [tuple({**BASE_ROW, **r}[c] for c in RAW_COLUMNS) for r in rows]
    schema = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    return spark.createDataFrame(data, schema)


def scratch_dir(prefix: str = "roomledger-") -> str:
    """A new local scratch folder."""
    return tempfile.mkdtemp(prefix=prefix)
