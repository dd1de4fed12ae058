"""Unit tests on literal rows, one per semantic rule of SURVEY §1.4 (FIXTURES.md §5 cases)."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from conftest import raw_frame
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from roomledger.operators import gold as G
from roomledger.operators import quality as Q
from roomledger.operators import silver as S
from roomledger.operators import views as V
from roomledger.operators.numbering import ascending, number_large, number_small
from roomledger.schema import SILVER_SCHEMA
from conftest import scratch_dir
from roomledger.sources.csv import normalise_missing, read_raw_csv, write_csv
from roomledger.sources.tables import read_current, replace_table


def silver_of(spark, rows):
    return S.build_silver(normalise_missing(raw_frame(spark, rows)))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_missing_tokens_fill_and_blanks(spark):
    # Children NA/'' -> 0; country NULL -> UNKNOWN; a blank country stays blank
    # through the fill and only becomes NULL at load.
    rows = [
        {"children": "NA", "country": "NULL", "lead_time": "1"},
        {"children": "", "country": "  ", "lead_time": "2"},
        {"children": "abc", "lead_time": "3"},
    ]
    typed = {r.lead_time: r for r in S.typed_bookings(normalise_missing(raw_frame(spark, rows))).collect()}
    assert typed[1].children == 0 and typed[1].country == "UNKNOWN"
    assert typed[2].children == 0 and typed[2].country == "  "
    assert typed[3].children is None
    silver = {r.lead_time: r for r in silver_of(spark, rows).collect()}
    assert set(silver) == {1, 2}  # unparseable children -> NULL -> dropped by the structural filter
    assert silver[2].country is None


def test_numeric_coercion(spark):
    # Pandas-like numbers; through double, so "1.0" and "1e2" are whole numbers.
    rows = [
        {"lead_time": "1e2", "adults": "1.0", "agent": " 7 "},
        {"lead_time": "5d", "agent": "0x1", "adr": "12,5"},
        {"lead_time": "+3", "agent": "", "adr": ".5"},
    ]
    got = [(r.lead_time, r.adults, r.agent, r.adr) for r in S.typed_bookings(normalise_missing(raw_frame(spark, rows))).collect()]
    assert got == [(100, 1, 7, 100.5), (None, 2, None, None), (3, 2, None, 0.5)]


def test_fractional_integer_stops_the_job(spark):
    with pytest.raises(PySparkException):
        S.typed_bookings(normalise_missing(raw_frame(spark, [{"lead_time": "1.5"}]))).collect()


def test_arrival_dates(spark):
    # Exact English month names; impossible dates and missing parts give NULL.
    rows = [
        {"arrival_date_month": "July", "arrival_date_day_of_month": "31"},
        {"arrival_date_month": "july"},
        {"arrival_date_month": " July"},
        {"arrival_date_month": "February", "arrival_date_day_of_month": "29"},
        {"arrival_date_month": "February", "arrival_date_day_of_month": "29", "arrival_date_year": "2015"},
        {"arrival_date_month": "June", "arrival_date_day_of_month": "31"},
        {"arrival_date_year": ""},
        {"arrival_date_day_of_month": "0"},
    ]
    df = S.typed_bookings(normalise_missing(raw_frame(spark, rows))).transform(S.add_arrival_date)
    got = [(r.arrival_month_num, r.arrival_date) for r in df.collect()]
    assert got == [
        (7, dt.date(2016, 7, 31)),
        (None, None),
        (None, None),
        (2, dt.date(2016, 2, 29)),
        (2, None),
        (6, None),
        (7, None),
        (7, None),
    ]


def test_quality_labels(spark):
    # Last rule wins; "canceled" means reservation_status = 'Canceled'.
    c = {"reservation_status": "Canceled", "is_canceled": "1"}
    rows = [
        {"adr": "-1", "lead_time": "1"},
        {"adr": "5001", **c, "lead_time": "2"},
        {"adr": "5001", "reservation_status": "No-Show", "lead_time": "3"},
        {"adr": "5000", **c, "lead_time": "4"},
        {"adults": "21", "adr": "0", **c, "lead_time": "5"},
        {"adults": "20", "adr": "0", **c, "lead_time": "6"},
        {"adr": "", "lead_time": "7"},
        {"adults": "21", "adr": "0", "is_canceled": "1", "lead_time": "8"},
    ]
    got = {r.lead_time: r.data_quality_status for r in silver_of(spark, rows).collect()}
    assert got == {
        1: "INVALID_ADR",
        2: "INVALID_EXTREME_ADR",
        3: "VALID",
        4: "VALID",
        5: "INVALID_EXTREME_OCCUPANCY",
        6: "VALID",
        7: "VALID",
        8: "VALID",
    }


def test_structural_filter_drops_negative_and_null(spark):
    # S5, C1; the rejects are the complement.
    rows = [
        {"lead_time": "1"},
        {"adults": "-1", "lead_time": "2"},
        {"adults": "", "lead_time": "3"},
        {"babies": "-1", "lead_time": "4"},
        {"stays_in_weekend_nights": "-3", "stays_in_week_nights": "2", "lead_time": "5"},
        {"children": "-1", "lead_time": "6"},
    ]
    derived = S.derived_bookings(normalise_missing(raw_frame(spark, rows)))
    assert [r.lead_time for r in S.filter_structural(derived).collect()] == [1]
    assert sorted(r.lead_time for r in S.structural_rejects(derived).collect()) == [2, 3, 4, 5, 6]


def test_dedupe_before_blank_to_null(spark):
    # Exact copies collapse; '' (missing) and '  ' (blank) differ at dedupe time and
    # both become NULL at load, leaving two equal silver rows.
    rows = [{}, {}, {"hotel": ""}, {"hotel": "  "}]
    got = sorted((r.hotel or "<null>") for r in silver_of(spark, rows).collect())
    assert got == ["<null>", "<null>", "City Hotel"]


def test_duplicate_probe_collision(spark):
    # S14: '1'+'12' and '11'+'2' concatenate to the same text; the MD5 probe counts a duplicate,
    # the exact probe does not.
    rows = [{"adults": "1", "children": "12"}, {"adults": "11", "children": "2"}]
    s = silver_of(spark, rows)
    assert one(Q.duplicates_md5(s)).possible_duplicates == 1
    assert one(Q.duplicates_exact(s)).possible_duplicates == 0


def test_lead_time_bands(spark):
    # Edges, negative and NULL.
    values = ["-5", "7", "8", "30", "31", "60", "61", "90", "91", "180", "181", ""]
    s = silver_of(spark, [{"lead_time": v, "agent": str(i)} for i, v in enumerate(values)])
    dims = G.build_dimensions(s)
    got = {(r.lead_time_range, r.total_bookings) for r in V.booking_by_lead_time(G.fact_rows(s, dims)).collect()}
    assert got == {
        ("0-7 dias", 2), ("8-30 dias", 2), ("31-60 dias", 2), ("61-90 dias", 2), ("91-180 dias", 2), ("181+ dias", 2)
    }


def test_consistency_checks_on_literal_silver(spark):
    # S15, Q16-Q18: '!=' with NULL operands counts as consistent; tolerance 0.01 on revenue.
    base = {f.name: None for f in SILVER_SCHEMA.fields}

    def row(**kw):
        r = {**base, "stays_in_weekend_nights": 1, "stays_in_week_nights": 2, "total_nights": 3, "adults": 2,
             "children": 0, "babies": 0, "total_guests": 2, "adr": 10.0, "estimated_revenue": 30.0}
        r.update(kw)
        return tuple(r[f.name] for f in SILVER_SCHEMA.fields)

    data = [
        row(),
        row(total_nights=4, estimated_revenue=40.0),
        row(total_guests=5),
        row(estimated_revenue=30.005),  # within tolerance (30.01 - 30.0 exceeds 0.01 in double)
        row(estimated_revenue=30.011),
        row(total_nights=None, adults=None),
    ]
    got = one(Q.consistency(spark.createDataFrame(data, SILVER_SCHEMA)))
    assert (got.nights_inconsistent, got.guests_inconsistent, got.revenue_inconsistent) == (1, 1, 1)


def test_date_fanout_is_kept_and_reported(spark):
    # One date seen with two week numbers -> two dim_date rows with one key -> fact fan-out.
    rows = [{"lead_time": "1"}, {"lead_time": "2", "arrival_date_week_number": "28"}]
    s = silver_of(spark, rows)
    dims = G.build_dimensions(s)
    assert dims["dim_date"].rows == 2
    fact = G.build_fact(s, dims)
    assert fact.count() == 4
    uniq = {r.table_name: r.duplicate_keys for r in Q.key_uniqueness(dims).collect()}
    assert uniq["dim_date"] == 1 and uniq["dim_hotel"] == 0
    rec = one(Q.reconciliation(s, G.fact_rows(s, dims)))
    assert (rec.valid_rows, rec.joinable_rows, rec.fact_rows, rec.fanout_rows) == (2, 2, 4, 2)
    assert sorted(r.booking_key for r in fact.collect()) == [1, 2, 3, 4]


def test_null_members_sort_last_and_join_null_safe(spark):
    # NULL members are kept in customer/room/channel dims, numbered last, and matched.
    rows = [{"country": "  ", "lead_time": "1"}, {"country": "AAA", "lead_time": "2"}, {"country": "ZZZ", "lead_time": "3"}]
    s = silver_of(spark, rows)
    dims = G.build_dimensions(s)
    keys = {r.country: r.customer_key for r in dims["dim_customer"].df.collect()}
    assert keys == {"AAA": 1, "ZZZ": 2, None: 3}
    assert G.fact_rows(s, dims).count() == 3


def test_hotel_and_date_null_rows_leave_the_fact(spark):
    rows = [{"lead_time": "1"}, {"hotel": "  ", "lead_time": "2"}, {"arrival_date_month": "Foo", "lead_time": "3"}]
    s = silver_of(spark, rows)
    dims = G.build_dimensions(s)
    assert [r.lead_time for r in G.fact_rows(s, dims).collect()] == [1]
    assert one(Q.reconciliation(s, G.fact_rows(s, dims))).dropped_rows == 2


def test_empty_input(spark):
    # S13 and empty fact: report still produced; V1 one row with count 0; V2-V5 no rows.
    s = silver_of(spark, [{"adults": "-1"}])
    assert s.count() == 0
    report = {r.check_name: r.outcome for r in Q.quality_report(s).collect()}
    assert report["volume_not_empty"] == "ERROR" and report["volume_expected_minimum"] == "OK"
    with pytest.raises(Q.QualityGateError):
        Q.enforce(Q.quality_report(s))
    dims = G.build_dimensions(s)
    fact = G.fact_rows(s, dims)
    v1 = one(V.booking_overview(fact))
    assert v1.total_bookings == 0 and v1.canceled_bookings is None and v1.cancellation_rate is None
    assert v1.total_estimated_revenue is None and v1.avg_adr is None
    for name in ("vw_booking_by_lead_time", "vw_booking_seasonality_hotel", "vw_booking_by_channel", "vw_room_match"):
        assert V.VIEWS[name](fact, dims).count() == 0


def test_gate_passes_with_warnings_and_fails_on_negative_adr(spark):
    ok = silver_of(spark, [{"lead_time": "1"}, {"lead_time": "2", "adr": "90"}])
    assert Q.enforce(Q.quality_report(ok)) == [("volume_expected_minimum", 2)]
    bad = silver_of(spark, [{"adr": "-3"}])  # S12: labelled INVALID_ADR yet an error for the gate
    with pytest.raises(Q.QualityGateError, match="adr_invalid=1"):
        Q.enforce(Q.quality_report(bad))


def test_room_match_null_types(spark):
    # A NULL room type counts as neither match nor change.
    rows = [{"lead_time": "1"}, {"assigned_room_type": "B", "lead_time": "2"}, {"reserved_room_type": "", "lead_time": "3"}]
    s = silver_of(spark, rows)
    dims = G.build_dimensions(s)
    got = {(r.reserved_room_type, r.assigned_room_type): (r.matched_bookings, r.changed_bookings)
           for r in V.room_match(G.fact_rows(s, dims), dims).collect()}
    assert got == {("A", "A"): (1, 0), ("A", "B"): (0, 1), (None, "A"): (0, 0)}


def test_canceled_outside_domain(spark):
    # is_canceled other than 0/1 counts in neither canceled nor confirmed.
    rows = [{"is_canceled": "1", "lead_time": "1"}, {"is_canceled": "2", "lead_time": "2"}, {"is_canceled": "", "lead_time": "3"}]
    s = silver_of(spark, rows)
    dims = G.build_dimensions(s)
    v1 = one(V.booking_overview(G.fact_rows(s, dims)))
    assert (v1.total_bookings, v1.canceled_bookings, v1.confirmed_bookings, v1.cancellation_rate) == (3, 1, 0, 33.33)
    assert one(Q.ranges(s)).is_canceled_invalid == 1


def test_distributed_numbering_matches_single_task_window(spark):
    # Range-partitioned numbering equals ROW_NUMBER over one partition, with a third of the
    # rows sharing the leading key (skew) and NULLs in the order columns.
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 97).alias("a"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 13).alias("b"),
        F.col("id"),
    )
    order = ascending(["a", "b", "id"])
    big = {(r.a, r.b, r.id): r.k for r in number_large(df, order, "k", partitions=7).collect()}
    small = {(r.a, r.b, r.id): r.k for r in number_small(df, order, "k").collect()}
    assert big == small
    assert sorted(big.values()) == list(range(1, 3001))


def test_csv_round_trip_with_dirty_tokens(spark):
    rows = [{"country": "NULL", "children": "NA"}, {"hotel": "  ", "lead_time": "5"}, {"adr": "", "lead_time": "6"},
            {"meal": 'say "hi", ok', "lead_time": "7"}]
    direct = silver_of(spark, rows)
    path = scratch_dir() + "/raw_csv"
    write_csv(raw_frame(spark, rows), path)
    via_csv = S.build_silver(read_raw_csv(spark, path))
    assert Counter(map(tuple, via_csv.collect())) == Counter(map(tuple, direct.collect()))


def test_versioned_table_replace(spark):
    root = scratch_dir()
    replace_table(spark.range(3), root, "t")
    replace_table(spark.range(5), root, "t")
    assert read_current(spark, root, "t").count() == 5
