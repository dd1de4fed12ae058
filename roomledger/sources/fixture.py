"""Adapter: the driver's TPC-H-style tables -> raw booking records (all text), see FIXTURES.md.

The bookings file of the original project is not available, so raw bookings are derived from
``orders JOIN customer JOIN nation`` with deterministic rules, including injected faults
(missing tokens, blanks, bad numbers, impossible dates, extreme values, duplicates). The work
grows linearly with ``orders``; one scan, one join, and the extra copies are produced by an
in-row ``explode`` instead of re-scanning for a UNION.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.operators.joins import join_small
from roomledger.schema import RAW_COLUMNS
from roomledger.session import spread
from roomledger.sources.tables import read_table

ROOM_LETTERS = "ABCDEFGH"
MEALS = ("BB", "HB", "SC", "Undefined")
CUSTOMER_TYPES = ("Transient", "Contract", "Transient-Party", "Group")


def _s(col: Column) -> Column:
    return col.cast("string")


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    expr = F.when(F.lit(False), F.lit(None))
    for i, value in enumerate(values):
        expr = expr.when(index == i, F.lit(value))
    return expr


def _letter(number: Column) -> Column:
    """Letter number ``number`` (1-based) of ROOM_LETTERS."""
    return F.substr(F.lit(ROOM_LETTERS), number.cast("int"), F.lit(1))


def raw_bookings_from_tables(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    o = spread(
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
        "o_orderkey",
    )
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    # nation is a fixed-size code table; customers are broadcast only while their measured count is
    # below the bound (at scale they are not, and orders x customers becomes a shuffle join). An
    # explicit check, because the planner's size estimate for a join is the product of its inputs.
    cn = join_small(c, n, c["c_nationkey"] == n["n_nationkey"]).drop("n_nationkey")
    base = join_small(o, cn, o["o_custkey"] == cn["c_custkey"])

    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    od = F.to_date(F.col("o_orderdate"))
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint") % 50000
    status = (
        F.when((F.col("o_orderstatus") == "F") | (k % 1213 == 7) | (k % 907 == 5), F.lit("Canceled"))
        .when(k % 11 == 0, F.lit("No-Show"))
        .otherwise(F.lit("Check-Out"))
    )
    copy_tags = F.filter(
        F.array(F.lit(0), F.when(k % 50 == 0, F.lit(1)), F.when(k % 75 == 1, F.lit(2))),
        lambda x: x.isNotNull(),
    )
    base = base.select("*", status.alias("_status"), cents.alias("_cents"), od.alias("_od"))
    status, cents, od = F.col("_status"), F.col("_cents"), F.col("_od")

    columns = {
        "hotel": F.when(k % 1013 == 9, F.lit("  ")).when(k % 3 == 0, F.lit("City Hotel")).otherwise(F.lit("Resort Hotel")),
        "is_canceled": F.when(k % 1511 == 3, F.lit("")).when(k % 1601 == 4, F.lit("2"))
        .when(status == "Check-Out", F.lit("0")).otherwise(F.lit("1")),
        "lead_time": F.when(k % 1301 == 6, F.lit("")).otherwise(_s((k * 37) % 400)),
        "arrival_date_year": _s(F.year(od)),
        "arrival_date_month": F.when(k % 1401 == 8, F.lit("Foo")).when(k % 1451 == 2, F.lit("February"))
        .otherwise(F.date_format(od, "MMMM")),
        "arrival_date_week_number": _s(F.weekofyear(od)),
        "arrival_date_day_of_month": F.when(k % 1451 == 2, F.lit("31")).otherwise(_s(F.dayofmonth(od))),
        "stays_in_weekend_nights": F.when(k % 1709 == 1, F.lit("-9")).otherwise(_s(k % 3)),
        "stays_in_week_nights": _s(k % 5),
        "adults": F.when(k % 907 == 5, F.lit("26")).when(k % 1811 == 2, F.lit("-1")).otherwise(_s(k % 3 + 1)),
        "children": F.when(k % 1901 == 3, F.lit("abc")).when(k % 13 == 0, F.lit("NA"))
        .otherwise(F.concat(_s(k % 4), F.lit(".0"))),
        "babies": _s(k % 2),
        "meal": _pick(k % 4, MEALS),
        "country": F.when(k % 17 == 0, F.lit("NULL")).otherwise(F.col("n_name")),
        "market_segment": F.when(k % 1201 == 5, F.lit("")).otherwise(F.col("c_mktsegment")),
        "distribution_channel": F.col("o_orderpriority"),
        "is_repeated_guest": F.when(ck % 10 == 0, F.lit("1")).otherwise(F.lit("0")),
        "previous_cancellations": _s(k % 2),
        "previous_bookings_not_canceled": _s(k % 3),
        "reserved_room_type": F.when(k % 1103 == 4, F.lit("")).otherwise(_letter(k % 8 + 1)),
        "assigned_room_type": F.when(k % 6 == 0, _letter((k + 1) % 8 + 1)).otherwise(_letter(k % 8 + 1)),
        "booking_changes": _s(k % 4),
        "deposit_type": F.when(k % 9 == 0, F.lit("Non Refund")).otherwise(F.lit("No Deposit")),
        "agent": F.when(k % 7 == 0, F.lit("NULL")).otherwise(_s(ck % 300)),
        "company": F.when(k % 19 != 0, F.lit("NULL")).otherwise(_s(ck % 200)),
        "days_in_waiting_list": _s(k % 21),
        "customer_type": _pick(F.col("c_nationkey") % 4, CUSTOMER_TYPES),
        "adr": F.when(k % 1009 == 3, F.lit("-6.38")).when(k % 1213 == 7, F.lit("5400.0"))
        .when(k % 907 == 5, F.lit("0.0")).when(k % 1999 == 6, F.lit(""))
        .when(k % 97 == 13, F.concat(_s(F.floor(cents / 100)), F.lit("."), F.lpad(_s(cents % 100), 2, "0"), F.lit("5")))
        .otherwise(F.concat(_s(F.floor(cents / 100)), F.lit("."), F.lpad(_s(cents % 100), 2, "0"))),
        "required_car_parking_spaces": _s(k % 2),
        "total_of_special_requests": _s(k % 6),
        "reservation_status": status,
        "reservation_status_date": F.date_format(F.date_sub(od, 3), "yyyy-MM-dd"),
    }
    rows = base.select(F.explode(copy_tags).alias("_copy"), *[columns[c].alias(c) for c in RAW_COLUMNS])
    # Copy 2 differs in ``meal`` only: it survives the full-row dedupe but not the 9-column probe.
    return rows.withColumn("meal", F.when(F.col("_copy") == 2, F.lit("FB")).otherwise(F.col("meal"))).select(
        *RAW_COLUMNS
    )


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_bookings_from_tables(
        read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation")
    )
