"""Column expressions for derived measures, labels and aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roomledger.schema import LEAD_TIME_BANDS, OPEN_LEAD_TIME_BAND, QUARTERS


def date_key(date: Column) -> Column:
    """``yyyyMMdd`` of a date as an integer (20150701)."""
    return F.date_format(date, "yyyyMMdd").cast("int")


def quarter_of_month(month: Column) -> Column:
    """Quarter 1-4 of a month number; NULL outside 1-12."""
    expr = F.when(F.lit(False), F.lit(None))
    for first, last, quarter in QUARTERS:
        expr = expr.when(month.between(first, last), F.lit(quarter))
    return expr.cast("int")


def lead_time_band(lead_time: Column) -> Column:
    """Band label of a lead time in days; NULL and anything above 180 fall in the open band."""
    expr = F.when(F.lit(False), F.lit(None))
    for upper, label in LEAD_TIME_BANDS:
        expr = expr.when(lead_time <= upper, F.lit(label))
    return expr.otherwise(F.lit(OPEN_LEAD_TIME_BAND))


def indicator(predicate: Column) -> Column:
    """1 when the predicate is true, else 0 (NULL counts as 0)."""
    return F.when(predicate, F.lit(1)).otherwise(F.lit(0))


def count_where(predicate: Column) -> Column:
    """Number of rows where the predicate is true, as bigint (0 on empty input)."""
    return F.coalesce(F.sum(indicator(predicate)).cast("bigint"), F.lit(0).cast("bigint"))


def sum_where(predicate: Column) -> Column:
    """SUM(CASE WHEN p THEN 1 ELSE 0 END): like count_where but NULL on empty input."""
    return F.sum(indicator(predicate)).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded to 2 decimals; NULL when whole is 0 (no division error)."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)


def mean2(col: Column) -> Column:
    """Mean rounded to 2 decimals, always fractional (no integer truncation)."""
    return F.round(F.sum(col.cast("double")) / F.nullif(F.count(col), F.lit(0)), 2)


def exact(col: Column) -> Column:
    """A money amount as a decimal with ten fractional digits."""
    return col.cast("decimal(28,10)")


def money_sum(col: Column) -> Column:
    """Exact sum of a money column, returned as double currency units.

    A double sum depends on the order rows arrive in, so the same data could give results that
    differ in the last bits from run to run; a decimal sum does not. Amounts are not rounded.
    """
    return F.sum(exact(col)).cast("double")


def money_mean2(col: Column) -> Column:
    """Mean of a money column (exact sum / count); only the result is rounded, to 2 decimals."""
    count = F.nullif(F.count(col), F.lit(0)).cast("decimal(20,0)")
    return F.round(F.sum(exact(col)) / count, 2).cast("double")
