"""Column expressions that turn raw text into typed values.

All are built-in Spark expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from roomledger.schema import MISSING_TOKENS, MONTH_NAMES

# What Spark's cast to double reads beyond a plain decimal number with optional blanks, sign, fraction and
# exponent (which is what pandas.to_numeric accepts): suffixes, hexadecimal numbers, names of special values, and
# control characters around the number. A text with any of these characters is no number here.
NOT_IN_NUMBERS = "dDfFxXpPnNiI" + "".join(map(chr, (*range(9), *range(14, 32))))
BLANKS = " \t\n\v\f\r"


def clean_column_name(name: str) -> str:
    """Trim, lower-case, every single space to an underscore (``'A  B'`` -> ``'a__b'``)."""
    return name.strip().lower().replace(" ", "_")


def missing_tokens(tokens: Iterable[str] = MISSING_TOKENS) -> list[Column]:
    """The tokens as literal columns, built once and shared by every column's test."""
    return [F.lit(t) for t in tokens]


def null_if_missing(col: Column, tokens: list[Column] | None = None) -> Column:
    """NULL when the whole cell equals one of the missing-value tokens (exact match)."""
    return F.when(~col.isin(*(tokens if tokens is not None else missing_tokens())), col)


def to_double(col: Column) -> Column:
    """Text -> double; anything that is not a plain decimal number becomes NULL."""
    return F.when(F.translate(col, NOT_IN_NUMBERS, "") == col, col.try_cast("double"))


def whole_number(number: Column, name: str = "value") -> Column:
    """A parsed double -> bigint (``1.0`` -> 1). A fractional number cannot become an integer;
    like the reference, that stops the job."""
    return F.when(number == F.floor(number), number.cast("bigint")).when(
        number.isNotNull(), F.raise_error(F.lit(f"fractional value in integer column {name}"))
    )


def month_number(month_name: Column) -> Column:
    """English month name -> 1..12; any other text (or NULL) -> NULL."""
    expr = F.when(F.lit(False), F.lit(None))
    for number, name in enumerate(MONTH_NAMES, start=1):
        expr = expr.when(month_name == name, F.lit(number))
    return expr.cast("int")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """A calendar date, or NULL when a part is missing or the date does not exist (31 Feb).

    Checked arithmetically (month 1-12, day within the month) before ``make_date``, which would
    raise on an impossible date; cheaper per row than formatting and parsing a text date.
    """
    in_range = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    month_days = F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))
    return F.when(in_range, F.when(day <= month_days, F.make_date(year, month, day)))


def blank_to_null(col: Column) -> Column:
    """Empty or whitespace-only text -> NULL (the warehouse load's EMPTYASNULL/BLANKSASNULL)."""
    return F.when(F.trim(col, F.lit(BLANKS)) != "", col)


def text_to_date(col: Column) -> Column:
    """ISO date text -> date, NULL if unparseable."""
    return col.try_cast("date")
