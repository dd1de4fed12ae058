"""Raw bookings -> silver bookings.

Each step is a pure ``DataFrame -> DataFrame`` function chained with ``DataFrame.transform``. All
steps are narrow projections/filters that Catalyst fuses into one whole-stage-codegen span over
the scan, except the full-row dedupe, which is the only shuffle of the silver build; its partial
aggregation collapses exact copies map-side, so even a value repeated in a third of all rows is
reduced before the exchange.

The order of the null treatments matters and is kept: ``children`` is filled before numbers are
parsed (missing -> 0, unparseable -> NULL -> row dropped by the structural filter); ``country`` is
filled before the dedupe, blanks become NULL only after it (as the warehouse load did).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomledger.functions.parsing import (
    blank_to_null,
    clean_column_name,
    date_from_parts,
    month_number,
    text_to_date,
    to_double,
    whole_number,
)
from roomledger.schema import (
    CANCELED_STATUS,
    DECIMAL_COLUMNS,
    EXTREME_ADR,
    EXTREME_ADULTS,
    INTEGER_COLUMNS,
    SILVER_COLUMNS,
    STATUS_INVALID_ADR,
    STATUS_INVALID_EXTREME_ADR,
    STATUS_INVALID_EXTREME_OCCUPANCY,
    STATUS_VALID,
    TEXT_COLUMNS,
)


ROW = "_row"  # of the barrier


def _replace(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Replace some columns in place, keeping the column order (one projection)."""
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def clean_column_names(df: DataFrame) -> DataFrame:
    """B1: trim, lower case, spaces to underscores."""
    return df.toDF(*[clean_column_name(c) for c in df.columns])


def fill_missing(df: DataFrame) -> DataFrame:
    """B2: ``children`` missing -> 0, ``country`` missing -> ``UNKNOWN``."""
    return _replace(
        df,
        {
            "children": F.coalesce(F.col("children"), F.lit("0")),
            "country": F.coalesce(F.col("country"), F.lit("UNKNOWN")),
        },
    )


def convert_types(df: DataFrame) -> DataFrame:
    """19 integer columns and ``adr`` from text; bad numbers -> NULL.

    Two projections: text -> double first, then the whole-number check on that double. Each
    parse happens once per value, and the generated code stays small enough for the JIT.
    """
    parsed = _replace(df, {c: to_double(F.col(c)) for c in INTEGER_COLUMNS + DECIMAL_COLUMNS})
    return _replace(parsed, {c: whole_number(F.col(c), c) for c in INTEGER_COLUMNS})


def evaluated_once(df: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` behind a barrier: filters and projections above it read its columns, not their expressions.

    The optimizer pushes a filter below a projection by writing the projection's expressions into the
    filter, which would parse the text of every filtered column twice. It does not push below a
    projection that numbers its rows. The filter has to use the returned condition (always true), or
    the unused number would be pruned and the barrier with it.
    """
    return df.withColumn(ROW, F.monotonically_increasing_id()), F.col(ROW) >= 0


def add_arrival_date(df: DataFrame) -> DataFrame:
    """Month number from the English name, then the calendar date (NULL if impossible)."""
    month = month_number(F.col("arrival_date_month"))
    return df.withColumns(
        {
            "arrival_month_num": month,
            "arrival_date": date_from_parts(F.col("arrival_date_year"), month, F.col("arrival_date_day_of_month")),
        }
    )


def add_stay_measures(df: DataFrame) -> DataFrame:
    """Total nights, total guests, estimated revenue (= adr x nights)."""
    nights = F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")
    return df.withColumn("total_nights", nights).withColumns(
        {
            "total_guests": F.col("adults") + F.col("children") + F.col("babies"),
            "estimated_revenue": F.col("adr") * F.col("total_nights"),
        }
    )


def quality_status(adr: Column, adults: Column, reservation_status: Column) -> Column:
    """B10-B13. The reference applies the rules in turn, the last match winning; written here as
    one CASE from the last rule to the first. A NULL operand never matches."""
    canceled = reservation_status == CANCELED_STATUS
    return (
        F.when((adults > EXTREME_ADULTS) & (adr == 0) & canceled, F.lit(STATUS_INVALID_EXTREME_OCCUPANCY))
        .when((adr > EXTREME_ADR) & canceled, F.lit(STATUS_INVALID_EXTREME_ADR))
        .when(adr < 0, F.lit(STATUS_INVALID_ADR))
        .otherwise(F.lit(STATUS_VALID))
    )


def label_quality(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "data_quality_status", quality_status(F.col("adr"), F.col("adults"), F.col("reservation_status"))
    )


def structural_predicates() -> dict[str, Column]:
    """The five non-negativity rules; a NULL operand fails the rule. The two totals are
    written out, so the rules apply to typed rows before the derived columns exist."""
    nights = F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")
    guests = F.col("adults") + F.col("children") + F.col("babies")
    values = {
        "adults": F.col("adults"),
        "children": F.col("children"),
        "babies": F.col("babies"),
        "total_nights": nights,
        "total_guests": guests,
    }
    return {name: F.coalesce(value >= 0, F.lit(False)) for name, value in values.items()}


def structurally_valid() -> Column:
    cond = F.lit(True)
    for predicate in structural_predicates().values():
        cond = cond & predicate
    return cond


def filter_structural(df: DataFrame) -> DataFrame:
    typed, once = evaluated_once(df)
    return typed.where(structurally_valid() & once).drop(ROW)


def structural_rejects(df: DataFrame) -> DataFrame:
    """Rows removed by C1 (the reference drops them silently; kept here for inspection)."""
    typed, once = evaluated_once(df)
    return typed.where(~structurally_valid() & once).drop(ROW)


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Full-row dedupe; NULL equals NULL."""
    return df.dropDuplicates()


def finalize_load(df: DataFrame) -> DataFrame:
    """A4 semantics of the warehouse load: blank/empty text -> NULL, status date text -> DATE."""
    exprs = {c: blank_to_null(F.col(c)) for c in TEXT_COLUMNS if c != "reservation_status_date"}
    exprs["reservation_status_date"] = text_to_date(blank_to_null(F.col("reservation_status_date")))
    return _replace(df, exprs)


def typed_bookings(raw: DataFrame) -> DataFrame:
    """B1-B4 on normalised raw text."""
    return raw.transform(clean_column_names).transform(fill_missing).transform(convert_types)


def derive(typed: DataFrame) -> DataFrame:
    """B5-B13 on typed rows: every derived column and the quality label."""
    return (
        typed.transform(add_arrival_date)
        .transform(add_stay_measures)
        .transform(label_quality)
        .select(*SILVER_COLUMNS)
    )


def derived_bookings(raw: DataFrame) -> DataFrame:
    """Typed rows with every derived column and the quality label, before any row is removed."""
    return derive(typed_bookings(raw))


def processed(raw: DataFrame) -> DataFrame:
    """The processed bookings (A3): filtered, without duplicates, with derived columns, texts as they are.

    The original wrote these to its CSV; only the later load turned blanks into NULL and the status date
    into a date.
    """
    return typed_bookings(raw).transform(filter_structural).transform(remove_duplicates).transform(derive)


def build_silver(raw: DataFrame) -> DataFrame:
    """Raw text (missing tokens already NULL) -> silver bookings, 38 columns.

    The reference derives, filters, then removes duplicate rows over all 38 columns. The six
    derived columns are functions of the 32 typed ones, so rows are equal on 38 columns exactly
    when they are equal on the 32: the dedupe runs on the 32 typed columns and the derivation
    happens after the shuffle, in the (parallel) reduce stage, on fewer rows and with a narrower
    shuffle. The structural rules are evaluated on the typed values directly.
    """
    return processed(raw).transform(finalize_load).select(*SILVER_COLUMNS)
