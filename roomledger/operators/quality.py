"""Data-quality checks of silver and gold.

The reference ran five separate scans, each bringing one row to the client. Here all counting
checks are one fused aggregate. Where silver is being written anyway (``observed``) they are metrics of
that write (``DataFrame.observe``) and cost no scan at all; the duplicate probe then reads nine columns of
what was written. It is the only check that shuffles (a 16-byte hash, or the 9 key columns), and its partial
aggregation removes repeated values map-side. The report is a small long-format DataFrame; the
gate is a separate call that raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from roomledger.functions.measures import count_where, date_key
from roomledger.operators.gold import Dimension, valid
from roomledger.operators.joins import small_side
from roomledger.schema import (
    DIMENSION_KEYS,
    DIMENSION_SCHEMAS,
    EMPTY,
    EXPECTED_MIN_ROWS,
    FACT_KEYS,
    FACT_MEASURES,
    REVENUE_TOLERANCE,
)

ERROR, WARNING, OK = "ERROR", "WARNING", "OK"

NULL_CHECK_COLUMNS = ("hotel", "is_canceled", "arrival_date_year", "arrival_date_month", "adr")
DUPLICATE_KEY_COLUMNS = (
    "hotel", "is_canceled", "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month",
    "adults", "children", "babies", "adr",
)
NON_NEGATIVE_COLUMNS = ("adults", "children", "babies", "total_nights", "total_guests")


def null_checks() -> dict[str, Column]:
    """Q3-Q7: NULLs in the critical columns."""
    return {f"null_{c}": count_where(F.col(c).isNull()) for c in NULL_CHECK_COLUMNS}


def range_checks() -> dict[str, Column]:
    """Q9-Q15: out-of-range values (NULL operands are not counted)."""
    checks = {
        "adr_invalid": count_where(F.col("adr") < 0),
        "is_canceled_invalid": count_where(~F.col("is_canceled").isin(0, 1)),
    }
    checks.update({f"{c}_invalid": count_where(F.col(c) < 0) for c in NON_NEGATIVE_COLUMNS})
    return checks


def consistency_checks() -> dict[str, Column]:
    """Q16-Q18: derived columns against their formulas (``!=``; NULL operands count as consistent)."""
    return {
        "nights_inconsistent": count_where(
            F.col("total_nights") != F.col("stays_in_weekend_nights") + F.col("stays_in_week_nights")
        ),
        "guests_inconsistent": count_where(
            F.col("total_guests") != F.col("adults") + F.col("children") + F.col("babies")
        ),
        "revenue_inconsistent": count_where(
            F.abs(F.col("estimated_revenue") - F.col("adr") * F.col("total_nights")) > REVENUE_TOLERANCE
        ),
    }


def _agg(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return df.agg(*[expr.alias(name) for name, expr in checks.items()])


def volume(silver: DataFrame, expected_min_rows: int = EXPECTED_MIN_ROWS) -> DataFrame:
    """Q1-Q2: row count with its verdict."""
    n = F.count(F.lit(1))
    return silver.agg(
        n.alias("total_rows"),
        F.when(n == 0, F.lit(ERROR)).when(n < expected_min_rows, F.lit(WARNING)).otherwise(F.lit(OK)).alias(
            "volume_status"
        ),
    )


def nulls(silver: DataFrame) -> DataFrame:
    return _agg(silver, null_checks())


def ranges(silver: DataFrame) -> DataFrame:
    return _agg(silver, range_checks())


def consistency(silver: DataFrame) -> DataFrame:
    return _agg(silver, consistency_checks())


def duplicate_fingerprint() -> Column:
    """Q8 as written in the reference: MD5 over 9 columns concatenated without a separator (so
    ``1`` + ``12`` and ``11`` + ``2`` collide; it only raises a warning)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(EMPTY)) for c in DUPLICATE_KEY_COLUMNS]
    return F.md5(F.concat(*parts))


def duplicates_md5(silver: DataFrame) -> DataFrame:
    """Q8: rows minus distinct fingerprints."""
    return silver.agg(
        (F.count(F.lit(1)) - F.count_distinct(duplicate_fingerprint())).cast("bigint").alias("possible_duplicates")
    )


def duplicates_exact(silver: DataFrame) -> DataFrame:
    """Q8, exact: rows beyond the first of each 9-column key (NULL equals NULL, no collisions)."""
    groups = silver.groupBy(*DUPLICATE_KEY_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("possible_duplicates"))


def postconditions(silver: DataFrame) -> DataFrame:
    """Q21-Q25: the ETL's final assertions as counts (all must be 0; NULLs pass)."""
    return _agg(silver, {f"negative_{c}": count_where(F.col(c) < 0) for c in NON_NEGATIVE_COLUMNS})


def counting_checks() -> dict[str, Column]:
    """The row count and all 15 counting checks (Q1-Q7, Q9-Q18)."""
    return {"total_rows": F.count(F.lit(1)), **null_checks(), **range_checks(), **consistency_checks()}


def observed(silver: DataFrame) -> tuple[DataFrame, Observation]:
    """``silver`` that takes the counting checks as its rows pass, and where they can be read once it is written.

    The metrics are complete after the action that consumes the returned frame. They sit above the last
    shuffle of silver, in the tasks that write; Spark adds up each written partition once, whether or not a task
    had to run again.
    """
    observation = Observation()
    return silver.observe(observation, *[expr.alias(name) for name, expr in counting_checks().items()]), observation


def quality_report(
    silver: DataFrame, expected_min_rows: int = EXPECTED_MIN_ROWS, counts: dict[str, int] | None = None
) -> DataFrame:
    """Q19: every silver check as (check_name, observed, severity, outcome), long format.

    ``counts`` are the metrics taken while ``silver`` was written. Without them one fused aggregate
    computes the row count and all 15 counting checks; ``stack`` turns its single row into rows. The duplicate
    probe is an aggregate of its own over nine columns.
    """
    counting = counting_checks()
    if counts is None:
        fused = _agg(silver, counting)
    else:
        schema = ", ".join(f"{name} bigint" for name in counting)
        fused = silver.sparkSession.createDataFrame([tuple(counts[name] for name in counting)], schema)
    error_checks = [c for c in counting if c != "total_rows"]
    stacked_args = ", ".join(f"'{c}', `{c}`" for c in error_checks)
    long = fused.select(
        F.col("total_rows"),
        F.expr(f"stack({len(error_checks)}, {stacked_args}) as (check_name, observed)"),
    )
    counted = long.select(
        "check_name",
        F.col("observed").cast("bigint").alias("observed"),
        F.lit(ERROR).alias("severity"),
        F.when(F.col("observed") > 0, F.lit(ERROR)).otherwise(F.lit(OK)).alias("outcome"),
    )
    total = F.col("total_rows")
    vol = fused.select(
        F.expr("stack(2, 'volume_not_empty', total_rows, 'volume_expected_minimum', total_rows)").alias(
            "check_name", "observed"
        ),
        total.alias("total_rows"),
    ).select(
        "check_name",
        F.col("observed").cast("bigint").alias("observed"),
        F.when(F.col("check_name") == "volume_not_empty", F.lit(ERROR)).otherwise(F.lit(WARNING)).alias("severity"),
        F.when((F.col("check_name") == "volume_not_empty") & (total == 0), F.lit(ERROR))
        .when((F.col("check_name") == "volume_expected_minimum") & (total > 0) & (total < expected_min_rows), F.lit(WARNING))
        .otherwise(F.lit(OK))
        .alias("outcome"),
    )
    dupes = duplicates_md5(silver).select(
        F.lit("possible_duplicates").alias("check_name"),
        F.col("possible_duplicates").alias("observed"),
        F.lit(WARNING).alias("severity"),
        F.when(F.col("possible_duplicates") > 0, F.lit(WARNING)).otherwise(F.lit(OK)).alias("outcome"),
    )
    return vol.unionByName(counted).unionByName(dupes)


class QualityGateError(RuntimeError):
    pass


def enforce(report: DataFrame) -> list[tuple[str, int]]:
    """Q20: raise if any check failed with severity ERROR; returns the warnings otherwise.

    The report has one row per check (18 rows), so bringing it to the driver is bounded.
    """
    rows = report.collect()
    errors = [(r.check_name, r.observed) for r in rows if r.outcome == ERROR]
    if errors:
        raise QualityGateError("data quality failed: " + ", ".join(f"{c}={n}" for c, n in errors))
    return [(r.check_name, r.observed) for r in rows if r.outcome == WARNING]


# ---------------------------------------------------------------------------------------------
# Gold checks (the reference's gold validation script is missing; these follow its DDL).
# ---------------------------------------------------------------------------------------------


def key_uniqueness(dims: dict[str, Dimension]) -> DataFrame:
    """Per dimension, the number of key values that occur more than once."""
    parts = []
    for name, key in DIMENSION_KEYS.items():
        dup = dims[name].df.groupBy(key).count().where(F.col("count") > 1)
        parts.append(dup.agg(F.count(F.lit(1)).alias("duplicate_keys")).select(F.lit(name).alias("table_name"), "duplicate_keys"))
    return _union(parts)


def not_null_conformance(dims: dict[str, Dimension]) -> DataFrame:
    """Per declared NOT NULL column, the number of NULLs (one aggregate per dimension)."""
    parts = []
    for name, schema in DIMENSION_SCHEMAS.items():
        required = [f.name for f in schema.fields if not f.nullable]
        agg = dims[name].df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in required])
        args = ", ".join(f"'{c}', `{c}`" for c in required)
        parts.append(
            agg.select(F.expr(f"stack({len(required)}, {args}) as (column_name, null_rows)")).select(
                F.lit(name).alias("table_name"), "column_name", F.col("null_rows").cast("bigint")
            )
        )
    return _union(parts)


def orphan_keys(fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """Fact rows whose foreign key has no dimension row, for all five keys in one pass.

    Each dimension's distinct keys (with a marker column) are left-joined to the fact's keys
    through a size-checked broadcast, so the fact is scanned once and not shuffled; a missing
    marker is an orphan. Distinct keys keep a dimension with a duplicated key from multiplying
    fact rows.
    """
    keyed = fact.select(*FACT_KEYS)
    for key, name in zip(FACT_KEYS, DIMENSION_KEYS):
        known = dims[name].df.select(key).distinct().withColumn(f"_known_{key}", F.lit(True))
        keyed = keyed.join(small_side(known, dims[name].rows), key, "left")
    counts = keyed.agg(*[count_where(F.col(f"_known_{k}").isNull()).alias(k) for k in FACT_KEYS])
    args = ", ".join(f"'{k}', `{k}`" for k in FACT_KEYS)
    return counts.select(F.expr(f"stack({len(FACT_KEYS)}, {args}) as (foreign_key, orphan_rows)"))


def reconciliation(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Admissible silver rows against fact rows.

    ``joinable_rows`` are VALID rows with a date and a hotel (customer, room and channel always
    match, since their dimensions keep NULL members); ``fanout_rows`` are fact rows beyond those
    (a date present twice in dim_date).
    """
    joinable = F.col("arrival_date").isNotNull() & F.col("hotel").isNotNull()
    s = valid(silver).select(
        F.lit(1).alias("v"), F.when(joinable, F.lit(1)).otherwise(F.lit(0)).alias("j"), F.lit(0).alias("f")
    )
    f = fact.select(F.lit(0).alias("v"), F.lit(0).alias("j"), F.lit(1).alias("f"))
    totals = s.unionByName(f).agg(
        F.coalesce(F.sum("v"), F.lit(0)).cast("bigint").alias("valid_rows"),
        F.coalesce(F.sum("j"), F.lit(0)).cast("bigint").alias("joinable_rows"),
        F.coalesce(F.sum("f"), F.lit(0)).cast("bigint").alias("fact_rows"),
    )
    return totals.select(
        "valid_rows",
        "joinable_rows",
        "fact_rows",
        (F.col("valid_rows") - F.col("joinable_rows")).alias("dropped_rows"),
        (F.col("fact_rows") - F.col("joinable_rows")).alias("fanout_rows"),
    )


# Fact columns whose values are those of the silver row, and how a silver row's members are spelled in both.
CONTENT_COLUMNS = tuple(c for c in FACT_MEASURES if c not in ("reservation_status_date", "is_repeated_guest"))


def _content(rows: DataFrame, date: Column) -> DataFrame:
    """(date_key, two 64-bit hashes of a booking's whole content); -0.0 counts as 0.0."""
    parts = []
    for c in (*CONTENT_COLUMNS, "reservation_status_date", "is_repeated_guest", *MEMBER_COLUMNS):
        kind = rows.schema[c].dataType.simpleString()
        parts.append(F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)) if kind == "double" else F.col(c).cast("string"))
    # Hashes skip NULLs, so which columns are NULL is hashed as well.
    gaps = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in CONTENT_COLUMNS + MEMBER_COLUMNS])
    return rows.select(
        date.alias("date_key"),
        F.xxhash64(gaps, *parts).alias("first_hash"),
        F.xxhash64(F.lit(1), *reversed(parts), gaps).alias("second_hash"),
    )


MEMBER_COLUMNS = ("hotel", "country", "customer_type", "reserved_room_type", "assigned_room_type", "market_segment", "distribution_channel")


def _contents(silver: DataFrame, fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """Both sides' rows as (side, date_key, hashes); the fact's members are looked up in the dimensions."""
    joinable = valid(silver).where(F.col("arrival_date").isNotNull() & F.col("hotel").isNotNull())
    spelled = fact
    for name, key in DIMENSION_KEYS.items():
        if name != "dim_date":
            members = dims[name].df
            spelled = spelled.join(small_side(members.select(key, *[c for c in members.columns if c in MEMBER_COLUMNS]), dims[name].rows), key, "left")
    return (
        _content(joinable, date_key(F.col("arrival_date"))).withColumn("side", F.lit(1))
        .unionByName(_content(spelled, F.col("date_key")).withColumn("side", F.lit(-1)))
    )


def content_by_date(silver: DataFrame, fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """G1-G2 by content: per date, the rows of silver and fact and whether they are the same bookings.

    Each side's rows of a date are summed up as a multiset: their count and the exact sums of two independent
    64-bit hashes of everything a booking says (measures, and members looked up through the keys), which
    do not depend on the order of rows. A changed value at equal counts changes the sums. Both sides
    are one aggregate over (date); partial sums leave one row per date and task for the shuffle.
    """
    def of(side: int, value: Column) -> Column:
        return F.sum(F.when(F.col("side") == side, value).otherwise(0))

    hashes = [F.col(c).cast("decimal(20,0)") for c in ("first_hash", "second_hash")]
    sums = _contents(silver, fact, dims).groupBy("date_key").agg(
        of(1, F.lit(1)).alias("silver_rows"),
        of(-1, F.lit(1)).alias("fact_rows"),
        *[F.sum(h * F.col("side")).alias(f"difference_{n}") for n, h in enumerate(hashes)],
    )
    same = (F.col("silver_rows") == F.col("fact_rows")) & (F.col("difference_0") == 0) & (F.col("difference_1") == 0)
    return sums.select("date_key", F.col("silver_rows").cast("bigint"), F.col("fact_rows").cast("bigint"), same.alias("same_content"))


def content_differences(silver: DataFrame, fact: DataFrame, dims: dict[str, Dimension]) -> DataFrame:
    """The bookings behind dates whose content differs: (date_key, hashes, silver_rows, fact_rows) that are not equal.

    Only the dates that ``content_by_date`` marks are compared row by row.
    """
    odd = content_by_date(silver, fact, dims).where(~F.col("same_content")).select("date_key")
    rows = _contents(silver, fact, dims).join(F.broadcast(odd), "date_key", "left_semi")  # dates: bounded by the calendar
    return (
        rows.groupBy("date_key", "first_hash", "second_hash")
        .agg(
            F.sum(F.when(F.col("side") == 1, 1).otherwise(0)).cast("bigint").alias("silver_rows"),
            F.sum(F.when(F.col("side") == -1, 1).otherwise(0)).cast("bigint").alias("fact_rows"),
        )
        .where(F.col("silver_rows") != F.col("fact_rows"))
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
