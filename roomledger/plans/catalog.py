"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the driver tables through the adapter, so its work grows with them. No
state is shared between queries: a query that needs gold writes its own silver to the shared
folder first (so the five dimensions and the fact read it with column pruning instead of
recomputing the adapter and the dedupe), builds the dimensions it needs, and returns a lazy
DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.operators import cube as K
from roomledger.operators import distinct as B
from roomledger.operators import gold as G
from roomledger.operators import profile as P
from roomledger.operators import quality as Q
from roomledger.operators import silver as S
from roomledger.operators import views as V
from roomledger.plans import oracle as O
from roomledger.schema import DIMENSION_KEYS, DIMENSION_SCHEMAS
from roomledger.session import stage, staging_path
from roomledger.sources.csv import normalise_missing, read_processed_csv, read_raw_csv, write_csv
from roomledger.sources.fixture import raw_bookings as adapter_rows

Query = Callable[[SparkSession, str], DataFrame]

SLICERS = V.Slicers(
    period=O.SLICER_PERIOD,
    customer_type=O.SLICER_CUSTOMER_TYPE,
    hotel=O.SLICER_HOTEL,
    distribution_channel=O.SLICER_CHANNEL,
)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adapter output with missing tokens normalised (A2)."""
    return normalise_missing(adapter_rows(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.build_silver(raw(spark, sf_dir))


def staged_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(silver(spark, sf_dir), "silver")


def _gold(spark: SparkSession, sf_dir: str, names=tuple(DIMENSION_SCHEMAS)):
    s = staged_silver(spark, sf_dir)
    return s, G.build_dimensions(s, names)


def _fact_and_dims(spark: SparkSession, sf_dir: str):
    s, dims = _gold(spark, sf_dir)
    return G.fact_rows(s, dims), dims


def _dimension(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        s = staged_silver(spark, sf_dir)
        return G.build_dimension(s, name).df

    return run


def _view(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact, dims = _fact_and_dims(spark, sf_dir)
        return V.VIEWS[name](fact, dims)

    return run


def _dashboard(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact, dims = _fact_and_dims(spark, sf_dir)
        return fn(fact, dims)

    return run


def _on_silver(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(silver(spark, sf_dir))

    return run


def clean_types(spark, sf_dir):
    return S.typed_bookings(raw(spark, sf_dir))


def arrival_dates(spark, sf_dir):
    return S.typed_bookings(raw(spark, sf_dir)).transform(S.add_arrival_date).select(
        "arrival_date_year", "arrival_date_month", "arrival_date_day_of_month", "arrival_month_num", "arrival_date"
    )


def stay_metrics(spark, sf_dir):
    return S.typed_bookings(raw(spark, sf_dir)).transform(S.add_stay_measures).select(
        "stays_in_weekend_nights", "stays_in_week_nights", "adults", "children", "babies", "adr",
        "total_nights", "total_guests", "estimated_revenue",
    )


def quality_labels(spark, sf_dir):
    return S.derived_bookings(raw(spark, sf_dir)).select("adr", "adults", "reservation_status", "data_quality_status")


def quality_label_counts(spark, sf_dir):
    return silver(spark, sf_dir).groupBy("data_quality_status").agg(F.count(F.lit(1)).alias("bookings"))


def structural_filter(spark, sf_dir):
    return S.derived_bookings(raw(spark, sf_dir)).transform(S.filter_structural)


def structural_rejects(spark, sf_dir):
    """C1 rejects counted per rule (a row failing two rules counts for both) and in total."""
    rules = S.structural_predicates()
    rules["any"] = S.structurally_valid()
    counts = S.derived_bookings(raw(spark, sf_dir)).agg(
        *[Q.count_where(~pred).alias(name) for name, pred in rules.items()]
    )
    args = ", ".join(f"'{n}', `{n}`" for n in rules)
    return counts.select(F.expr(f"stack({len(rules)}, {args}) as (rule, rejected_rows)"))


def fact_booking(spark, sf_dir):
    s, dims = _gold(spark, sf_dir)
    return G.build_fact(s, dims)


def kpi_cards_sliced(spark, sf_dir):
    fact, dims = _fact_and_dims(spark, sf_dir)
    return V.kpi_cards(fact, dims, SLICERS)


def kpi_cube(spark, sf_dir):
    return K.with_rates(K.kpi_cube(K.cells(*_fact_and_dims(spark, sf_dir))))


def kpi_cards_from_cube(spark, sf_dir):
    """The sliced cards answered from the staged cube, without another look at the fact."""
    cube = stage(K.kpi_cube(K.cells(*_fact_and_dims(spark, sf_dir))), "kpi-cube")
    return K.cards_from_cube(cube, SLICERS)


def silver_csv_round_trip(spark, sf_dir):
    """Processed bookings -> CSV (A3) -> read back, blanks and all."""
    path = staging_path(spark, "processed_csv")
    write_csv(S.processed(raw(spark, sf_dir)), path)
    return read_processed_csv(spark, path)


def distinct_numbers(spark, sf_dir):
    """Distinct values of silver's whole-number and date columns, merged from the bitmaps of two halves of it."""
    s = staged_silver(spark, sf_dir)
    early = F.col("arrival_date") < F.lit("1995-06-01").cast("date")
    halves = [s.where(early), s.where(~F.coalesce(early, F.lit(False)))]
    return B.counts(B.merge([B.state(half) for half in halves]), B.whole_columns(s))


def gold_content(spark, sf_dir):
    s, dims = _gold(spark, sf_dir)
    return Q.content_by_date(s, G.fact_rows(s, dims), dims)


def dq_report(spark, sf_dir):
    """The counting checks are taken while silver is written; the duplicate probe reads what was written."""
    observed, checks = Q.observed(silver(spark, sf_dir))
    written = stage(observed, "silver")
    return Q.quality_report(written, counts=checks.get)


def csv_round_trip(spark, sf_dir):
    """Raw text -> CSV files in the shared folder -> CSV source (A1-A3) -> silver."""
    path = staging_path(spark, "raw_csv")
    write_csv(adapter_rows(spark, sf_dir), path)
    return S.build_silver(read_raw_csv(spark, path))


def gold_key_uniqueness(spark, sf_dir):
    _, dims = _gold(spark, sf_dir)
    return Q.key_uniqueness(dims)


def gold_not_null(spark, sf_dir):
    _, dims = _gold(spark, sf_dir)
    return Q.not_null_conformance(dims)


def gold_orphans(spark, sf_dir):
    fact, dims = _fact_and_dims(spark, sf_dir)
    return Q.orphan_keys(fact, dims)


def gold_reconciliation(spark, sf_dir):
    s, dims = _gold(spark, sf_dir)
    return Q.reconciliation(s, G.fact_rows(s, dims))


# The same checks over tables with planted faults, which the pipeline's own tables cannot have: so that a
# check which no longer finds anything is seen.


def _planted(dims: dict[str, G.Dimension], change) -> dict[str, G.Dimension]:
    return {name: G.Dimension(name, change(name, dim.df), dim.rows) for name, dim in dims.items()}


def gold_key_uniqueness_planted(spark, sf_dir):
    """Every third key occurs twice."""
    _, dims = _gold(spark, sf_dir)
    return Q.key_uniqueness(_planted(dims, lambda name, df: df.unionByName(df.where(F.col(DIMENSION_KEYS[name]) % 3 == 0))))


def gold_not_null_planted(spark, sf_dir):
    """Rows whose key leaves 1 when divided by 4 have lost every value."""
    _, dims = _gold(spark, sf_dir)

    def blank(name: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.when(F.col(DIMENSION_KEYS[name]) % 4 != 1, F.col(c)).alias(c) for c in df.columns])

    return Q.not_null_conformance(_planted(dims, blank))


def gold_orphans_planted(spark, sf_dir):
    """Dimension rows whose key leaves 2 when divided by 5 are gone."""
    fact, dims = _fact_and_dims(spark, sf_dir)
    return Q.orphan_keys(fact, _planted(dims, lambda name, df: df.where(F.col(DIMENSION_KEYS[name]) % 5 != 2)))


def gold_content_planted(spark, sf_dir):
    """The rate of some bookings has changed; every count is as before."""
    s, dims = _gold(spark, sf_dir)
    fact = G.fact_rows(s, dims)
    changed = fact.withColumn("adr", F.when(F.col("lead_time") % 50 == 3, F.col("adr") + 1).otherwise(F.col("adr")))
    return Q.content_by_date(s, changed, dims)


def postconditions_unfiltered(spark, sf_dir):
    """The ETL's final assertions on rows that the structural filter has not seen."""
    return Q.postconditions(S.derived_bookings(raw(spark, sf_dir)))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "raw_bookings": raw,
        "clean_types": clean_types,
        "arrival_dates": arrival_dates,
        "stay_metrics": stay_metrics,
        "quality_labels": quality_labels,
        "quality_label_counts": quality_label_counts,
        "structural_filter": structural_filter,
        "structural_rejects": structural_rejects,
        "silver_bookings": silver,
        "csv_round_trip": csv_round_trip,
        "silver_csv_round_trip": silver_csv_round_trip,
    }
    q.update({name: _dimension(name) for name in DIMENSION_SCHEMAS})
    q["fact_booking"] = fact_booking
    q.update({name: _view(name) for name in V.VIEWS})
    q["kpi_cards_sliced"] = kpi_cards_sliced
    q["bookings_by_month"] = _dashboard(V.bookings_by_month)
    q["bookings_by_hotel"] = _dashboard(V.bookings_by_hotel)
    q["bookings_by_segment"] = _dashboard(V.bookings_by_segment)
    q["bookings_by_lead_band"] = _dashboard(V.bookings_by_lead_band)
    for name in ("bookings_by_month", "bookings_by_hotel", "bookings_by_segment", "bookings_by_lead_band"):
        q[f"{name}_sliced"] = _dashboard(lambda fact, dims, chart=getattr(V, name): chart(fact, dims, SLICERS))
    q["kpi_cube"] = kpi_cube
    q["kpi_cards_from_cube"] = kpi_cards_from_cube
    q["dq_volume"] = _on_silver(Q.volume)
    q["dq_nulls"] = _on_silver(Q.nulls)
    q["dq_duplicates_md5"] = _on_silver(Q.duplicates_md5)
    q["dq_duplicates_exact"] = _on_silver(Q.duplicates_exact)
    q["dq_ranges"] = _on_silver(Q.ranges)
    q["dq_consistency"] = _on_silver(Q.consistency)
    q["dq_report"] = dq_report
    q["postconditions"] = _on_silver(Q.postconditions)
    q["gold_key_uniqueness"] = gold_key_uniqueness
    q["gold_not_null"] = gold_not_null
    q["gold_orphans"] = gold_orphans
    q["gold_reconciliation"] = gold_reconciliation
    q["gold_content"] = gold_content
    for planted in (
        gold_key_uniqueness_planted, gold_not_null_planted, gold_orphans_planted, gold_content_planted, postconditions_unfiltered,
    ):
        q[planted.__name__] = planted
    q["column_profile"] = _on_silver(P.column_profile)
    q["distinct_numbers"] = distinct_numbers
    q["numeric_profile"] = _on_silver(P.numeric_summary)
    q["column_histograms"] = _on_silver(P.histograms)
    q["numeric_anomalies"] = _on_silver(lambda silver: P.anomalies(silver).values)
    q["numeric_anomaly_bounds"] = _on_silver(lambda silver: P.anomalies(silver).bounds)
    return q
