"""Plan shape (what the optimizer produced) and whole-result properties on driver tables."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from roomledger.operators import gold as G
from roomledger.operators import views as V
from roomledger.plans import catalog as C
from roomledger.session import stage
from roomledger.sources.csv import normalise_missing
from roomledger.sources.fixture import raw_bookings
from roomledger.operators.silver import build_silver


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def gold(spark):
    s, dims = C._gold(spark, SF_SMALL)
    return s, dims


def test_fact_joins_are_broadcast_hash_joins(gold):
    s, dims = gold
    p = plan(G.fact_rows(s, dims))
    assert p.count("BroadcastHashJoin") >= 5
    for bad in ("SortMergeJoin", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p


def test_silver_scan_is_pruned_and_filtered(gold):
    s, dims = gold
    p = plan(V.booking_by_channel(G.fact_rows(s, dims), dims))
    assert "EqualTo(data_quality_status,VALID)" in p
    # Only the columns the view needs are read from silver (no meal, deposit_type, ...).
    first_scan = p[p.index("Scan parquet"):]
    schema = first_scan[first_scan.index("ReadSchema"):].splitlines()[0]
    assert "meal" not in schema and "deposit_type" not in schema


def test_booking_numbering_has_no_single_partition_over_facts(gold):
    s, dims = gold
    p = plan(G.build_fact(s, dims))
    # The only single-partition exchange feeds the window over per-partition counts.
    assert p.count("SinglePartition") == 1
    window_input = p[p.index("SinglePartition") - 600 : p.index("SinglePartition")]
    assert "HashAggregate" in p and "Window" in p
    assert "BroadcastHashJoin" in p
    del window_input


def test_views_add_up_to_the_overview(spark, gold):
    s, dims = gold
    fact = G.fact_rows(s, dims)
    total = V.booking_overview(fact).first().total_bookings
    for name in ("vw_booking_by_lead_time", "vw_booking_seasonality_hotel", "vw_booking_by_channel", "vw_room_match"):
        assert V.VIEWS[name](fact, dims).agg(F.sum("total_bookings")).first()[0] == total


def test_unsliced_cards_equal_overview(gold):
    s, dims = gold
    fact = G.fact_rows(s, dims)
    cards = V.kpi_cards(fact, dims).first()
    v1 = V.booking_overview(fact).first()
    for c in ("total_bookings", "avg_adr", "avg_lead_time", "total_estimated_revenue", "total_nights", "cancellation_rate"):
        assert cards[c] == v1[c]


def test_silver_is_idempotent_under_duplicated_and_shuffled_input(spark, gold):
    s, _ = gold
    raw = normalise_missing(raw_bookings(spark, SF_SMALL))
    doubled = build_silver(raw.unionByName(raw).orderBy(F.rand(7)))
    assert doubled.exceptAll(s).count() == 0 and s.exceptAll(doubled).count() == 0


def test_booking_keys_do_not_depend_on_input_order(spark, gold):
    s, dims = gold
    shuffled = stage(s.orderBy(F.rand(3)).repartition(5), "shuffled_silver")
    a = G.build_fact(s, dims)
    b = G.build_fact(shuffled, dims, partitions=3)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pipeline_end_to_end(spark):
    from roomledger.plans import medallion as M
    from conftest import scratch_dir
    from roomledger.sources.csv import write_csv

    root = scratch_dir()
    write_csv(raw_bookings(spark, SF_SMALL), f"{root}/raw")
    result = M.run_all(spark, f"{root}/raw", f"{root}/wh", enforce_quality=False)
    assert result.counts["total_rows"] == 1516 and result.counts["adr_invalid"] > 0
    assert set(result.versions) == {"silver", "dim_date", "dim_hotel", "dim_customer", "dim_room", "dim_channel",
                                    "fact_booking"}
    assert spark.table("vw_booking_overview").first().total_bookings == 1506  # FIXTURES.md §4
    checks = M.check_gold(spark, f"{root}/wh")
    assert all(r.orphan_rows == 0 for r in checks["orphans"].collect())
    with pytest.raises(Exception, match="adr_invalid"):
        M.check_silver(spark, f"{root}/wh", enforce=True)  # S12: negative ADR fails the gate


def test_paths_beyond_the_size_bounds_give_the_same_results(spark, gold):
    """With the broadcast and single-task bounds set to 1 row, dimensions are numbered by the
    distributed path and joined with shuffle joins; keys, fact and views must not change."""
    s, dims = gold
    expected_fact = G.build_fact(s, dims)
    expected_view = V.booking_by_channel(G.fact_rows(s, dims), dims)
    conf = {
        "roomledger.broadcast.maxRows": "1",
        "roomledger.numbering.singleTaskMaxRows": "1",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        big_dims = G.build_dimensions(s)
        fact = G.build_fact(s, big_dims)
        view = V.booking_by_channel(G.fact_rows(s, big_dims), big_dims)
        text = plan(G.fact_rows(s, big_dims))
        # The five dimension joins fall back to sort-merge joins (the only broadcasts left are the
        # per-partition offsets inside the distributed numbering, bounded by the partition count).
        assert text.count("SortMergeJoin") >= 5
        for name in ("dim_hotel", "dim_customer", "dim_room", "dim_channel"):
            a, b = dims[name].df, big_dims[name].df
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        assert fact.exceptAll(expected_fact).count() == 0 and expected_fact.exceptAll(fact).count() == 0
        assert view.exceptAll(expected_view).count() == 0 and expected_view.exceptAll(view).count() == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
