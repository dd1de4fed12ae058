"""Publication by several writers, retention, views of other sessions, checks taken while writing, content checks."""

from __future__ import annotations

import os

import pytest
from conftest import SF_SMALL, raw_frame, scratch_dir
from pyspark.sql import functions as F

from roomledger.operators import cube as K
from roomledger.operators import gold as G
from roomledger.operators import quality as Q
from roomledger.operators import silver as S
from roomledger.operators import views as V
from roomledger.plans import catalog as C
from roomledger.plans import medallion as M
from roomledger.sources import tables as T
from roomledger.sources.csv import normalise_missing


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def raw(spark):
    return normalise_missing(raw_frame(spark, [{}, {"hotel": "Resort Hotel"}, {"adr": "-1"}, {"babies": "3", "meal": "  "}]))


def folders(root: str, table: str) -> set[str]:
    return set(os.listdir(f"{root}/{table}")) if os.path.isdir(f"{root}/{table}") else set()


def test_the_later_of_two_interleaved_runs_is_refused(spark, raw, monkeypatch):
    root = scratch_dir()
    M.run_silver(raw, root)
    first = M.run_gold(spark, root)
    build, others = G.build_fact, []

    def overtaken(*args, **kwargs):
        if not others:
            others.append(None)
            others.append(M.run_gold(spark, root))  # another run starts and publishes meanwhile
        return build(*args, **kwargs)

    monkeypatch.setattr(M.G, "build_fact", overtaken)
    with pytest.raises(T.ConcurrentRun):
        M.run_gold(spark, root)
    assert T.newest(spark, root, M.GOLD) == others[1] and others[1].number == first.number + 1
    # The refused run's versions are gone again.
    assert folders(root, M.FACT) == {f"v={m.versions[M.FACT]}" for m in (first, others[1])}
    fact, dims = M.load_gold(spark, root)
    assert fact.count() == 3 and dims["dim_hotel"].rows == 2


def test_silver_refuses_too_and_a_number_is_taken_once(spark, raw):
    root = scratch_dir()
    M.run_silver(raw, root)
    with pytest.raises(T.ConcurrentRun):
        T.publish(spark, root, M.SILVER, {M.SILVER: "other"}, parent=0)
    assert T.newest(spark, root, M.SILVER).number == 1
    with pytest.raises(FileNotFoundError):
        T.newest(spark, root, "unknown")


def test_retention_bounds_the_folders(spark, raw):
    root = scratch_dir()
    for _ in range(4):
        M.run_silver(raw, root)
        M.run_gold(spark, root)
        T.retain(spark, root, keep=2)
        assert all(len(folders(root, t)) <= 2 for t in (M.SILVER, M.FACT, "dim_date"))
    assert len(os.listdir(f"{root}/{T.MANIFESTS}/{M.GOLD}")) <= 4  # two manifests and their checksum files
    fact, _ = M.load_gold(spark, root)
    assert fact.count() == 3
    # A version that no manifest names stays while it may belong to a running job, and goes when it is old.
    T.write_version(raw, root, M.SILVER, "lost")
    T.retain(spark, root)
    assert "v=lost" in folders(root, M.SILVER)
    T.retain(spark, root, orphan_age=-1)
    assert "v=lost" not in folders(root, M.SILVER) and len(folders(root, M.SILVER)) == 2
    assert M.check_gold(spark, root)["reconciliation"].first().fact_rows == 3


def test_gold_keeps_the_silver_that_it_was_built_from(spark, raw):
    root = scratch_dir()
    M.run_silver(raw, root)
    M.run_gold(spark, root)
    source = T.newest(spark, root, M.SILVER).versions[M.SILVER]
    for _ in range(3):
        M.run_silver(raw.limit(1), root)
        T.retain(spark, root, keep=1)
    assert f"v={source}" in folders(root, M.SILVER)
    assert all(r.same_content for r in M.check_gold(spark, root)["content"].collect())


def test_views_open_in_another_session(spark):
    root = scratch_dir()
    M.run_silver(C.raw(spark, SF_SMALL), root)
    M.run_gold(spark, root)
    other = spark.newSession()
    opened = M.open_views(other, root)
    fact, dims = M.load_gold(spark, root)
    assert set(opened) == set(V.VIEWS)
    for name, view in V.VIEWS.items():
        want = view(fact, dims)
        assert rows(other.table(name).select(*want.columns)) == rows(want), name
    assert not spark.catalog.tableExists("vw_room_match") or spark.table("vw_room_match") is not None
    # A later run does not change what an open view reads.
    before = rows(other.table("vw_booking_overview"))
    M.run_silver(C.raw(spark, SF_SMALL).limit(10), root)
    M.run_gold(spark, root)
    assert rows(other.table("vw_booking_overview")) == before
    assert rows(M.open_views(other, root)["vw_booking_overview"]) != before


def test_counting_checks_come_from_the_write(spark, raw, monkeypatch):
    root = scratch_dir()
    counts = M.run_silver(raw, root).details["counts"]
    silver = T.read_current(spark, root, M.SILVER)
    assert set(counts) == set(Q.counting_checks())
    assert counts == Q._agg(silver, Q.counting_checks()).first().asDict()
    assert counts["total_rows"] == 4 and counts["adr_invalid"] == 1
    want = rows(Q.quality_report(silver))
    monkeypatch.setattr(Q, "_agg", None)  # no aggregate of the counting checks from here on
    assert rows(M.check_silver(spark, root, enforce=False)) == want
    with pytest.raises(Q.QualityGateError, match="adr_invalid=1"):
        M.check_silver(spark, root)


def test_nothing_outlives_a_gold_run(spark, raw):
    root = scratch_dir()
    staged = spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/staged"
    M.run_silver(raw, root)
    before = folders(staged, "")
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    M.run_gold(spark, root)
    assert folders(staged, "") == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_processed_csv_keeps_blanks(spark, raw):
    root = scratch_dir()
    M.run_silver(raw, root, processed_csv=f"{root}/csv")
    from roomledger.sources.csv import read_processed_csv

    read = read_processed_csv(spark, f"{root}/csv")
    assert rows(read) == rows(S.processed(raw))
    assert {r.meal for r in read.collect()} == {"BB", "  "}
    assert T.read_current(spark, root, M.SILVER).where(F.col("meal").isNull()).count() == 1


def test_content_check_finds_a_change_at_equal_counts(spark):
    silver, dims = C._gold(spark, SF_SMALL)
    fact = G.fact_rows(silver, dims)
    assert Q.content_differences(silver, fact, dims).count() == 0
    one = fact.orderBy("date_key", "adr", "lead_time").first()
    hit = (F.col("date_key") == one.date_key) & (F.col("adr") == one.adr) & (F.col("lead_time") == one.lead_time)
    changes = {
        "adr": F.col("adr") + 1,
        "reservation_status_date": F.date_add("reservation_status_date", 1),
        "company": F.coalesce(F.col("company") + 1, F.lit(0)),
        "hotel_key": F.lit(3) - F.col("hotel_key"),
        "is_repeated_guest": F.lit(1) - F.col("is_repeated_guest"),
    }
    for column, value in changes.items():
        changed = fact.withColumn(column, F.when(hit, value).otherwise(F.col(column)))
        days = [r.date_key for r in Q.content_by_date(silver, changed, dims).collect() if not r.same_content]
        assert days == [one.date_key], column
        found = Q.content_differences(silver, changed, dims).collect()
        assert sum(r.silver_rows - r.fact_rows for r in found) == 0 and len(found) >= 2
    # Two values swapped between columns are the same parts, but not the same content.
    crossed = {"adults": F.col("children"), "children": F.col("adults")}
    swapped = fact.select(*[F.when(hit, crossed[c]).otherwise(F.col(c)).alias(c) if c in crossed else F.col(c) for c in fact.columns])
    if one.adults != one.children:
        assert sum(not r.same_content for r in Q.content_by_date(silver, swapped, dims).collect()) == 1


def test_cards_from_the_cube_equal_cards_from_the_fact(spark):
    silver, dims = C._gold(spark, SF_SMALL)
    fact = G.fact_rows(silver, dims).persist()
    cube = K.kpi_cube(K.cells(fact, dims)).persist()
    choices = [("period", C.SLICERS.period), ("customer_type", "Group"), ("hotel", "City Hotel"), ("distribution_channel", "2-HIGH")]
    for mask in range(16):
        slicers = V.Slicers(**{name: value for n, (name, value) in enumerate(choices) if mask >> n & 1})
        assert K.cards_from_cube(cube, slicers).first() == V.kpi_cards(fact, dims, slicers).first(), slicers
    none = V.Slicers(hotel="no such hotel")
    assert K.cards_from_cube(cube, none).first() == V.kpi_cards(fact, dims, none).first()
    cube.unpersist()
    fact.unpersist()


def test_text_is_parsed_once(spark):
    from test_plans import plan

    text = plan(C.silver(spark, SF_SMALL))
    assert text.count("RLIKE") <= 5
    assert text.count("translate(") == 20  # once per numeric column
    filters = [line for line in text.splitlines() if line.startswith("Condition") and "adults" in line]
    assert filters and all("translate" not in line and "cast(" not in line for line in filters)
