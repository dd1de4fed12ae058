"""Exact quantiles, histograms and outliers against plain versions in numpy, on hard columns."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from conftest import BASE_ROW, raw_frame
from pyspark.sql import functions as F

from roomledger.operators import order_statistics as order
from roomledger.operators import profile as P
from roomledger.operators.silver import build_silver
from roomledger.sources.csv import normalise_missing

ROWS = 600


def columns() -> dict[str, list]:
    rng = random.Random(11)
    return {
        "spread": [rng.randint(-50, 50) / 4 for _ in range(ROWS)],
        "hot": [7.0 if rng.random() < 0.7 else float(rng.randint(0, 9)) for _ in range(ROWS)],
        "one": [3] * ROWS,
        "nothing": [None] * ROWS,
        "gaps": [None if rng.random() < 0.5 else rng.choice([0.0, -0.0, 1.5, math.nan, 1e6]) for _ in range(ROWS)],
        "whole": [rng.randint(0, 5000) for _ in range(ROWS)],
        "pair": [1.0, 2.0] + [None] * (ROWS - 2),
    }


@pytest.fixture(scope="module")
def table(spark):
    data = columns()
    kinds = {"one": "long", "whole": "long"}
    frame = spark.createDataFrame(list(zip(*data.values(), strict=True)), ", ".join(f"{c} {kinds.get(c, 'double')}" for c in data))
    return frame.repartition(5), {c: np.sort([v for v in values if v is not None and v == v]).astype(float) for c, values in data.items()}


def test_numeric_summary_is_exact(table):
    frame, data = table
    got = {r.column_name: r for r in P.numeric_summary(frame).collect()}
    assert set(got) == set(data)
    for name, values in data.items():
        r = got[name]
        assert (r.rows, r.distinct_values) == (len(values), len(set(values)))
        if not len(values):
            assert r.min is None and r.p50 is None and r["mean"] is None
            continue
        assert (r.min, r.max) == (values[0], values[-1])
        assert r["mean"] == pytest.approx(values.mean(), rel=1e-12)
        for label, share in P.SHARES.items():
            assert r[label] == pytest.approx(np.quantile(values, share), rel=1e-12), (name, label)


def test_ranks_are_found_across_many_range_partitions(spark, table):
    frame, data = table
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "97")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        ranked = order.rank(order.value_counts(frame, list(data)))
        assert ranked.counts.select("part").distinct().count() > 8
        wanted = [(name, i + 1) for name, values in data.items() for i in range(0, len(values), 7)]
        asked = spark.createDataFrame(wanted, "column_name string, rank long")
        got = {(r.column_name, r["rank"]): r.value for r in order.at_ranks(ranked, asked).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {(name, i): data[name][i - 1] for name, i in wanted}


@pytest.mark.parametrize("buckets", [1, 4, 10])
def test_histograms(table, buckets):
    frame, data = table
    rows = P.histograms(frame, buckets).collect()
    for name, values in data.items():
        width = sorted((r.bucket, r.lower, r.upper, r.rows, r.distinct_values) for r in rows if (r.column_name, r.kind) == (name, "width"))
        depth = sorted((r.bucket, r.lower, r.upper, r.rows, r.distinct_values) for r in rows if (r.column_name, r.kind) == (name, "depth"))
        if not len(values):
            assert not width and not depth
            continue
        low, high = values[0], values[-1]
        places = [0 if high == low else min(int((v - low) / (high - low) * buckets), buckets - 1) for v in values]
        assert [w[0] for w in width] == list(range(1 if high == low else buckets))
        assert [w[3] for w in width] == [places.count(n) for n in range(len(width))]
        assert (width[0][1], width[-1][2]) == (low, high)
        ends = sorted({values[-(-i * len(values) // buckets) - 1] for i in range(1, buckets + 1)})
        own = [sum(e < v for e in ends) for v in values]
        want = [(n, min(p), max(p), len(p), len(set(p))) for n in sorted(set(own)) if (p := [v for v, o in zip(values, own, strict=True) if o == n])]
        assert depth == want
    hot = [r for r in rows if r.column_name == "hot" and r.kind == "depth" and r.lower <= 7.0 <= r.upper]
    assert len(hot) == 1 and hot[0].rows >= (data["hot"] == 7.0).sum()  # a value is never split


def plain_anomalies(values: np.ndarray):
    q1, median, q3 = (np.quantile(values, p) for p in (0.25, 0.5, 0.75))
    distance = np.abs(values - median)
    mad, mean = np.quantile(distance, 0.5), distance.mean()
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    score = (values - median) * 0.6745 / mad if mad > 0 else (values - median) / (mean * 1.253314) if mean > 0 else 0 * values
    return (values < low) | (values > high), np.abs(score) > 3.5, mad


def test_anomalies(table):
    frame, data = table
    found = P.anomalies(frame)
    bounds = {r.column_name: r for r in found.bounds.collect()}
    values = found.values.collect()
    assert set(bounds) == {c for c, v in data.items() if len(v)}
    for name, r in bounds.items():
        outside, high, mad = plain_anomalies(data[name])
        assert (r.rows_outside_fences, r.rows_with_high_score) == (outside.sum(), high.sum()), name
        assert r.mad == pytest.approx(mad)
        flagged = {v.value: v.rows for v in values if v.column_name == name}
        chosen = data[name][outside | high]
        assert flagged == {v: (chosen == v).sum() for v in chosen}


def test_planted_outliers_are_found(spark):
    rows = [{"adr": f"{90 + i % 21}.50", "lead_time": str(i % 40), "agent": str(i)} for i in range(300)]
    rows += [{"adr": "5400", "adults": "2", "agent": "900"}, {"adr": "-6.38", "agent": "901"}, {"adults": "26", "agent": "902"}]
    silver = build_silver(normalise_missing(raw_frame(spark, rows)))
    found = {(r.column_name, r.value): r for r in P.anomalies(silver).values.collect()}
    for outlier in (("adr", 5400.0), ("adr", -6.38), ("adults", 26.0), ("total_guests", 26.0)):
        assert found[outlier].high_score and found[outlier].outside_fences and found[outlier].rows == 1
    assert not any(c == "lead_time" for c, _ in found)
    assert float(BASE_ROW["adr"]) not in {v for c, v in found if c == "adr"}


def test_empty_table(table):
    frame, data = table
    none = frame.where("false")
    assert {r.rows for r in P.numeric_summary(none).collect()} == {0}
    assert P.histograms(none).count() == 0
    assert P.anomalies(none).values.count() == P.anomalies(none).bounds.count() == 0


def test_distinct_bitmaps_merge_across_runs(spark):
    from roomledger.operators import distinct as B

    rng = random.Random(2)
    wide = [None, 0, -1, 1, 2**40, -(2**40), 32768, 32767, -32768, *(rng.randint(-70000, 70000) for _ in range(3000))]
    rows = [(rng.choice(wide), rng.randint(0, 3), None) for _ in range(4000)]
    frame = spark.createDataFrame(rows, "wide long, few int, none long").withColumn("day", F.date_add(F.lit("1969-12-30").cast("date"), F.col("few")))
    runs = frame.randomSplit([1.0, 2.0, 1.0], seed=4)
    states = [B.state(run) for run in runs]
    want = {c: len({r[c] for r in frame.collect()} - {None}) for c in frame.columns}
    for merged in (B.merge(states), B.merge([*states, states[1], frame_state := B.state(frame)]), frame_state):
        assert {r.column_name: r.distinct_values for r in B.counts(merged, frame.columns).collect()} == want
    assert B.merge(states).where("column_name = 'few'").count() <= 2  # however many rows and tasks
    assert {r.distinct_values for r in B.counts(B.state(frame.where("false")), frame.columns).collect()} == {0}
