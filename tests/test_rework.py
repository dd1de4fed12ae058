"""Exact money, a CSV source that does not damage rows, publication as one unit, checks that fire."""

from __future__ import annotations

import os

import pytest
from conftest import BASE_ROW, raw_frame, scratch_dir
from pyspark.sql import functions as F

from roomledger.functions.measures import money_mean2, money_sum
from roomledger.plans import medallion as M
from roomledger.schema import RAW_COLUMNS
from roomledger.sources.csv import read_raw_csv, write_csv
from roomledger.sources.tables import newest_number


def test_money_is_not_rounded_per_row(spark):
    rows = [(0.004, 0.012)] * 100 + [(75.125, 225.375)] * 2
    got = spark.createDataFrame(rows, "adr double, revenue double").agg(
        money_mean2(F.col("adr")).alias("adr"), money_sum(F.col("revenue")).alias("revenue")
    )
    assert tuple(got.first()) == (1.48, 451.95)


def write_lines(name: str, *files: str) -> str:
    root = scratch_dir() + "/" + name
    os.makedirs(root)
    for i, text in enumerate(files):
        with open(f"{root}/part-{i}.csv", "w", encoding="utf-8", newline="") as out:
            out.write(text)
    return root


def csv_text(*rows: dict, columns=RAW_COLUMNS, end: str = "") -> str:
    lines = [",".join(columns)] + [",".join({**BASE_ROW, **r}[c] for c in columns) + end for r in rows]
    return "\n".join(lines) + "\n"


def test_quoted_line_break(spark):
    path = write_lines("breaks", csv_text({"hotel": '"line1\nline2"'}, {}))
    rows = read_raw_csv(spark, path, multi_line=True).select("hotel", "adr").collect()
    assert sorted(map(tuple, rows)) == [("City Hotel", "100.50"), ("line1\nline2", "100.50")]
    with pytest.raises(Exception, match="other fields"):
        read_raw_csv(spark, path).collect()


@pytest.mark.parametrize("multi_line", [False, True])
def test_surplus_and_missing_fields_stop_the_job(spark, multi_line):
    for text in (csv_text({}, end=",extra"), csv_text({}) + "City Hotel,0\n"):
        with pytest.raises(Exception, match="other fields"):
            read_raw_csv(spark, write_lines("fields", text), multi_line).collect()


def test_other_header_order_is_refused(spark):
    swapped = (*RAW_COLUMNS[1:], RAW_COLUMNS[0])
    assert read_raw_csv(spark, write_lines("order", csv_text({}, columns=swapped))).first()["hotel"] == "City Hotel"
    with pytest.raises(Exception):  # noqa: B017 - Spark's own header check
        read_raw_csv(spark, write_lines("orders", csv_text({}), csv_text({}, columns=swapped))).collect()


def test_byte_order_mark_and_dirty_header_names(spark):
    text = csv_text({}).replace("lead_time", " Lead Time ", 1).replace("is_canceled", "Is Canceled ", 1)
    row = read_raw_csv(spark, write_lines("bom", "﻿" + text)).first()
    assert (row["hotel"], row["is_canceled"], row["lead_time"]) == ("City Hotel", "0", "10")


def test_gold_is_published_as_one_unit(spark, monkeypatch):
    root = scratch_dir()
    raw = raw_frame(spark, [{}, {"hotel": "Resort Hotel"}])
    write_csv(raw, root + "/raw")
    M.run_silver(read_raw_csv(spark, root + "/raw"), root)
    M.run_gold(spark, root)
    before = newest_number(spark, root, M.GOLD)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(M.G, "build_fact", broken)
    with pytest.raises(RuntimeError):
        M.run_gold(spark, root)
    assert newest_number(spark, root, M.GOLD) == before
    fact, dims = M.load_gold(spark, root)
    assert fact.count() == 2 and dims["dim_hotel"].rows == 2
