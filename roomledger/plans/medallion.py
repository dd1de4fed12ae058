"""The batch pipeline end to end: raw -> silver -> gold -> views.

Run order of the original project (ETL, silver checks, gold build, gold checks, views) as plain
function calls over a warehouse folder on a shared file system. Every table is replaced by
writing a complete new version and then publishing a manifest (sources/tables.py), so a failed
run never leaves a half-written table behind, and of two interleaved runs the later one is refused. The
fact is written unpartitioned: it carries keys, not dates, and period slicers reach it through a
semi-join on the (small) date dimension.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from roomledger.operators import gold as G
from roomledger.operators import quality as Q
from roomledger.operators import silver as S
from roomledger.operators import views as V
from roomledger.schema import DIMENSION_SCHEMAS, EXPECTED_MIN_ROWS
from roomledger.session import remove, workspace
from roomledger.sources.csv import read_raw_csv, write_csv
from roomledger.sources.tables import (
    ConcurrentRun,
    Manifest,
    new_version,
    newest,
    newest_number,
    publish,
    read_current,
    replace_table,
    retain,
    version_path,
    write_version,
)

GOLD, SILVER, FACT = "gold", "silver", "fact_booking"


@dataclass
class RunResult:
    versions: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    warnings: list[tuple[str, int]] = field(default_factory=list)


def run_silver(raw: DataFrame, warehouse: str, processed_csv: str | None = None) -> Manifest:
    """M7: build silver from normalised raw rows and publish it (A4) with its counting checks.

    The checks are metrics of the write itself and stand in the manifest's details (``counts``); no
    scan is made for them. ``processed_csv`` also writes the processed bookings (A3) as they are before
    the load turns blanks into NULL, which is what the original wrote; that is a second pass over ``raw``.
    """
    silver, observation = Q.observed(S.build_silver(raw))
    published = replace_table(silver, warehouse, SILVER, details=lambda: {"counts": observation.get})
    if processed_csv:
        write_csv(S.processed(raw), processed_csv)
    return published


def check_silver(
    spark: SparkSession, warehouse: str, enforce: bool = True, expected_min_rows: int = EXPECTED_MIN_ROWS
) -> DataFrame | list:
    """Q1-Q20 on the published silver: the report, or (``enforce``) the gate's warnings.

    The counts come from the manifest; only the duplicate probe reads the table, and nine columns of it.
    """
    manifest = newest(spark, warehouse, SILVER)
    silver = spark.read.parquet(version_path(warehouse, SILVER, manifest.versions[SILVER]))
    report = Q.quality_report(silver, expected_min_rows, manifest.details.get("counts"))
    return Q.enforce(report) if enforce else report


def run_gold(spark: SparkSession, warehouse: str) -> Manifest:
    """M8: dimensions before the fact (the fact reads their keys), published as one.

    The manifest that names all six versions and the views over them comes last: keys are numbered anew in
    each run, so a reader must never join dimensions of one run to the fact of another. A run that was
    overtaken by another is refused and removes what it wrote; its staged tables and cached members go in any case.
    """
    parent, source = newest_number(spark, warehouse, GOLD), newest(spark, warehouse, SILVER)
    versions = dict.fromkeys((*DIMENSION_SCHEMAS, FACT), new_version())
    dims: dict[str, G.Dimension] = {}
    with workspace(spark):
        try:
            silver = spark.read.parquet(version_path(warehouse, SILVER, source.versions[SILVER]))
            dims.update(G.build_dimensions(silver))
            for name in DIMENSION_SCHEMAS:
                write_version(dims[name].df, warehouse, name, versions[name])
            write_version(G.build_fact(silver, dims), warehouse, FACT, versions[FACT])
            details = {"built_from": source.versions, "views": V.view_definitions()}
            return publish(spark, warehouse, GOLD, versions, parent, details)
        except ConcurrentRun:
            for name, version in versions.items():
                remove(spark, version_path(warehouse, name, version))
            raise
        finally:
            G.release(dims)


def load_gold(spark: SparkSession, warehouse: str) -> tuple[DataFrame, dict[str, G.Dimension]]:
    """Fact and dimensions of the newest complete run (with row counts for the broadcast checks)."""
    versions = newest(spark, warehouse, GOLD).versions
    read = {name: spark.read.parquet(version_path(warehouse, name, version)) for name, version in versions.items()}
    dims = {name: G.Dimension(name, read[name], read[name].count()) for name in DIMENSION_SCHEMAS}
    return read[FACT], dims


def check_gold(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """G1-G5 on the published gold tables, against the silver version they were built from."""
    fact, dims = load_gold(spark, warehouse)
    source = newest(spark, warehouse, GOLD).details["built_from"][SILVER]
    silver = spark.read.parquet(version_path(warehouse, SILVER, source))
    return {
        "key_uniqueness": Q.key_uniqueness(dims),
        "not_null": Q.not_null_conformance(dims),
        "orphans": Q.orphan_keys(fact, dims),
        "reconciliation": Q.reconciliation(silver, fact),
        "content": Q.content_by_date(silver, fact, dims),
    }


def open_views(spark: SparkSession, warehouse: str, permanent: bool = False) -> dict[str, DataFrame]:
    """The five business views of the newest published run, from their SQL text in its manifest.

    Any session can open them. They are bound to that run's files: a later run does not change what
    an open view reads. ``permanent`` creates them in the session catalog instead of as temporary views, for
    every session that shares its metastore.
    """
    manifest = newest(spark, warehouse, GOLD)
    definitions = manifest.details.get("views")
    if not definitions:
        raise FileNotFoundError("no business view is defined")
    paths = {name: version_path(warehouse, name, version) for name, version in manifest.versions.items()}
    kind = "VIEW" if permanent else "TEMPORARY VIEW"
    for name in sorted(definitions):
        spark.sql(f"CREATE OR REPLACE {kind} {name} AS {V.bind(definitions[name], paths)}")
    return {name: spark.table(name) for name in sorted(definitions)}


def run_all(spark: SparkSession, raw_csv: str, warehouse: str, enforce_quality: bool = True, keep: int = 2) -> RunResult:
    """Raw CSV -> silver (+ gate) -> gold -> views; versions that only older runs name are removed.

    The gate raises on errors when enforced.
    """
    result = RunResult()
    silver = run_silver(read_raw_csv(spark, raw_csv), warehouse)
    result.versions.update(silver.versions)
    result.counts = silver.details["counts"]
    if enforce_quality:
        result.warnings = check_silver(spark, warehouse, enforce=True)
    result.versions.update(run_gold(spark, warehouse).versions)
    open_views(spark, warehouse)
    retain(spark, warehouse, keep)
    return result
