"""Parquet tables, published by numbered manifests.

A table is replaced by writing a complete new version beside the old one, ``<root>/<table>/v=<run id>``, and
then publishing a manifest that names it, so readers never see a half-written table (the reference
truncated and reloaded, which is not atomic). Manifests of a publication are numbered; each is created
under the number after its parent's, by a rename that fails where the number is taken. Of two runs that
started from the same manifest, the second one to finish is refused.

The rename has to be atomic, as on HDFS, ABFS and local file systems (Spark's streaming checkpoints ask
for the same).
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomledger.session import file_system, hadoop_path, remove

MANIFESTS = "_manifests"
ORPHAN_AGE = 24 * 3600  # seconds after which a version that no manifest names counts as left behind


class ConcurrentRun(RuntimeError):
    """Another run published after this one had started."""


@dataclass(frozen=True)
class Manifest:
    """What one run published: versions by table, and details that readers may need."""

    number: int
    versions: dict[str, str]
    details: dict = field(default_factory=dict)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver-provided table ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_version() -> str:
    return uuid.uuid4().hex[:12]


def version_path(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/{table}/v={version}"


def write_version(df: DataFrame, root: str, table: str, version: str) -> str:
    """Write one complete version of ``table``; returns its path. Nothing points to it yet."""
    path = version_path(root, table, version)
    df.write.mode("errorifexists").parquet(path)
    return path


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/{name}"


def _numbers(spark: SparkSession, root: str, name: str) -> list[int]:
    folder = _folder(root, name)
    files = file_system(spark, folder)
    if not files.exists(hadoop_path(spark, folder)):
        return []
    names = (status.getPath().getName() for status in files.listStatus(hadoop_path(spark, folder)))
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def read_manifest(spark: SparkSession, root: str, name: str, number: int) -> Manifest:
    path = f"{_folder(root, name)}/{number:020d}.json"
    content = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return Manifest(number, content["versions"], content["details"])


def newest_number(spark: SparkSession, root: str, name: str) -> int:
    """The number of the newest manifest of ``name``, 0 before the first."""
    return max(_numbers(spark, root, name), default=0)


def newest(spark: SparkSession, root: str, name: str) -> Manifest:
    number = newest_number(spark, root, name)
    if number == 0:
        raise FileNotFoundError(f"{name} has not been published under {root}")
    return read_manifest(spark, root, name, number)


def publish(
    spark: SparkSession, root: str, name: str, versions: dict[str, str], parent: int, details: dict | None = None
) -> Manifest:
    """Publish ``versions`` as the successor of manifest ``parent``; ``ConcurrentRun`` if there is one already.

    The content is complete before its name appears: it is written beside and renamed.
    """
    jvm = spark.sparkContext._jvm
    manifest = Manifest(parent + 1, versions, details or {})
    folder = _folder(root, name)
    draft = hadoop_path(spark, f"{folder}/.draft-{uuid.uuid4().hex}")
    final = hadoop_path(spark, f"{folder}/{manifest.number:020d}.json")
    files = file_system(spark, folder)
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({"versions": versions, "details": manifest.details}).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, final, no_options)
    except Exception as error:
        files.delete(draft, False)
        if files.exists(final):
            raise ConcurrentRun(f"{name} {manifest.number} was published by another run") from error
        raise
    return manifest


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The published version of ``table`` (the silver scan, A5)."""
    return spark.read.parquet(version_path(root, table, newest(spark, root, table).versions[table]))


def replace_table(df: DataFrame, root: str, table: str, details=None) -> Manifest:
    """Full reload of ``table``: write a new version, then publish it.

    ``details``: called after the write, gives the manifest's details. A refused run removes its version.
    """
    spark = df.sparkSession
    parent, version = newest_number(spark, root, table), new_version()
    path = write_version(df, root, table, version)
    try:
        return publish(spark, root, table, {table: version}, parent, details() if details else None)
    except ConcurrentRun:
        remove(spark, path)
        raise


def retain(spark: SparkSession, root: str, keep: int = 2, orphan_age: float = ORPHAN_AGE) -> list[str]:
    """Remove what only older manifests than the newest ``keep`` of each publication name; returns the paths.

    Versions that no manifest names are what failed runs left, or what running ones have not yet published:
    they go once they are older than ``orphan_age`` seconds. A reader of an older version loses its files, so
    ``keep`` must cover the longest reader.
    """
    if keep < 1:
        raise ValueError("the newest manifest is always kept")
    root = root.rstrip("/")
    files = file_system(spark, root)

    def children(path: str) -> list:
        where = hadoop_path(spark, path)
        return list(files.listStatus(where)) if files.exists(where) else []

    kept, outdated, removed = set(), set(), []
    for folder in children(f"{root}/{MANIFESTS}"):
        name = folder.getPath().getName()
        numbers = _numbers(spark, root, name)
        for number in numbers:
            manifest = read_manifest(spark, root, name, number)
            named = set(manifest.versions.items())
            if number in numbers[-keep:]:
                # A manifest may name tables of another publication that it was built from.
                kept |= named | set(manifest.details.get("built_from", {}).items())
            else:
                outdated |= named
                removed.append(f"{root}/{MANIFESTS}/{name}/{number:020d}.json")
    for table in children(root):
        if table.getPath().getName() == MANIFESTS or not table.isDirectory():
            continue
        for status in children(f"{root}/{table.getPath().getName()}"):
            entry = (table.getPath().getName(), status.getPath().getName().removeprefix("v="))
            old = time.time() - status.getModificationTime() / 1000 > orphan_age
            if entry not in kept and (entry in outdated or old) and status.getPath().getName().startswith("v="):
                removed.insert(0, version_path(root, *entry))  # versions go before the manifests that name them
    for path in removed:
        remove(spark, path)
    return removed


def with_schema(df: DataFrame, schema) -> DataFrame:
    """Project and cast ``df`` to a declared schema, by column name."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
