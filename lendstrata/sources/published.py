"""Tables whose readers see a write whole or not at all.

Each write goes to a new folder of the table. When it is complete and checked, a manifest is
switched that names, for every partition, the folder that holds it; readers go by the
manifest. A write that dies leaves the table as it was. Partitions that are not replaced keep
their files. What neither the new manifest nor the one before names is removed, so readers
that began before a switch can end. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lendstrata.operators.contracts import ContractError
from lendstrata.sources import files
from lendstrata.sources.specs import SNAPSHOT

MANIFEST = "_manifest.json"
WHOLE = ""  # the partition of a table that has none


def _manifest(spark: SparkSession, path: str) -> dict:
    return files.read_note(spark, f"{path}/{MANIFEST}") or {"folders": {}, "before": {}, "schema": None}


def is_published(spark: SparkSession, path: str) -> bool:
    return _manifest(spark, path)["schema"] is not None


def partition_tokens(spark: SparkSession, path: str) -> dict[date, str]:
    """The folder of each snapshot; it changes whenever the snapshot is written."""
    return {date.fromisoformat(d): f for d, f in _manifest(spark, path)["folders"].items() if d != WHOLE}


def token(spark: SparkSession, path: str) -> str | None:
    """The folder of a table without partitions."""
    return _manifest(spark, path)["folders"].get(WHOLE)


def publish(
    df: DataFrame,
    path: str,
    replaces: Collection[date] | None = None,
    partitioned: bool = True,
    clustered: bool = False,
    check: Callable[[DataFrame], None] | None = None,
) -> None:
    """Make ``df`` the table at ``path``, or its snapshots ``replaces``.

    With ``replaces``, a snapshot of which ``df`` holds no row is gone from the table, and a row
    of any other snapshot is an error. ``check`` sees what was written before it counts, and
    may raise.
    """
    spark, by = df.sparkSession, [SNAPSHOT] if partitioned else []
    folder = f"v=r{uuid.uuid4().hex}"
    files.write_table(df, f"{path}/{folder}", by, mode="error", clustered=clustered)
    old = _manifest(spark, path)
    if partitioned:
        found = {d.isoformat(): f"{folder}/{SNAPSHOT}={d.isoformat()}" for d in files.partition_days(spark, f"{path}/{folder}")}
    else:
        found = {WHOLE: folder}
    kept = {}
    if replaces is not None:
        named = {d.isoformat() for d in replaces}
        if not found.keys() <= named:
            raise ContractError(f"{path}: rows of other snapshots than {sorted(named)}: {sorted(found.keys() - named)}")
        kept = {d: f for d, f in old["folders"].items() if d not in named}
    schema = df.schema.json()
    new = {"folders": kept | found, "before": old["folders"], "schema": schema}
    if check:
        check(_read(spark, path, {"folders": found, "schema": schema}))
    files.write_note(spark, f"{path}/{MANIFEST}", new)
    _sweep(spark, path, {*new["folders"].values(), *new["before"].values()})


def read(spark: SparkSession, path: str) -> DataFrame:
    """The published table, its columns in the order in which they were written."""
    manifest = _manifest(spark, path)
    if manifest["schema"] is None:
        raise FileNotFoundError(f"{path} was never published")
    return _read(spark, path, manifest)


def read_folder(spark: SparkSession, path: str, folder: str) -> DataFrame | None:
    """A table without partitions as it was in one of its folders, if that is still there."""
    where = f"{path}/{folder}"
    return spark.read.parquet(where) if files.table_exists(spark, where) else None


def _read(spark: SparkSession, path: str, manifest: dict) -> DataFrame:
    schema = StructType.fromJson(json.loads(manifest["schema"]))
    folders = manifest["folders"]
    if not folders:
        return spark.createDataFrame([], schema)
    if WHOLE in folders:
        return spark.read.schema(schema).parquet(f"{path}/{folders[WHOLE]}")
    # a version all of whose partitions count is listed as a whole
    listed = []
    for version in sorted({f.split("/")[0] for f in folders.values()}):
        counting = {f for f in folders.values() if f.split("/")[0] == version}
        there = {f"{version}/{SNAPSHOT}={d.isoformat()}" for d in files.partition_days(spark, f"{path}/{version}")}
        listed += [version] if there == counting else sorted(counting)
    scan = spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/{f}" for f in listed))
    return scan.select(*schema.names)


def _sweep(spark: SparkSession, path: str, needed: Collection[str]) -> None:
    """Remove versions, and partitions of versions, that no manifest names."""
    versions = {f.split("/")[0] for f in needed}
    for version in files.subfolders(spark, path, "v=*"):
        if version not in versions:
            files.remove(spark, f"{path}/{version}")
            continue
        for part in files.subfolders(spark, f"{path}/{version}", f"{SNAPSHOT}=*"):
            if f"{version}/{part}" not in needed:
                files.remove(spark, f"{path}/{version}/{part}")
