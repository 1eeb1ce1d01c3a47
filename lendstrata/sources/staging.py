"""Intermediate tables that outlive an executor.

A result that several later jobs read is written once to the folder named by
``spark.checkpoint.dir`` and read back: lineage ends there, later scans are pruned to the
columns they need, and a lost executor costs no recomputation.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from lendstrata.sources.files import make_passing_folder, read_table, remove, write_table


def staging_root(spark: SparkSession) -> str:
    """The folder that the session names, which all executors must share."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return configured


def staging_path(spark: SparkSession, label: str) -> str:
    """A new path in this application's part of the staging folder, which goes when the
    application ends, as results may be read from it until then. What is known to be done with
    goes earlier (``staged``)."""
    own = f"{staging_root(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    make_passing_folder(spark, own)
    return f"{own}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the staging folder and return a scan of it."""
    return _write(df, staging_path(df.sparkSession, label), partition_by)


def _write(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    write_table(df, path, partition_by, clustered=not partition_by)
    return read_table(df.sparkSession, path, df.schema)


@contextmanager
def staged(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """A staged table for the actions inside the block; its files go when the block ends."""
    path = staging_path(df.sparkSession, label)
    try:
        yield _write(df, path, partition_by)
    finally:
        remove(df.sparkSession, path)


def stage_all(**frames: DataFrame) -> dict[str, DataFrame]:
    """Stage independent frames side by side, each labelled with its argument's name."""
    spark = next(iter(frames.values())).sparkSession
    with ThreadPoolExecutor(len(frames)) as pool:
        tables = pool.map(inheritable_thread_target(spark)(stage), frames.values(), frames)
        return dict(zip(frames, tables))
