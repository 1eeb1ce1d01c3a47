"""CSV in, Parquet in and out."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Collection, Iterator, Sequence
from datetime import date
from math import ceil

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lendstrata.functions.dates import parse_date
from lendstrata.operators.contracts import ContractError
from lendstrata.sources.specs import LINEAGE, LOAD_DATE, SNAPSHOT, SourceSpec

ROWS_PER_FILE = 20_000_000
#: Deliveries are dealt out by their size in bytes: what a task reads at most, so that it sorts its
#: rows in memory, and what it should hold of each snapshot, so that it can write files of its own.
BYTES_PER_TASK = 128 * 1024 * 1024
LEAST_SHARE = 96 * 1024


def list_csv_sources(spark: SparkSession, folder: str) -> list[str]:
    """Names of the sources ``<folder>/<name>.csv``, each a file or a folder of part files.

    A folder that is missing or has none gives an empty list. Only the file listing is
    read, and the names are reduced to distinct ones before they reach the driver.
    """
    try:
        listing = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/*.csv").select("path")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    name = F.regexp_extract("path", r"([^/]+)\.csv(?:/[^/]*)?$", 1).alias("name")
    return sorted(r.name for r in listing.select(name).distinct().collect())


def infer_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> StructType:
    """Column names and types as found in a CSV, for writing a contract of a new source."""
    reader = spark.read.options(header=True, inferSchema=True, samplingRatio=sampling_ratio)
    return reader.csv(path).schema


def read_csv(spark: SparkSession, path: str, contract: StructType) -> DataFrame:
    """CSV with header, typed by the contract, columns in file order, one pass.

    Only a header line is looked at beforehand; a column that the contract doesn't know
    raises. The job that reads the rows raises when another part file has other columns or
    the same in another order, and when a value doesn't fit its type: silently, both would put
    wrong values or NULLs into the columns. The snapshot column is read as text.
    """
    header = spark.read.csv(path, header=True).columns
    types = {f.name: f.dataType for f in contract if f.name != SNAPSHOT}
    unknown = [c for c in header if c not in contract.names]
    if unknown:
        raise ContractError(f"{path}: unexpected columns {unknown}")
    schema = StructType([StructField(c, types.get(c, StringType())) for c in header])
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False, mode="FAILFAST")


def read_snapshots(
    spark: SparkSession, path: str, spec: SourceSpec, dates: Sequence[date] | None = None
) -> DataFrame:
    """Raw rows of a source in its raw contract: parsed snapshot date, lineage, load date.

    All wanted snapshots come from one scan. A CSV that lacks a column of the contract raises.
    """
    df = read_csv(spark, path, spec.raw)
    require_columns(df.columns, spec, path)
    # beside the file's name, which differs from row to row, the date is parsed once and not
    # again by the filter on it
    df = df.withColumns({LINEAGE: F.input_file_name(), SNAPSHOT: parse_date(F.col(SNAPSHOT), spec.snapshot_format)})
    return slice_snapshots(df, dates).withColumn(LOAD_DATE, F.col(SNAPSHOT)).select(*spec.raw.names)


def require_columns(header: Collection[str], spec: SourceSpec, what: str) -> None:
    """Raise when a delivery lacks columns that the raw contract promises."""
    missing = [c for c in spec.raw.names if c not in header and c not in (LINEAGE, LOAD_DATE)]
    if missing:
        raise ContractError(f"{what}: missing columns {missing}")


def slice_snapshots(df: DataFrame, dates: Sequence[date] | None = None, on: str = SNAPSHOT) -> DataFrame:
    """Rows of the given snapshots, or of all dated ones; a partition filter on stored tables."""
    return df.filter(F.col(on).isNotNull() if dates is None else F.col(on).isin(list(dates)))


def tasks_for(spark: SparkSession, path: str, snapshots: int) -> int | None:
    """How many tasks can write the snapshots of a delivery as they read it, None where their
    files would be small and a shuffle pays: with few bytes or many snapshots. At most as
    many files as tasks come of a snapshot, and they grow with the delivery."""
    folder = _hadoop_path(spark, path)
    size = _file_system(spark, folder).getContentSummary(folder).getLength()
    tasks = max(spark.sparkContext.defaultParallelism, ceil(size / BYTES_PER_TASK))
    return tasks if size >= tasks * max(1, snapshots) * LEAST_SHARE else None


def _arranged(df: DataFrame, partition_by: Sequence[str], clustered: bool) -> DataFrameWriter:
    """One shuffle that gives each partition files of even size: many for a large one, one
    for a small one, whatever the number of tasks. Rows that come clustered from a scan of
    a table with the same partitioning through narrow operators need no shuffle at all."""
    arranged = df if clustered else df.hint("rebalance", *partition_by)
    return arranged.write.option("maxRecordsPerFile", ROWS_PER_FILE)


def write_snapshots(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (SNAPSHOT,),
    clustered: bool = False,
    stands_for: Sequence[date] = (),
) -> None:
    """Replace the snapshots that occur in ``df``, and those that it stands for.

    ``df`` must hold its snapshots whole. A stored snapshot of ``stands_for`` of which it holds
    no row is removed, once the others are written; all further snapshots stay. Writing the
    same rows again changes nothing.
    """
    spark, on = df.sparkSession, partition_by[-1]
    before = _partitions(spark, path, on) if stands_for else {}
    (
        _arranged(df, partition_by, clustered)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    if not before:
        return
    after = _partitions(spark, path, on)
    for day in stands_for:
        for folder, names in after.get(day, {}).items():
            # a partition that was written again has files of new names
            if names == before.get(day, {}).get(folder):
                hadoop_folder = _hadoop_path(spark, folder)
                _file_system(spark, hadoop_folder).delete(hadoop_folder, True)


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str, on: str) -> Iterator[tuple[str, str]]:
    """``(partition value, folder)`` of a table that is partitioned by ``on`` at its first or
    second level, from the folders' names."""
    for pattern in (f"{path}/{on}=*", f"{path}/*=*/{on}=*"):
        glob = _hadoop_path(spark, pattern)
        for status in _file_system(spark, glob).globStatus(glob) or ():
            yield status.getPath().getName().split("=", 1)[1], status.getPath().toString()


def _partitions(spark: SparkSession, path: str, on: str) -> dict[date, dict[str, set[str]]]:
    """Names of the data files by snapshot and folder; a calendar's worth of folders."""
    found: dict[date, dict[str, set[str]]] = {}
    for value, folder in _folders(spark, path, on):
        try:
            day = date.fromisoformat(value)
        except ValueError:  # the folder of rows without a snapshot
            continue
        listed = _hadoop_path(spark, folder)
        names = {f.getPath().getName() for f in _file_system(spark, listed).listStatus(listed)}
        found.setdefault(day, {})[folder] = {n for n in names if not n.startswith((".", "_"))}
    return found


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    clustered: bool = False,
) -> None:
    """Write a whole table, by default in place of what was there."""
    _arranged(df, partition_by, clustered).mode(mode).partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan with the stored schema or with an imposed one, in whose order the
    columns then come (a partition column would otherwise be last)."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether Parquet files lie below ``path``, on any file system Spark reaches. Only names
    are looked at, up to the first such file."""
    folder = _hadoop_path(spark, path)
    system = _file_system(spark, folder)
    if not system.exists(folder):
        return False
    files = system.listFiles(folder, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def stored_snapshots(spark: SparkSession, path: str, on: str = SNAPSHOT) -> DataFrame:
    """Snapshots of a stored table, by the names of its partition folders; no row is read."""
    return spark.createDataFrame([(d,) for d in partition_days(spark, path, on)], f"{on} date")


def partition_days(spark: SparkSession, path: str, on: str = SNAPSHOT) -> list[date]:
    """Dated partitions of a table that hold data files, by the names of their folders."""
    return sorted(day for day, folders in _partitions(spark, path, on).items() if any(folders.values()))


def partition_tokens(spark: SparkSession, path: str, on: str = SNAPSHOT) -> dict[date, str]:
    """By snapshot a digest of its files' names, which are new whenever it is written; no row is read."""
    return {
        day: hashlib.sha256("\n".join(sorted(n for names in folders.values() for n in names)).encode()).hexdigest()
        for day, folders in _partitions(spark, path, on).items()
        if any(folders.values())
    }


def delivery_token(spark: SparkSession, path: str) -> str | None:
    """A digest of names, sizes and times of the files of a delivery, None without any."""
    folder = _hadoop_path(spark, path)
    system = _file_system(spark, folder)
    if not system.exists(folder):
        return None
    found, listing = [], system.listFiles(folder, True)
    while listing.hasNext():
        f = listing.next()
        found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def subfolders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names of the folders directly below ``path`` that match a glob pattern."""
    glob = _hadoop_path(spark, f"{path}/{pattern}")
    found = _file_system(spark, glob).globStatus(glob) or ()
    return sorted(status.getPath().getName() for status in found if status.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    folder = _hadoop_path(spark, path)
    _file_system(spark, folder).delete(folder, True)


def make_passing_folder(spark: SparkSession, path: str) -> None:
    """Make a folder that is removed with all it holds when the application's JVM ends."""
    folder = _hadoop_path(spark, path)
    system = _file_system(spark, folder)
    system.mkdirs(folder)
    system.deleteOnExit(folder)


def read_note(spark: SparkSession, path: str):
    """The content of a small JSON file, None where there is none."""
    note = _hadoop_path(spark, path)
    system = _file_system(spark, note)
    if not system.exists(note):
        return None
    stream = system.open(note)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, content) -> None:
    """Replace a small JSON file in one step: readers find the old content or the new."""
    note, draft = _hadoop_path(spark, path), _hadoop_path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = _file_system(spark, draft).create(draft, True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    jvm = spark.sparkContext._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(draft, note, options)
