"""Lines of a CSV that do not fit its contract, set aside with what is wrong with them.

The CSV is read once, as text. A line is rejected when it has too many or too few fields, when
a field cannot be read as its column's type, or when its snapshot date cannot be read; all its
faults are told. Good and rejected lines are all lines of the CSV.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType

from lendstrata.functions.dates import ISO_DATE, parse_date
from lendstrata.operators.contracts import ContractError
from lendstrata.sources import files
from lendstrata.sources.specs import LINEAGE, LOAD_DATE, SNAPSHOT, SourceSpec

MALFORMED, FAULTS, LINE = "_malformed", "_faults", "_line"


class TooManyRejects(ContractError):
    def __init__(self, source: str, rejected: int, lines: int, most: float):
        super().__init__(f"{source}: {rejected} of {lines} lines were rejected, at most {most:.2%} may be")


def _read(c: Column, kind: DataType, date_format: str) -> Column:
    """A field as its type, NULL where it cannot be read."""
    if isinstance(kind, StringType):
        return c
    return parse_date(c, date_format) if isinstance(kind, DateType) else c.try_cast(kind)


def sorted_lines(spark: SparkSession, path: str, spec: SourceSpec, counts: Observation | None = None) -> DataFrame:
    """Every line of a CSV: the columns of the raw contract (without the load date), ``_faults``,
    empty for a good line, and ``_line``, the text of a rejected one.

    The header must have the contract's columns, in any order; part files must agree in
    it. ``counts`` observes ``lines`` and ``rejected``.
    """
    header = spark.read.csv(path, header=True).columns
    unknown = [c for c in header if c not in spec.raw.names]
    if unknown:
        raise ContractError(f"{path}: unexpected columns {unknown}")
    files.require_columns(header, spec, path)
    texts = StructType([StructField(c, StringType()) for c in [*header, MALFORMED]])
    lines = spark.read.csv(
        path, header=True, schema=texts, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED
    )
    fields = {f.name: (f.dataType, spec.snapshot_format if f.name == SNAPSHOT else ISO_DATE) for f in spec.raw if f.name in header}
    given = {c: F.when(F.trim(c) != "", F.col(c)) for c in header}  # blank fields hold no value
    read = {c: _read(F.col(c) if isinstance(kind, StringType) else given[c], kind, fmt) for c, (kind, fmt) in fields.items()}
    faults = [F.when(F.col(MALFORMED).isNotNull(), F.lit("number of fields"))]
    for c, (kind, _) in fields.items():
        if not isinstance(kind, StringType):
            fault = F.concat(F.lit(f"{c} is no {kind.simpleString()}: "), given[c])
            wrong = given[c].isNotNull() & read[c].isNull()
            faults.append(F.when(F.col(MALFORMED).isNull() & wrong, fault))
    faults.append(F.when(F.col(MALFORMED).isNull() & given[SNAPSHOT].isNull(), F.lit(f"no {SNAPSHOT}")))
    judged = lines.withColumn(LINEAGE, F.input_file_name()).withColumn(FAULTS, F.array_compact(F.array(*faults)))
    text = F.coalesce(F.col(MALFORMED), F.to_csv(F.struct(*header)))
    typed = judged.select(
        *(read.get(c, F.col(c)).alias(c) for c in spec.raw.names if c != LOAD_DATE),
        FAULTS,
        F.when(F.size(FAULTS) > 0, text).alias(LINE),
    )
    if counts is None:
        return typed
    return typed.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(F.size(FAULTS) > 0).alias("rejected"))


def accepted(lines: DataFrame, spec: SourceSpec) -> DataFrame:
    """The good lines in the raw contract."""
    good = lines.where(F.size(FAULTS) == 0).withColumn(LOAD_DATE, F.col(SNAPSHOT))
    return good.select(*spec.raw.names)


def rejected(lines: DataFrame) -> DataFrame:
    """``file, line, faults`` of the rejected lines."""
    bad = lines.where(F.size(FAULTS) > 0)
    return bad.select(F.col(LINEAGE).alias("file"), F.col(LINE).alias("line"), F.col(FAULTS).alias("faults"))
