"""Contracts found in CSV files, as an aggregate over all their rows.

Types form a lattice: nothing, int, bigint, double; each date format; boolean; and string above
all. What a column may be is kept as one truth per type, and truths of rows, tasks and files
are merged by AND, so the result does not depend on the order or number of files, and a file
without values changes nothing. The truths of a value are bits of one number, and values are
grouped by their column, so that the tests are compiled once, however many columns there are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lendstrata.functions.dates import ISO_DATE, SHORT_US_DATE, parse_date

#: A number is text that stays the same when it is written back, but for digits of a fraction; it is
#: whole without point and exponent.
NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"
FILE = "_file"


def _shape(fmt: str) -> str | None:
    """A pattern that the text of any date in a format begins with; None for formats with quoted
    or optional parts."""
    if re.search(r"['\[\]{}#]", fmt):
        return None
    parts = (m[0] for m in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]", fmt))
    return "^" + "".join(
        r"[-+\s]*[0-9]+" if re.fullmatch(r"[yud]+|MM?", p) else ".+" if p.isalpha() else re.escape(p) for p in parts
    )


def _is_date(c: Column, fmt: str) -> Column:
    """Whether text is a date. A failed parse costs microseconds, so only text that has the marks
    of the format and looks like a date is parsed."""
    parsed, shape = parse_date(c, fmt).isNotNull(), _shape(fmt)
    if shape is None:
        return parsed
    marks = [c.contains(mark) for mark in sorted({m for m in fmt if not m.isalpha()})]
    return F.when(reduce(and_, [*marks, c.rlike(shape)]), parsed).otherwise(False)


def _may_be(c: Column, kinds: Sequence[str], date_formats: Sequence[str]) -> Column:
    """For one value, which of the ``kinds`` it may have, as bits; the first that all values share
    is taken. Whatever is a number for ``NUMBER`` can be cast to double."""

    def bit(kind: str, when: Column | None = None) -> Column:
        value = F.lit(1 << kinds.index(kind))
        return value if when is None else F.when(when, value).otherwise(0)

    def any_of(first: Column, *others: Column) -> Column:
        for other in others:
            first = first.bitwiseOR(other)
        return first

    dates = [bit(f"date {fmt}", _is_date(c, fmt)) for fmt in date_formats]
    fits = [bit(t, c.try_cast(t).isNotNull()) for t in ("int", "bigint")]
    fraction = c.contains(".") | c.contains("e") | c.contains("E")
    number = F.when(fraction, bit("double")).otherwise(any_of(bit("double"), *fits))
    return (
        F.when(c.rlike(NUMBER), any_of(number, *dates))
        .otherwise(any_of(bit("boolean", F.lower(c).isin("true", "false")), *dates))
    )


def column_types(
    spark: SparkSession, path: str, by_file: bool = False, date_formats: Sequence[str] = (ISO_DATE, SHORT_US_DATE)
) -> DataFrame:
    """``position, column_name, data_type, date_format, n_values, n_nulls`` of each column of a
    CSV with header, or of each of its part files with ``by_file``; ``data_type`` is ``void`` for
    a column without values. Blank fields are NULL. Part files must agree in their columns."""
    header = spark.read.csv(path, header=True).columns
    texts = StructType([StructField(c, StringType()) for c in header])
    rows = spark.read.csv(path, header=True, schema=texts, enforceSchema=False, mode="FAILFAST")
    kinds = ["int", "bigint", "double", *(f"date {fmt}" for fmt in date_formats), "boolean"]
    keys = [FILE] if by_file else []
    files = [F.input_file_name().alias(FILE)] if by_file else []
    value = F.when(F.trim("_text") != "", F.col("_text"))
    found = (
        rows.select(*files, F.posexplode(F.array(*(F.col(f"`{c}`") for c in header))).alias("position", "_text"))
        .select(*keys, "position", F.when(value.isNotNull(), _may_be(value, kinds, date_formats)).alias("_may"))
        .groupBy(*keys, "position")
        .agg(F.count("_may").alias("n_values"), F.count_if(F.isnull("_may")).alias("n_nulls"), F.bit_and("_may").alias("_may"))
    )
    # without rows, columns are there nevertheless
    columns = spark.createDataFrame(list(enumerate(header)), "position int, column_name string")
    named = F.broadcast(columns).join(found, "position") if by_file else columns.join(F.broadcast(found), "position", "left")
    bits = [F.when(F.col("_may").bitwiseAND(F.lit(1 << i)) != 0, F.lit(kind)) for i, kind in enumerate(kinds)]
    kind = F.split(F.when(F.col("_may").isNull(), F.lit("void")).otherwise(F.coalesce(*bits, F.lit("string"))), " ", 2)
    counts = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("n_values", "n_nulls")]
    types = [F.element_at(kind, 1).alias("data_type"), F.get(kind, F.lit(1)).alias("date_format")]
    return named.select(*keys, "position", "column_name", *types, *counts)


def as_contract(types: DataFrame) -> tuple[StructType, dict[str, str]]:
    """A contract from ``column_types``, columns without values as strings, and the formats of
    its dates. There is a row for each column."""
    found = types.orderBy("position").collect()
    fields = ", ".join(f"`{r.column_name}` {'string' if r.data_type == 'void' else r.data_type}" for r in found)
    return StructType.fromDDL(fields), {r.column_name: r.date_format for r in found if r.date_format}
