"""Runs a workload query and its oracle and compares them value for value."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from lendstrata.workload.oracles import oracle_sql
from lendstrata.workload.queries import queries


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain_type(t: pa.DataType) -> str:
    return {"large_string": "string", "string_view": "string"}.get(str(t), str(t))


def differences(spark: SparkSession, name: str, sf_dir: str, query=None, sql: str | None = None) -> list[str]:
    """What differs in columns, types and rows; empty when all agree."""
    got = (query or queries()[name])(spark, sf_dir).toArrow()
    want = connect(sf_dir).sql(sql or oracle_sql()[name]).to_arrow_table()
    columns = sorted(got.column_names)
    if columns != sorted(want.column_names):
        return [f"columns {columns} against {sorted(want.column_names)}"]
    out = [
        f"{c}: {got.schema.field(c).type} against {want.schema.field(c).type}"
        for c in columns
        if plain_type(got.schema.field(c).type) != plain_type(want.schema.field(c).type)
    ]
    if got.num_rows != want.num_rows:
        out.append(f"{got.num_rows} rows against {want.num_rows}")
    if got.num_rows == 0:
        out.append("no rows")
    ours, theirs = (Counter(zip(*(map(repr, t.column(c).to_pylist()) for c in columns))) for t in (got, want))
    for label, rest in (("only in Spark", ours - theirs), ("only in the oracle", theirs - ours)):
        if rest:
            out.append(f"{label} ({rest.total()}): {list(zip(columns, next(iter(rest))))}")
    return out
