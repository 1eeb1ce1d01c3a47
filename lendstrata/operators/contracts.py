"""Schema contracts. All checks look at metadata only and start no job."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


class ContractError(ValueError):
    """A dataset does not have the columns its contract promises."""


def schema_differences(actual: StructType, expected: StructType) -> list[str]:
    """Readable differences in names, order, types and nullability; empty when equal.

    A column that is never NULL also fulfils a contract that allows NULL.
    """
    found = {f.name: f for f in actual}
    wanted = {f.name: f for f in expected}
    out = [f"missing column {n}" for n in wanted if n not in found]
    out += [f"unexpected column {n}" for n in found if n not in wanted]
    for name in wanted.keys() & found.keys():
        a, e = found[name], wanted[name]
        if a.dataType != e.dataType:
            out.append(f"{name} is {a.dataType.simpleString()}, expected {e.dataType.simpleString()}")
        elif a.nullable and not e.nullable:
            out.append(f"{name} may be NULL, expected it never is")
    if not out and actual.names != expected.names:
        out.append(f"column order {actual.names}, expected {expected.names}")
    return sorted(out)


def assert_schema(df: DataFrame, expected: StructType, what: str = "dataset") -> DataFrame:
    """Return ``df`` unchanged when its schema fulfils the contract, else raise."""
    differences = schema_differences(df.schema, expected)
    if differences:
        raise ContractError(f"{what}: " + "; ".join(differences))
    return df


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Exactly the contract's columns in the contract's order."""
    return df.select(*contract.names)


def assert_same_columns(incoming: DataFrame, stored: DataFrame, ignore: Collection[str] = ()) -> None:
    """Both hold the same column set, apart from the ignored ones."""
    left, right = set(incoming.columns) - set(ignore), set(stored.columns) - set(ignore)
    if left != right:
        raise ContractError(f"only incoming: {sorted(left - right)}; only stored: {sorted(right - left)}")
