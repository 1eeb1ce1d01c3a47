"""Digests of snapshots: whether two hold the same rows, told without comparing rows.

A digest is the sum of two 64-bit hashes of each row. It does not depend on the order of rows or
on how they are spread over tasks and files, repeated rows count as often as they occur, and
partial sums are combined before the only, small shuffle.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from lendstrata.sources.specs import SNAPSHOT

LANES = 2


def _row_hash(columns: Collection[str], lane: int) -> Column:
    """A hash that also tells which columns are NULL; hashing alone passes over them."""
    absent = [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(lane), *columns, *absent)


def snapshot_digests(df: DataFrame, by: str = SNAPSHOT, ignore: Collection[str] = ()) -> DataFrame:
    """``by, row_count, digest`` of each snapshot; columns count by name, in any order."""
    columns = sorted(c for c in df.columns if c != by and c not in ignore)
    lanes = [F.sum(_row_hash(columns, lane).cast("decimal(28,0)")) for lane in range(LANES)]
    summed = df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"), *(s.alias(f"_{n}") for n, s in enumerate(lanes)))
    return summed.select(by, "row_count", F.concat_ws(":", "row_count", *(f"_{n}" for n in range(LANES))).alias("digest"))


def digest_states(incoming: DataFrame, stored: DataFrame, by: str = SNAPSHOT) -> DataFrame:
    """``by, state`` of each snapshot of two tables of digests: ``new``, ``gone``, ``same`` or
    ``changed``."""
    a, b = incoming.select(by, F.col("digest").alias("_now")), stored.select(by, F.col("digest").alias("_before"))
    state = (
        F.when(F.col("_before").isNull(), "new")
        .when(F.col("_now").isNull(), "gone")
        .when(F.col("_now") == F.col("_before"), "same")
        .otherwise("changed")
    )
    return a.join(b, by, "full").select(by, state.alias("state"))


@dataclass(frozen=True)
class Seen:
    """What is known of a snapshot that was worked on: the token of its files, which changes
    with every write, and the digest of its rows, where it was taken."""

    token: str
    digest: str | None = None


@dataclass(frozen=True)
class Delta:
    """Snapshots with other rows than before, those that are gone, and what to remember."""

    changed: list[date]
    gone: list[date]
    seen: dict[date, Seen]

    @property
    def touched(self) -> list[date]:
        return sorted({*self.changed, *self.gone})


def delta(tokens: Mapping[date, str], known: Mapping[date, Seen], digests=None) -> Delta:
    """What changed since ``known`` in a table whose snapshots now have ``tokens``.

    Snapshots with their old token are not read. ``digests(dates)`` gives the digests of those
    that were written; one with its old digest has not changed. Without it, written snapshots
    count as changed.
    """
    written = sorted(d for d, token in tokens.items() if d not in known or known[d].token != token)
    taken = digests(written) if digests and written else {}
    seen = dict(known) | {d: Seen(tokens[d], taken.get(d)) for d in written}
    gone = sorted(d for d in known if d not in tokens)
    same = {d for d in written if d in known and taken.get(d) is not None and known[d].digest == taken[d]}
    return Delta([d for d in written if d not in same], gone, {d: s for d, s in seen.items() if d in tokens})
