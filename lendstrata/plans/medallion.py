"""The whole run: CSV sources to bronze, cleaned silver, mart and gold.

Each step works on all its snapshots in one job. A source that fails does not stop the
others; what failed is raised together at the end of its layer, never swallowed.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession

from lendstrata.functions.dates import month_spine_between
from lendstrata.operators.contracts import ContractError, assert_same_columns, assert_schema
from lendstrata.operators.incremental import missing_snapshots
from lendstrata.plans import gold, mart
from lendstrata.plans.cleaners import SOURCES, clean_snapshots
from lendstrata.session import loading
from lendstrata.sources import files, published, rejects
from lendstrata.sources.specs import LINEAGE, LOAD_DATE, SNAPSHOT, SourceSpec
from lendstrata.sources.staging import staged

logger = logging.getLogger(__name__)

MART_TABLES = (
    "dim_snapshot",
    "dim_customer",
    "dim_feature",
    "dim_credit_mix",
    "dim_payment_behaviour",
    "dim_min_payment",
    "dim_loan_type",
    "fact_clickstream",
    "fact_financials",
    "fact_loan",
    "fact_customer_loan_type",
)
GOLD_TABLES = ("loan_analytics_star", "label_store")
PARALLEL_STEPS = 4


@dataclass(frozen=True)
class Layout:
    """Where each table lives."""

    raw: str
    lake: str

    def csv(self, source: str) -> str:
        return f"{self.raw}/{source}.csv"

    def bronze(self, source: str) -> str:
        return f"{self.lake}/bronze/{source}"

    def cleaned(self, spec: SourceSpec) -> str:
        return f"{self.lake}/silver/{spec.cleaned_name}"

    def mart(self, table: str) -> str:
        return f"{self.lake}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.lake}/gold/{table}"

    def rejects(self, source: str) -> str:
        return f"{self.lake}/rejects/{source}"

    def ledger(self, what: str) -> str:
        """What was worked on, for runs that only take in what changed."""
        return f"{self.lake}/ledger/{what}"


@dataclass(frozen=True)
class RunConfig:
    layout: Layout
    start: date = date(2023, 1, 1)
    end: date = date(2024, 12, 1)
    dpd_threshold: int = 30
    mob_threshold: int = 6
    reload: bool = False  # clean snapshots again that are stored already
    most_rejects: float | None = None  # share of a CSV's lines that may be rejected; None: none, and nothing is stored
    star: gold.StarOptions = field(default_factory=gold.StarOptions)


class RunFailed(RuntimeError):
    """Carries the failures of a layer by source."""

    def __init__(self, layer: str, failures: dict[str, Exception]):
        self.layer, self.failures = layer, failures
        super().__init__(f"{layer}: " + "; ".join(f"{n}: {e}" for n, e in failures.items()))


def snapshot_dates(spark: SparkSession, start: date, end: date) -> list[date]:
    """The calendar as literals for partition filters: one date per month of the range."""
    return [r.snapshot_date for r in month_spine_between(spark, start, end).orderBy(SNAPSHOT).collect()]


def load_bronze(
    spark: SparkSession,
    csv_path: str,
    bronze_path: str,
    spec: SourceSpec,
    dates: Sequence[date],
    rejects_path: str | None = None,
    most_rejects: float = 0.0,
) -> dict[str, int]:
    """All wanted snapshots of one CSV in one pass, in place of those stored; a wanted snapshot
    that the CSV no longer has goes. Returns how many rows were read and rejected.

    Without ``rejects_path`` a line that does not fit the contract fails the source. With it,
    such lines are stored there with their file and what is wrong, and the others are loaded;
    if they are more than ``most_rejects`` of all lines, the source fails after they were
    stored and bronze stays as it was.
    """
    if rejects_path is None:
        rows = files.read_snapshots(spark, csv_path, spec, dates)
        # the CSV has those wanted and those loaded before
        tasks = files.tasks_for(spark, csv_path, len({*dates, *files.partition_days(spark, bronze_path)}))
        if tasks:
            rows = rows.coalesce(tasks).sortWithinPartitions(LOAD_DATE, SNAPSHOT)
        files.write_snapshots(rows, bronze_path, [LOAD_DATE, SNAPSHOT], clustered=bool(tasks), stands_for=dates)
        return {}
    counts = Observation(f"lines_{spec.name}")
    with staged(rejects.sorted_lines(spark, csv_path, spec, counts), f"lines-{spec.name}") as lines:
        found = counts.get
        published.publish(rejects.rejected(lines), rejects_path, partitioned=False, clustered=True)
        if found["rejected"] > most_rejects * found["lines"]:
            raise rejects.TooManyRejects(spec.name, found["rejected"], found["lines"], most_rejects)
        rows = files.slice_snapshots(rejects.accepted(lines, spec), dates)
        files.write_snapshots(rows, bronze_path, [LOAD_DATE, SNAPSHOT], stands_for=dates)
    return found


def take_in(spark: SparkSession, config: RunConfig, name: str, dates: Sequence[date]) -> dict[str, int]:
    """``load_bronze`` of a registered source, with rejects as the run is configured."""
    layout = config.layout
    paths = (layout.csv(name), layout.bronze(name))
    if config.most_rejects is None:
        return load_bronze(spark, *paths, SOURCES[name], dates)
    return load_bronze(spark, *paths, SOURCES[name], dates, layout.rejects(name), config.most_rejects)


def read_bronze(spark: SparkSession, bronze_path: str, spec: SourceSpec) -> DataFrame:
    """Stored bronze, checked against the raw contract and read with it."""
    assert_schema(files.read_table(spark, bronze_path), spec.raw, spec.name)
    return files.read_table(spark, bronze_path, spec.raw)


def load_cleaned(
    spark: SparkSession,
    bronze_path: str,
    cleaned_path: str,
    spec: SourceSpec,
    dates: Sequence[date],
    reload: bool = False,
) -> dict[str, int]:
    """Clean the wanted snapshots that are not stored yet; returns the audit figures.

    The snapshots to do are at most as many as the calendar has, so the list is small.
    """
    bronze = read_bronze(spark, bronze_path, spec)
    if not reload:
        wanted = files.slice_snapshots(files.stored_snapshots(spark, bronze_path), dates)
        missing = missing_snapshots(wanted, files.stored_snapshots(spark, cleaned_path))
        dates = [r.snapshot_date for r in missing.collect()]
    if not dates:
        logger.info("%s: all snapshots are stored", spec.name)
        return {}
    audit = Observation(f"audit_{spec.name}")
    cleaned = clean_snapshots(files.slice_snapshots(bronze, dates), spec, audit)
    if files.table_exists(spark, cleaned_path):
        assert_same_columns(cleaned, files.read_table(spark, cleaned_path), ignore=(SNAPSHOT, LINEAGE))
    files.write_snapshots(cleaned, cleaned_path, clustered=True, stands_for=dates if reload else ())
    logger.info("%s: %s", spec.name, audit.get)
    return audit.get


def read_cleaned(spark: SparkSession, layout: Layout) -> mart.CleanedTables:
    def table(source: str) -> DataFrame:
        spec = SOURCES[source]
        return files.read_table(spark, layout.cleaned(spec), spec.cleaned)

    return mart.CleanedTables(
        loans=table("lms_loan_daily"),
        attributes=table("features_attributes"),
        clickstream=table("feature_clickstream"),
        financials=table("features_financials"),
    )


def cleaned_days(spark: SparkSession, layout: Layout) -> set[date]:
    """Snapshots of any of the cleaned tables, by the names of their folders."""
    return {d for spec in SOURCES.values() for d in files.partition_days(spark, layout.cleaned(spec))}


def read_mart(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {name: published.read(spark, layout.mart(name)) for name in MART_TABLES}


def read_gold(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    return published.read(spark, layout.gold(table))


def write_mart(spark: SparkSession, tables: dict[str, DataFrame], layout: Layout) -> None:
    """Facts are partitioned by snapshot as the cleaned tables are, so they are written
    without a shuffle; dimensions are not partitioned. Readers see each old table until the
    new one is complete."""

    def write(name: str) -> None:
        fact = name.startswith("fact_")
        published.publish(tables[name], layout.mart(name), partitioned=fact, clustered=fact)

    failures = _attempt(spark, tables, write)
    if failures:
        raise RunFailed("mart", failures)


def write_gold(spark: SparkSession, config: RunConfig) -> None:
    """Star and labels, by snapshot. The star's base is staged by snapshot while its rows
    are still folded, so the unfolded star is written without a shuffle."""
    tables = read_mart(spark, config.layout)
    with staged(gold.star_base(tables, config.star.grain), "star-base", [SNAPSHOT]) as base:
        star = gold.star_features(base, config.star)
        published.publish(star, config.layout.gold("loan_analytics_star"), clustered=True)
    labels = gold.label_store(tables["fact_loan"], config.dpd_threshold, config.mob_threshold)
    published.publish(labels, config.layout.gold("label_store"), clustered=True)


def run(spark: SparkSession, config: RunConfig) -> dict[str, dict[str, int]]:
    """Run all layers; returns the audit figures of the cleaned batches by source.

    A registered source without a CSV, a CSV without a contract and a source that fails are
    raised together at the end; the rest of the run is done with what is stored.
    """
    with loading(spark):
        return _run(spark, config)


def _run(spark: SparkSession, config: RunConfig) -> dict[str, dict[str, int]]:
    layout, audits = config.layout, {}
    dates = snapshot_dates(spark, config.start, config.end)
    delivered = files.list_csv_sources(spark, layout.raw)
    present = [n for n in delivered if n in SOURCES]

    def ingest(name: str) -> None:
        take_in(spark, config, name, dates)

    def clean(name: str) -> None:
        spec = SOURCES[name]
        audits[name] = load_cleaned(
            spark, layout.bronze(name), layout.cleaned(spec), spec, dates, config.reload
        )

    failures: dict[str, Exception] = {n: ContractError("no contract for this source") for n in delivered if n not in SOURCES}
    failures |= {n: FileNotFoundError(layout.csv(n)) for n in SOURCES if n not in delivered}
    failures |= _attempt(spark, present, ingest)
    failures |= _attempt(spark, [n for n in present if n not in failures], clean)
    absent = [s.name for s in SOURCES.values() if not files.table_exists(spark, layout.cleaned(s))]
    if absent:
        raise RunFailed("silver", failures)
    write_mart(spark, mart.build_mart(read_cleaned(spark, layout), cleaned_days(spark, layout)), layout)
    write_gold(spark, config)
    if failures:
        raise RunFailed("silver", failures)
    return audits


def _attempt(spark: SparkSession, names: Iterable[str], step: Callable[[str], None]) -> dict[str, Exception]:
    """Run independent steps side by side, so that small ones do not leave the cluster idle."""
    failures: dict[str, Exception] = {}

    def attempt(name: str) -> None:
        try:
            step(name)
        except Exception as e:  # kept and raised by the caller once the other steps are done
            logger.exception("%s failed", name)
            failures[name] = e

    with ThreadPoolExecutor(PARALLEL_STEPS) as pool:
        list(pool.map(inheritable_thread_target(spark)(attempt), names))
    return failures
