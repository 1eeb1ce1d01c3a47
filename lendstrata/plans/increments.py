"""Runs that take in only what changed.

Every table remembers what it was made from: of a table with snapshots a token of each
snapshot's files, of a dimension the version. A step looks at names of files first and reads
only snapshots that were written since. Bronze snapshots are compared by the digests of their
rows, too, so those that are delivered again unchanged go no further. What a step has done is
noted after its table is published, so a run that dies is simply run again.

* Facts and labels follow their source snapshot by snapshot.
* Dimensions of distinct values are kept with the number of rows of each snapshot that
  contribute each value. New snapshots only add values; after a snapshot was replaced or
  withdrawn, the stored counts of all snapshots are merged.
* The star's base, its joined but still folded rows, is kept by snapshot. A snapshot is joined
  again when one of its facts changed; of the others, the rows of customers that changed.
* Fences come from quantile sketches of the base's snapshots, merged; no history is read for
  them. When fences or the least balance move, all snapshots of the star follow, without joins,
  from the base. With ``keep_parameters`` those of the run before stay in force, and only
  the snapshots that were joined again are written.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendstrata.operators import quantiles, sketches
from lendstrata.operators.digests import Delta, Seen, delta, snapshot_digests
from lendstrata.plans import gold, mart
from lendstrata.plans.cleaners import SOURCES
from lendstrata.plans.medallion import (
    Layout,
    RunConfig,
    RunFailed,
    _attempt,
    cleaned_days,
    load_cleaned,
    read_bronze,
    snapshot_dates,
    take_in,
)
from lendstrata.session import loading
from lendstrata.sources import files, published
from lendstrata.sources.specs import LINEAGE, LOAD_DATE, SNAPSHOT
from lendstrata.sources.staging import stage, stage_all

STAR, BASE, LABELS = "loan_analytics_star", "star_base", "label_store"
STAR_FACTS = ("fact_financials", "fact_loan", "fact_customer_loan_type")
#: Changed customers up to so many are broadcast to find their rows.
FEW_CUSTOMERS = 250_000
CLEANED = {
    "loans": "lms_loan_daily",
    "attributes": "features_attributes",
    "clickstream": "feature_clickstream",
    "financials": "features_financials",
}

Written = dict[str, list[date]]


# notes


def _known(spark: SparkSession, layout: Layout, what: str) -> dict[date, Seen]:
    note = files.read_note(spark, layout.ledger(f"{what}.json")) or {}
    return {date.fromisoformat(d): Seen(*entry) for d, entry in note.items()}


def _note(spark: SparkSession, layout: Layout, what: str, seen: Mapping[date, Seen]) -> None:
    entries = {d.isoformat(): [s.token, s.digest] for d, s in sorted(seen.items())}
    files.write_note(spark, layout.ledger(f"{what}.json"), entries)


def _digests(table: DataFrame):
    """Digests of given snapshots of a stored table, of which only these are read."""

    def taken(dates: list[date]) -> dict[date, str]:
        rows = snapshot_digests(files.slice_snapshots(table, dates), ignore=(LINEAGE, LOAD_DATE))
        return {r[SNAPSHOT]: r.digest for r in rows.collect()}  # a row for each of these snapshots

    return taken


def cleaned_table(spark: SparkSession, layout: Layout, source: str) -> DataFrame:
    """A cleaned table, empty as long as nothing of it is stored."""
    spec = SOURCES[CLEANED[source]]
    if not files.table_exists(spark, layout.cleaned(spec)):
        return spark.createDataFrame([], spec.cleaned)
    return files.read_table(spark, layout.cleaned(spec), spec.cleaned)


# bronze and silver


def load_source(spark: SparkSession, config: RunConfig, name: str, dates: list[date]) -> tuple[list[date], dict[str, int]]:
    """Take in the snapshots of a CSV that bronze does not hold yet, or with ``reload`` all, and
    clean those whose rows are new or differ. What a CSV did not have is not looked for again
    until its files change."""
    layout, spec = config.layout, SOURCES[name]
    stored = set(files.partition_days(spark, layout.bronze(name)))
    note, delivery = files.read_note(spark, layout.ledger(f"bronze/{name}.json")), files.delivery_token(spark, layout.csv(name))
    asked = {date.fromisoformat(d) for d in note["asked"]} if note and note["delivery"] == delivery else set()
    wanted = [d for d in dates if config.reload or d not in stored | asked]
    if wanted:
        take_in(spark, config, name, wanted)
        asked = sorted(d.isoformat() for d in asked | set(wanted))
        files.write_note(spark, layout.ledger(f"bronze/{name}.json"), {"delivery": delivery, "asked": asked})
    if not files.table_exists(spark, layout.bronze(name)):
        return [], {}
    tokens = files.partition_tokens(spark, layout.bronze(name))
    bronze = read_bronze(spark, layout.bronze(name), spec)
    found = delta(tokens, _known(spark, layout, f"cleaned/{name}"), _digests(bronze))
    audit = load_cleaned(spark, layout.bronze(name), layout.cleaned(spec), spec, found.touched, reload=True) if found.touched else {}
    _note(spark, layout, f"cleaned/{name}", found.seen)
    return found.touched, audit


# mart


def _source_delta(spark: SparkSession, layout: Layout, source: str, consumer: str) -> Delta:
    """What changed in a cleaned table since ``consumer`` was made from it. A cleaned snapshot
    is only written when its bronze rows changed, so the names of its files tell."""
    tokens = files.partition_tokens(spark, layout.cleaned(SOURCES[CLEANED[source]]))
    return delta(tokens, _known(spark, layout, consumer))


def update_fact(spark: SparkSession, layout: Layout, name: str) -> list[date]:
    """Write those snapshots of a fact whose cleaned rows changed."""
    source = mart.FACT_SOURCES[name]
    found = _source_delta(spark, layout, source, name)
    if found.touched or not published.is_published(spark, layout.mart(name)):
        cleaned = files.slice_snapshots(cleaned_table(spark, layout, source), found.changed)
        published.publish(mart.build_fact(name, cleaned), layout.mart(name), replaces=found.touched, clustered=True)
    _note(spark, layout, name, found.seen)
    return found.touched


def update_dimension(spark: SparkSession, layout: Layout, name: str) -> bool:
    """Bring a dimension of distinct values up to date; whether its rows changed."""
    dimension, path, counts_path = mart.DISTINCT_DIMENSIONS[name], layout.mart(name), layout.ledger(f"counts/{name}")
    known = _known(spark, layout, name)
    found = _source_delta(spark, layout, dimension.source, name)
    fresh = not published.is_published(spark, path)
    if not found.touched and not fresh:
        _note(spark, layout, name, found.seen)
        return False
    cleaned = files.slice_snapshots(cleaned_table(spark, layout, dimension.source), found.changed)
    counted = cleaned.groupBy(SNAPSHOT, *dimension.columns).agg(F.count(F.lit(1)).alias("contributing"))
    published.publish(counted.select(*dimension.columns, "contributing", SNAPSHOT), counts_path, replaces=found.touched)
    counts = published.read(spark, counts_path)
    only_new = not fresh and not found.gone and not any(d in known for d in found.changed)
    changed = True
    if only_new:
        incoming = dimension.build(files.slice_snapshots(counts, found.changed).select(*dimension.columns))
        before = published.read(spark, path)
        added = incoming.join(before.select(*dimension.identity), list(dimension.identity), "left_anti")
        changed = not added.isEmpty()
        now = before.unionByName(added)
    else:
        merged = counts.groupBy(*dimension.columns).agg(F.sum("contributing").alias("contributing"))
        now = dimension.build(merged.where("contributing > 0").select(*dimension.columns))
    if changed:
        published.publish(now, path, partitioned=False)
    _note(spark, layout, name, found.seen)
    return changed


def update_mart(spark: SparkSession, layout: Layout) -> Written:
    """Facts by the snapshots written, dimensions that changed with no snapshots."""
    written: Written = {}

    def fact(name: str) -> None:
        if dates := update_fact(spark, layout, name):
            written[name] = dates

    def dimension(name: str) -> None:
        if update_dimension(spark, layout, name):
            written[name] = []

    def small(name: str) -> None:
        """Dimensions that follow from schemas and folder names."""
        if name == "dim_snapshot":
            now = mart.dim_snapshot_of(spark, cleaned_days(spark, layout))
        elif name == "dim_feature":
            now = mart.dim_feature(spark)
        else:
            now = mart.dim_loan_type(spark, mart.loan_flags(cleaned_table(spark, layout, "financials")))
        path = layout.mart(name)
        if not published.is_published(spark, path) or not _same_rows(published.read(spark, path), now):
            published.publish(now.coalesce(1), path, partitioned=False)
            written[name] = []

    steps = dict.fromkeys(mart.FACT_SOURCES, fact) | dict.fromkeys(mart.DISTINCT_DIMENSIONS, dimension)
    steps |= dict.fromkeys(("dim_snapshot", "dim_feature", "dim_loan_type"), small)
    failures = _attempt(spark, steps, lambda name: steps[name](name))
    if failures:
        raise RunFailed("mart", failures)
    return written


def _same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Of two tables as long as the calendar or as a list of columns."""
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))


# gold


def _changed_customers(spark: SparkSession, layout: Layout, before: str | None) -> DataFrame | None:
    """Ids of customers whose dimension rows are not as in the version that the base was joined
    to; None where that version is gone."""
    path = layout.mart("dim_customer")
    old = published.read_folder(spark, path, before) if before else None
    if old is None:
        return None
    now = published.read(spark, path)
    ids = mart.DISTINCT_DIMENSIONS["dim_customer"].identity
    sides = now.select(*ids, F.lit(1).alias("_side")).unionByName(old.select(*ids, F.lit(-1).alias("_side")))
    differ = sides.groupBy(*ids).agg(F.sum("_side").alias("_side")).where("_side <> 0")
    return differ.select("customer_id").distinct()


def _joined_for(
    tables: dict[str, DataFrame], base: DataFrame, dates: list[date], theirs: list[date], ids: DataFrame, grain: str
) -> DataFrame:
    """The base's rows of ``dates``, whose facts changed, and of ``theirs``, where customers did:
    there only the rows of the customers ``ids`` are joined again, as every row is one customer's,
    and the others stay as they are. Their facts are staged, as rows of scans are numbered alike
    whenever they are read."""
    keys = {"fact_loan": ["loan_id", *gold.BY_SNAPSHOT], "fact_customer_loan_type": gold.BY_SNAPSHOT}
    facts = {name: tables[name].select(*keys.get(name, tables[name].columns)) for name in STAR_FACTS}
    own = stage_all(
        **{n: files.slice_snapshots(f, theirs).join(ids, "customer_id", "left_semi").select(*f.columns) for n, f in facts.items()}
    )
    again = {name: files.slice_snapshots(f, dates).unionByName(own[name]) for name, f in facts.items()}
    stay = files.slice_snapshots(base, theirs).join(ids, "customer_id", "left_anti")
    return gold.star_base(tables | again, grain).unionByName(stay)


def update_base(spark: SparkSession, config: RunConfig) -> Delta:
    """Join again the snapshots of the star's base that are no longer what the mart gives."""
    layout = config.layout
    note = files.read_note(spark, layout.ledger(f"{BASE}.json")) or {}
    path, customers = layout.gold(BASE), published.token(spark, layout.mart("dim_customer"))
    again = note.get("grain") != config.star.grain or not published.is_published(spark, path)
    found = {
        name: delta(
            published.partition_tokens(spark, layout.mart(name)),
            {} if again else {date.fromisoformat(d): Seen(t) for d, t in note["facts"][name].items()},
        )
        for name in STAR_FACTS
    }
    dates = {d for each in found.values() for d in each.touched}
    ids, theirs = None, set()
    if not again and note["customers"] != customers:
        ids = _changed_customers(spark, layout, note["customers"])
        if ids is not None:
            ids = stage(ids, "changed-customers")
            # their zipped file says little of the room that they take at the driver
            ids = ids.hint("broadcast" if ids.count() <= FEW_CUSTOMERS else "merge")
        financials = published.read(spark, layout.mart("fact_financials")).select("customer_id", SNAPSHOT)
        hit = financials if ids is None else financials.join(ids, "customer_id", "left_semi")
        theirs = {r[0] for r in hit.select(SNAPSHOT).distinct().collect()} - dates
        if ids is None:
            dates, theirs = dates | theirs, set()
    if again:
        dates |= set(published.partition_tokens(spark, path)) if published.is_published(spark, path) else set()
    if dates or theirs or again:
        tables = {name: published.read(spark, layout.mart(name)) for name in (*STAR_FACTS, "dim_customer")}
        if theirs:
            made = _joined_for(tables, published.read(spark, path), sorted(dates), sorted(theirs), ids, config.star.grain)
        else:
            tables |= {name: files.slice_snapshots(tables[name], sorted(dates)) for name in STAR_FACTS}
            made = gold.star_base(tables, config.star.grain)
        dates |= theirs
        published.publish(made, path, replaces=dates)
        base = files.slice_snapshots(published.read(spark, path), sorted(dates))
        columns = [c for c in config.star.outlier_columns if c in base.columns]
        summed = sketches.quantile_sketches(base, columns, [SNAPSHOT], weight="_copies")
        published.publish(summed.select(sketches.BIT, *columns, SNAPSHOT), layout.gold("star_sketches"), replaces=dates)
    facts = {name: {d.isoformat(): s.token for d, s in each.seen.items()} for name, each in found.items()}
    note = {"facts": facts, "customers": customers, "grain": config.star.grain}
    files.write_note(spark, layout.ledger(f"{BASE}.json"), note)
    tokens = published.partition_tokens(spark, path)
    star = files.read_note(spark, layout.ledger(f"{STAR}.json")) or {"seen": {}}
    return delta(tokens, {date.fromisoformat(d): Seen(t) for d, t in star["seen"].items()})


def star_fences(spark: SparkSession, config: RunConfig) -> quantiles.Fences:
    """Fences over all snapshots of the base: from merged sketches, or with an error of 0 from
    the rows themselves."""
    base, options = published.read(spark, config.layout.gold(BASE)), config.star
    columns = [c for c in options.outlier_columns if c in base.columns]
    if options.relative_error == 0:
        return quantiles.iqr_fences(base, columns, options.iqr_factor, 0, weight="_copies")
    kept = published.read(spark, config.layout.gold("star_sketches"))
    found = sketches.sketch_quantiles(kept, columns, [0.25, 0.75]).first()
    k = options.iqr_factor
    return {
        c: (None, None) if found[c][0] is None else (found[c][0] - k * (found[c][1] - found[c][0]), found[c][1] + k * (found[c][1] - found[c][0]))
        for c in columns
    }


def _least_balances(base: DataFrame, fences: quantiles.Fences) -> dict[str, float | None]:
    kept = quantiles.within_fences(base, fences)
    return {r[0].isoformat(): r[1] for r in kept.groupBy(SNAPSHOT).agg(F.min(gold.BALANCE).cast("double")).collect()}


def update_star(spark: SparkSession, config: RunConfig, keep_parameters: bool = False) -> list[date]:
    """Write the snapshots of the star that follow from a changed base or changed parameters."""
    layout, options = config.layout, config.star
    found = update_base(spark, config)
    old = files.read_note(spark, layout.ledger(f"{STAR}.json"))
    stated = [options.grain, list(options.outlier_columns), options.iqr_factor, options.relative_error]
    usable = old is not None and old["options"] == stated and published.is_published(spark, layout.gold(STAR))
    if usable and not found.touched:
        return []
    base = published.read(spark, layout.gold(BASE))
    every = sorted(published.partition_tokens(spark, layout.gold(BASE)))
    if usable and keep_parameters:
        fences, minima, least = {c: tuple(f) for c, f in old["fences"].items()}, old["minima"], old["least"]
        dates = found.touched
    else:
        fences = star_fences(spark, config)
        moved = not usable or fences != {c: tuple(f) for c, f in old["fences"].items()}
        fresh = _least_balances(base if moved else files.slice_snapshots(base, found.changed), fences)
        kept = {} if moved else {d: v for d, v in old["minima"].items() if date.fromisoformat(d) not in found.touched}
        minima = kept | fresh
        least = min((v for v in minima.values() if v is not None), default=None)
        dates = found.touched if not moved and least == old["least"] else sorted({*every, *found.touched})
    part = files.slice_snapshots(base, [d for d in dates if d in set(every)])
    star = gold.star_features(part, options, fences, 0.0 if least is None else least)
    published.publish(star, layout.gold(STAR), replaces=dates if usable else None, clustered=True)
    seen = {d.isoformat(): s.token for d, s in found.seen.items()}
    note = {"seen": seen, "options": stated, "fences": fences, "minima": minima, "least": least}
    files.write_note(spark, layout.ledger(f"{STAR}.json"), note)
    return dates


def update_labels(spark: SparkSession, config: RunConfig) -> list[date]:
    """Write the labels of those snapshots whose loans changed."""
    layout, path = config.layout, config.layout.gold(LABELS)
    note = files.read_note(spark, layout.ledger(f"{LABELS}.json")) or {"options": None, "seen": {}}
    stated = [config.dpd_threshold, config.mob_threshold]
    usable = note["options"] == stated and published.is_published(spark, path)
    known = {date.fromisoformat(d): Seen(t) for d, t in note["seen"].items()} if usable else {}
    found = delta(published.partition_tokens(spark, layout.mart("fact_loan")), known)
    if found.touched or not usable:
        loans = files.slice_snapshots(published.read(spark, layout.mart("fact_loan")), found.changed)
        labels = gold.label_store(loans, *stated)
        published.publish(labels, path, replaces=found.touched if usable else None, clustered=True)
    seen = {d.isoformat(): s.token for d, s in found.seen.items()}
    files.write_note(spark, layout.ledger(f"{LABELS}.json"), {"options": stated, "seen": seen})
    return found.touched


def advance(spark: SparkSession, config: RunConfig, keep_parameters: bool = False) -> Written:
    """Bring all layers up to date with the delivered CSV files; returns the snapshots written,
    by table.

    Snapshots that bronze holds are not looked for in the CSV again, unless ``config.reload``
    asks for it; then those with other rows are taken through all layers, and those that are
    no longer delivered go from all. The result is what a whole run over the same files gives,
    but for fences from sketches in place of the quantiles' narrowing ranges; with
    ``keep_parameters``, fences and the least balance are those of the first run.
    """
    with loading(spark):
        return _advance(spark, config, keep_parameters)


def _advance(spark: SparkSession, config: RunConfig, keep_parameters: bool) -> Written:
    layout, written = config.layout, {}
    dates = snapshot_dates(spark, config.start, config.end)
    delivered = [n for n in files.list_csv_sources(spark, layout.raw) if n in SOURCES]

    def load(name: str) -> None:
        if touched := load_source(spark, config, name, dates)[0]:
            written[SOURCES[name].cleaned_name] = touched

    failures = _attempt(spark, delivered, load)
    failures |= {n: FileNotFoundError(layout.csv(n)) for n in SOURCES if n not in delivered}
    if any(not files.table_exists(spark, layout.cleaned(SOURCES[name])) for name in failures):
        raise RunFailed("silver", failures)
    written |= update_mart(spark, layout)
    for table, touched in ((STAR, update_star(spark, config, keep_parameters)), (LABELS, update_labels(spark, config))):
        if touched:
            written[table] = touched
    if failures:
        raise RunFailed("silver", failures)
    return written
