"""Runs that take in what changed, against whole runs."""

from __future__ import annotations

import shutil
from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lendstrata.operators import sketches
from lendstrata.operators.contracts import ContractError
from lendstrata.operators.digests import Seen, delta, digest_states, snapshot_digests
from lendstrata.plans import gold, increments, medallion
from lendstrata.plans.cleaners import SOURCES
from lendstrata.sources import files, published
from lendstrata.workload import inputs
from lendstrata.workload.queries import write_raw_csv

SMALL = "/root/testdata/sf0.001"
START, CUT, END = date(2005, 1, 1), date(2005, 6, 1), date(2005, 7, 1)
EXACT = gold.StarOptions(relative_error=0)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def deliver(spark, layout, last, change=None):
    """The four sources up to a month, as CSV; ages."""
    later = F.add_months("snapshot_date", 120)
    sources = {
        "lms_loan_daily": inputs.raw_loans(spark, SMALL).withColumn("snapshot_date", later),
        "features_financials": inputs.raw_financials(spark, SMALL).withColumn("snapshot_date", later),
        "features_attributes": inputs.raw_attributes(spark, SMALL).withColumns(
            {"snapshot_date": later, "Age": F.regexp_replace("Age", "_", "")}
        ),
        "feature_clickstream": inputs.raw_clickstream(spark, SMALL).withColumn("snapshot_date", F.lit(date(2005, 5, 1))),
    }
    for name, df in sources.items():
        part = df.where(F.col("snapshot_date").between(START, last))
        write_raw_csv(change(name, part) if change else part, f"{layout.raw}-new/{name}.csv", SOURCES[name])
    Path(layout.raw).exists() and Path(layout.raw).rename(f"{layout.raw}-{len(list(Path(layout.raw).parent.iterdir()))}")
    Path(f"{layout.raw}-new").rename(layout.raw)


def config(layout, last, **more):
    return medallion.RunConfig(layout, START, last, star=EXACT, **more)


def tables(spark, layout):
    paths = {t: layout.mart(t) for t in medallion.MART_TABLES} | {t: layout.gold(t) for t in medallion.GOLD_TABLES}
    return {name: rows(published.read(spark, path)) for name, path in paths.items()}


def tokens(spark, layout, table):
    gold_ = table in (*medallion.GOLD_TABLES, increments.BASE)
    return published.partition_tokens(spark, layout.gold(table) if gold_ else layout.mart(table))


FACTS = ("fact_financials", "fact_loan", "fact_customer_loan_type")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """All layers up to a month."""
    folder = tmp_path_factory.mktemp("loaded")
    layout = medallion.Layout(f"{folder}/raw", f"{folder}/lake")
    deliver(spark, layout, CUT)
    increments.advance(spark, config(layout, CUT))
    return layout


@pytest.fixture
def layout(loaded, folder):
    """A copy of them for each test."""
    for name in ("raw", "lake"):
        shutil.copytree(getattr(loaded, name), f"{folder}/{name}")
    return medallion.Layout(f"{folder}/raw", f"{folder}/lake")


def whole_run(spark, layout, last, **more):
    other = medallion.Layout(layout.raw, f"{layout.lake}-whole-{len(list(Path(layout.lake).parent.iterdir()))}")
    medallion.run(spark, config(other, last, **more))
    return tables(spark, other)


def test_a_new_month_equals_a_whole_run(spark, layout):
    assert tables(spark, layout) == whole_run(spark, layout, CUT)
    before = {t: tokens(spark, layout, t) for t in (*FACTS, "fact_clickstream", "label_store")}

    deliver(spark, layout, END)
    written = increments.advance(spark, config(layout, END))
    assert tables(spark, layout) == whole_run(spark, layout, END)
    for name in FACTS:
        assert written[name] == [END]
        assert {d: t for d, t in tokens(spark, layout, name).items() if d != END} == before[name]
    assert "fact_clickstream" not in written and tokens(spark, layout, "fact_clickstream") == before["fact_clickstream"]
    assert written["label_store"] == [END]

    assert increments.advance(spark, config(layout, END)) == {}


def test_kept_parameters_write_the_new_month_of_the_star_only(spark, layout):
    star, customers = tokens(spark, layout, "loan_analytics_star"), published.token(spark, layout.mart("dim_customer"))
    deliver(spark, layout, END)
    written = increments.advance(spark, config(layout, END), keep_parameters=True)
    base = published.read(spark, layout.gold(increments.BASE))
    if published.token(spark, layout.mart("dim_customer")) == customers:
        assert written["loan_analytics_star"] == [END]
    for day in set(star) - set(written["loan_analytics_star"]):
        assert tokens(spark, layout, "loan_analytics_star")[day] == star[day]
    note = files.read_note(spark, layout.ledger("loan_analytics_star.json"))
    fences = {c: tuple(f) for c, f in note["fences"].items()}
    want = gold.star_features(base, EXACT, fences, note["least"])
    assert rows(published.read(spark, layout.gold("loan_analytics_star"))) == rows(want)


def test_changed_customers_reach_old_months_of_the_star(spark, layout):

    def renamed(name, df):
        if name != "features_attributes":
            return df
        return df.withColumn("Name", F.when(F.col("snapshot_date") == F.lit(END), F.lit("Another")).otherwise(F.col("Name")))

    deliver(spark, layout, END, renamed)
    written = increments.advance(spark, config(layout, END))
    assert tables(spark, layout) == whole_run(spark, layout, END)
    assert len(written["loan_analytics_star"]) > 1 and written["dim_customer"] == []


@pytest.mark.parametrize("few", [0, 250_000])
def test_only_rows_of_changed_customers_are_joined_again(spark, layout, monkeypatch, few):
    seen, star_base = [], gold.star_base

    def noted(tables, grain):
        seen.append({name: tables[name] for name in FACTS})
        return star_base(tables, grain)

    def renamed(name, df):
        if name != "features_attributes":
            return df
        return df.withColumn("Name", F.when(F.col("snapshot_date") == F.lit(END), F.lit("Another")).otherwise(F.col("Name")))

    deliver(spark, layout, END, renamed)
    monkeypatch.setattr(increments, "FEW_CUSTOMERS", few)
    monkeypatch.setattr(gold, "star_base", noted)
    before = rows(published.read(spark, layout.mart("dim_customer")))
    increments.advance(spark, config(layout, END))
    changed = {r[0] for r in rows(published.read(spark, layout.mart("dim_customer"))) - before}
    assert len(seen) == 1 and changed
    every = {name: published.read(spark, layout.mart(name)) for name in FACTS}
    for name in FACTS:
        want = every[name].where((F.col("snapshot_date") == END) | F.col("customer_id").isin(list(changed))).select(*gold.BY_SNAPSHOT)
        got = seen[0][name].select(*gold.BY_SNAPSHOT)
        assert rows(got) == rows(want) and got.count() < every[name].count(), name
    monkeypatch.setattr(gold, "star_base", star_base)
    assert tables(spark, layout) == whole_run(spark, layout, END)


def test_reload_takes_in_what_differs(spark, layout):
    star = tokens(spark, layout, "loan_analytics_star")
    assert increments.advance(spark, config(layout, CUT, reload=True)) == {}
    assert tokens(spark, layout, "loan_analytics_star") == star

    changed, gone = date(2005, 3, 1), date(2005, 4, 1)

    def change(name, df):
        if name == "features_financials":
            rate = F.when(F.col("snapshot_date") == F.lit(changed), F.col("Interest_Rate") + 1).otherwise(F.col("Interest_Rate"))
            return df.withColumn("Interest_Rate", rate)
        return df.where(F.col("snapshot_date") != F.lit(gone)) if name == "features_attributes" else df

    deliver(spark, layout, CUT, change)
    written = increments.advance(spark, config(layout, CUT, reload=True))
    assert written["fact_financials"] == [changed] and written["features_attributes_cleaned"] == [gone]
    assert "fact_loan" not in written
    assert tables(spark, layout) == whole_run(spark, layout, CUT)


def test_a_run_that_dies_is_run_again(spark, layout, monkeypatch):
    deliver(spark, layout, END)

    def dies(*args, **kwargs):
        raise RuntimeError("killed")

    for module, name in ((increments, "load_cleaned"), (gold, "star_base"), (gold, "star_features"), (increments, "update_labels")):
        with monkeypatch.context() as m:
            m.setattr(module, name, dies)
            with pytest.raises((RuntimeError, medallion.RunFailed)):
                increments.advance(spark, config(layout, END))
    increments.advance(spark, config(layout, END))
    assert tables(spark, layout) == whole_run(spark, layout, END)


def test_sketched_fences_are_close(spark, layout):
    exact = config(layout, CUT)
    rough = medallion.RunConfig(layout, START, CUT)
    base = published.read(spark, layout.gold(increments.BASE))
    total = base.agg(F.sum("_copies")).first()[0]
    columns = list(EXACT.outlier_columns)
    found = sketches.sketch_quantiles(published.read(spark, layout.gold("star_sketches")), columns, [0.25, 0.75]).first()
    for c in columns:
        for p, value in zip((0.25, 0.75), found[c]):
            below, upto = base.agg(
                F.coalesce(F.sum(F.when(F.col(c) < value, F.col("_copies"))), F.lit(0)), F.sum(F.when(F.col(c) <= value, F.col("_copies")))
            ).first()
            assert below <= (p + 0.01) * total and upto >= (p - 0.01) * total
    assert increments.star_fences(spark, rough).keys() == increments.star_fences(spark, exact).keys()
    assert increments.advance(spark, rough)["loan_analytics_star"]


# digests


def test_digests_tell_rows_and_copies_but_no_order(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (1, "a", None), (2, "a", "b"), (2, "a", "b"), (3, None, None)], "snapshot_date int, p string, q string"
    )
    first = {r[0]: r.digest for r in snapshot_digests(df).collect()}
    again = snapshot_digests(df.select("q", "snapshot_date", "p").repartition(5))
    assert {r[0]: r.digest for r in again.collect()} == first
    swapped = df.select("snapshot_date", F.col("q").alias("p"), F.col("p").alias("q"))
    other = {r[0]: r.digest for r in snapshot_digests(swapped).collect()}
    assert other[1] != first[1] and other[2] != first[2] and other[3] == first[3]
    once = {r[0]: r.digest for r in snapshot_digests(df.distinct()).collect()}
    assert once[2] != first[2] and once[1] == first[1]
    assert {r[0]: r.digest for r in snapshot_digests(df, ignore=["q"]).collect()}.keys() == {1, 2, 3}
    states = digest_states(snapshot_digests(df.where("snapshot_date < 3")), snapshot_digests(df.distinct().where("snapshot_date > 1")))
    assert dict(map(tuple, states.collect())) == {1: "new", 2: "changed", 3: "gone"}


def test_delta_reads_what_was_written_only():
    jan, feb, mar = date(2023, 1, 1), date(2023, 2, 1), date(2023, 3, 1)
    asked = []

    def taken(dates):
        asked.extend(dates)
        return {d: f"rows of {d}" for d in dates}

    found = delta({jan: "a", feb: "b"}, {}, taken)
    assert found.changed == [jan, feb] and found.seen[jan] == Seen("a", f"rows of {jan}")
    asked.clear()
    found = delta({jan: "a", feb: "c", mar: "d"}, found.seen, taken)
    assert (found.changed, found.gone, asked) == ([mar], [], [feb, mar])
    found = delta({mar: "e"}, found.seen)
    assert (found.changed, found.gone, found.touched) == ([mar], [jan, feb], [jan, feb, mar])
    assert found.seen == {mar: Seen("e")}


# published tables


def days(spark, n):
    return spark.range(20).select("id", F.date_add(F.lit(date(2023, 1, 1)), (F.col("id") % n).cast("int")).alias("snapshot_date"))


def test_a_write_that_dies_leaves_the_old_table(spark, folder, monkeypatch):
    path, jan1 = f"{folder}/t", date(2023, 1, 1)
    with pytest.raises(FileNotFoundError):
        published.read(spark, path)
    published.publish(days(spark, 2), path)
    before = rows(published.read(spark, path))

    def dies(*args):
        raise RuntimeError("killed between commit and switch")

    with monkeypatch.context() as m:
        m.setattr(files, "write_note", dies)
        with pytest.raises(RuntimeError):
            published.publish(days(spark, 3).where("id > 9"), path)
    assert rows(published.read(spark, path)) == before and len(files.subfolders(spark, path, "v=*")) == 2

    def refuses(df):
        assert df.count() == 0, "rows that may not be"

    with pytest.raises(AssertionError):
        published.publish(days(spark, 3), path, check=refuses)
    assert rows(published.read(spark, path)) == before
    published.publish(days(spark, 1).where("id < 3"), path, replaces=[jan1], clustered=True)
    assert published.read(spark, path).where(F.col("snapshot_date") == F.lit(jan1)).count() == 3
    assert len(files.subfolders(spark, path, "v=*")) == 2  # the dead writes are swept


def test_readers_of_the_version_before_can_end(spark, folder):
    path = f"{folder}/t"
    published.publish(days(spark, 2), path)
    begun = published.read(spark, path)
    published.publish(days(spark, 1), path)
    assert begun.count() == 20
    published.publish(days(spark, 1), path)
    assert len(files.subfolders(spark, path, "v=*")) == 2


def test_replaced_snapshots_must_be_named(spark, folder):
    path, jan1, jan2 = f"{folder}/t", date(2023, 1, 1), date(2023, 1, 2)
    published.publish(days(spark, 2), path)
    kept = published.partition_tokens(spark, path)[jan2]
    with pytest.raises(ContractError, match="2023-01-02"):
        published.publish(days(spark, 2), path, replaces=[jan1])
    published.publish(days(spark, 2).where("id < 0"), path, replaces=[jan1])
    assert published.partition_tokens(spark, path) == {jan2: kept}
    assert published.read(spark, path).columns == ["id", "snapshot_date"]
    published.publish(days(spark, 2).where("id < 0"), path)
    assert published.read(spark, path).collect() == []
    published.publish(spark.range(3), f"{folder}/whole", partitioned=False)
    version = published.token(spark, f"{folder}/whole")
    assert published.read_folder(spark, f"{folder}/whole", version).count() == 3
    assert published.read_folder(spark, f"{folder}/whole", "v=rnone") is None


# sketches


@pytest.mark.parametrize("weight", [None, "w"])
def test_sketches_of_any_parts_give_close_quantiles(spark, weight):
    made = spark.range(60_000).select(
        (F.col("id") % 13).alias("part"), (F.col("id") % 6).alias("w"), F.pow(F.col("id") % 997, F.lit(3.0)).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(-F.col("id")).alias("b"),
        F.lit(None).cast("double").alias("none"),
    )
    for by in ([], ["part"]):
        kept = sketches.quantile_sketches(made, ["a", "b", "none"], by, weight)
        found = sketches.sketch_quantiles(kept, ["a", "b", "none"], [0.0, 0.25, 0.5, 1.0]).first()
        assert found.none == [None] * 4
        for c in ("a", "b"):
            values = made.where(~F.isnan(c)).withColumn("n", F.lit(1) if weight is None else F.col(weight))
            total = values.agg(F.sum("n")).first()[0]
            for p, value in zip((0.0, 0.25, 0.5, 1.0), found[c]):
                below = values.where(F.col(c) < value).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
                upto = values.where(F.col(c) <= value).agg(F.sum("n")).first()[0]
                assert below <= (p + 0.01) * total and upto >= (p - 0.01) * total
