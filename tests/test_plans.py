"""Mart and gold on invented rows, and the whole run on invented CSV files."""

from __future__ import annotations

import subprocess
import sys
from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lendstrata.operators.contracts import ContractError
from lendstrata.plans import cleaners, gold, mart, medallion
from lendstrata.plans.cleaners import SOURCES
from lendstrata.sources import bucketed, feature_store, files, published, specs, staging
from lendstrata.sources.staging import staging_path
from lendstrata.streaming.refresh import refresh_cleaned
from lendstrata.workload import inputs, queries as workload
from lendstrata.workload.queries import write_raw_csv

SMALL = "/root/testdata/sf0.001"
RUN = {"start": date(2000, 1, 1), "end": date(2001, 12, 1)}


def rows(df):
    return Counter(tuple(r) for r in df.collect())


# mart


def test_fact_loan(spark):
    loans = spark.createDataFrame(
        [("a", "c", date(2023, 1, 1), 10, 6, 1.0, 100.0, 0.0, 250.0, 1.0, "f", date(2023, 7, 1))],
        specs.CLEAN_LOANS,
    )
    fact = mart.fact_loan(loans)
    assert fact.columns == [
        "loan_id", "customer_id", "mob", "installments_missed", "first_missed_date", "dpd", "snapshot_date",
        "loan_start_date", "tenure", "loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance",
    ]
    r = fact.first()
    assert (r.mob, r.installments_missed, r.first_missed_date, r.dpd) == (6, 3, date(2023, 4, 1), 91)


def test_label_store(spark):
    loans = spark.createDataFrame(
        [("a", 6, 30), ("b", 6, 29), ("c", 6, None), ("d", 5, 91)], "loan_id string, mob int, dpd int"
    ).select("*", F.lit("x").alias("customer_id"), F.lit(date(2023, 7, 1)).alias("snapshot_date"))
    got = gold.label_store(loans, 30, 6)
    assert {r.loan_id: r.label for r in got.collect()} == {"a": 1, "b": 0, "c": 0}
    assert got.first().label_def == "30dpd_6mob"
    assert {r.loan_id: r.label for r in gold.label_store(loans, 30, 6, null_dpd_label=1).collect()}["c"] == 1


def small_mart(spark):
    """One loan, one financial row, three loan types and two rows of the customer."""
    day = date(2023, 7, 1)
    clean = {f.name: 1.0 if f.dataType.simpleString() == "float" else 1 for f in specs.CLEAN_FINANCIALS}
    clean |= {"Customer_ID": "c", "Payment_Behaviour": "High_spent_Small_value_payments",
              "_metadata_file_name": "f", "snapshot_date": day}
    clean |= {flag: int(i < 3) for i, flag in enumerate(specs.LOAN_FLAGS)}
    financials = spark.createDataFrame([tuple(clean[n] for n in specs.CLEAN_FINANCIALS.names)], specs.CLEAN_FINANCIALS)
    loans = spark.createDataFrame(
        [("l", "c", day, 10, 6, 1.0, 100.0, 0.0, 250.0, 1.0, "f", day)], specs.CLEAN_LOANS
    )
    attributes = spark.createDataFrame(
        [("c", "n", age, "123-45-6789", "employed", "f", day) for age in (30, 31)], specs.CLEAN_ATTRIBUTES
    )
    clicks = spark.createDataFrame([(*range(1, 21), "c", "f", day)], specs.CLEAN_CLICKSTREAM)
    return mart.build_mart(mart.CleanedTables(loans, attributes, clicks, financials))


def test_mart_tables(spark):
    tables = small_mart(spark)
    assert set(tables) == set(medallion.MART_TABLES)
    assert {n: t.count() for n, t in tables.items()} == {
        "dim_snapshot": 1, "dim_customer": 2, "dim_feature": 20, "dim_credit_mix": 1,
        "dim_payment_behaviour": 1, "dim_min_payment": 1, "dim_loan_type": 8, "fact_clickstream": 20,
        "fact_financials": 1, "fact_loan": 1, "fact_customer_loan_type": 3,
    }
    assert [(r.feature_id, r.value) for r in tables["fact_clickstream"].orderBy("feature_id").collect()] == [
        (i, i) for i in range(1, 21)
    ]
    assert tables["dim_loan_type"].orderBy("loan_type_id").first() == (
        1, "Has_Credit-Builder_Loan", "Credit-Builder_Loan",
    )
    assert tables["dim_payment_behaviour"].first()[1:] == ("High", "Small")


def test_star_multiplicity(spark):
    tables = small_mart(spark)
    options = gold.StarOptions(relative_error=0)
    star = gold.build_star(tables, options)
    assert star.columns == gold.STAR_COLUMNS
    assert star.count() == gold.star_rows(tables).count() == 6
    by_loan = gold.build_star(tables, gold.StarOptions(grain="loan", relative_error=0))
    assert rows(by_loan.select("loan_id", "Age")) == Counter([("l", 30), ("l", 31)])
    assert {r.Is_Employed for r in star.collect()} == {1}


def test_star_equals_features_of_all_joined_rows(spark):
    """The weighted base gives what joining and repeating before filtering gives."""
    tables = workload.mart_tables(spark, SMALL)
    options = gold.StarOptions(relative_error=0)
    all_rows = gold.star_rows(tables).withColumn("_copies", F.lit(1).cast("long"))
    want = gold.star_features(all_rows, options)
    assert rows(gold.build_star(tables, options)) == rows(want)


def test_star_with_a_hot_customer(spark):
    """Every third financial row belongs to one customer and month."""
    tables = dict(workload.mart_tables(spark, SMALL))
    hot = tables["fact_loan"].select("customer_id", "snapshot_date").first()
    one = tables["fact_financials"].limit(1).withColumns(
        {"customer_id": F.lit(hot.customer_id), "snapshot_date": F.lit(hot.snapshot_date)}
    )
    n = tables["fact_financials"].count() // 2
    copies = one.crossJoin(spark.range(n)).drop("id")
    tables["fact_financials"] = tables["fact_financials"].unionByName(copies)
    options = gold.StarOptions(relative_error=0)
    for grain in ("loan_type", "loan"):
        base = gold.star_base(tables, grain)
        plain = tables["fact_loan"].join(gold.with_monthly_balance(tables["fact_financials"]), gold.BY_SNAPSHOT)
        if grain == "loan_type":
            plain = plain.join(tables["fact_customer_loan_type"], gold.BY_SNAPSHOT, "left")
        plain = plain.join(tables["dim_customer"].select("customer_id", "Age", "Name", "Occupation"), "customer_id")
        assert base.agg(F.sum("_copies")).first()[0] == plain.count()
    assert gold.build_star(tables, options).count() > 0


def test_bucketed_facts_join_without_a_shuffle(spark):
    tables = workload.bucketed_mart(spark, SMALL)
    facts = [tables[n] for n in ("fact_financials", "fact_loan", "fact_customer_loan_type")]
    joined = gold.fact_joins(*facts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        whole = gold.star_base_bucketed(tables)
        want = gold.star_base(workload.mart_tables(spark, SMALL))
        assert rows(whole.select(*want.columns)) == rows(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = bucketed.bucket_rows(facts[0], gold.BY_SNAPSHOT, workload.BUCKETS)
    assert found.agg(F.sum("row_count")).first()[0] == facts[0].count() and found.where("skewed").count() == 0


def test_skewed_buckets_are_shown(spark, folder):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"))
    table = bucketed.write_bucketed(df, "skewed_buckets", f"{folder}/t", ["k"], 32)
    (found,) = bucketed.bucket_rows(table, ["k"], 32).where("skewed").collect()
    hot = table.where("k = 7").select(F.input_file_name()).distinct().collect()
    assert found.row_count > 1300 and len(hot) == 1 and f"_{found.bucket:05d}" in hot[0][0]
    spark.sql("DROP TABLE skewed_buckets")


# the whole run


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    """The four sources as CSV; clickstream is moved to the first of a month of the run."""
    raw = str(tmp_path_factory.mktemp("raw"))
    clicks = inputs.raw_clickstream(spark, SMALL).withColumn("snapshot_date", F.lit(date(2000, 5, 1)))
    for name, df in {
        "lms_loan_daily": inputs.raw_loans(spark, SMALL),
        "features_financials": inputs.raw_financials(spark, SMALL),
        "features_attributes": inputs.raw_attributes(spark, SMALL),
        "feature_clickstream": clicks,
    }.items():
        write_raw_csv(df, f"{raw}/{name}.csv", SOURCES[name])
    return raw


def fingerprints(spark, layout):
    tables = {t: layout.mart(t) for t in medallion.MART_TABLES} | {t: layout.gold(t) for t in medallion.GOLD_TABLES}
    return {name: rows(published.read(spark, path)) for name, path in tables.items()}


def test_whole_run(spark, delivered, folder):
    layout = medallion.Layout(delivered, folder)
    config = medallion.RunConfig(layout, **RUN)
    audits = medallion.run(spark, config)
    assert set(audits) == set(SOURCES)
    raw = inputs.raw_financials(spark, SMALL).filter(F.col("snapshot_date") >= RUN["start"])
    assert audits["features_financials"]["rows"] == raw.count()
    assert audits["features_financials"]["null_Payment_of_Min_Amount"] > 0
    first = fingerprints(spark, layout)
    assert all(first.values())

    bronze = medallion.read_bronze(spark, layout.bronze("features_financials"), SOURCES["features_financials"])
    assert bronze.schema == specs.RAW_FINANCIALS
    assert all("features_financials.csv" in r[0] for r in bronze.select(specs.LINEAGE).distinct().collect())
    direct = cleaners.clean_snapshots(raw, SOURCES["features_financials"]).drop(specs.LINEAGE)
    assert rows(medallion.read_cleaned(spark, layout).financials.drop(specs.LINEAGE)) == rows(direct)

    again = medallion.run(spark, config)
    assert again == {name: {} for name in SOURCES}
    second = fingerprints(spark, layout)
    star = "loan_analytics_star"
    assert {n: r for n, r in second.items() if n != star} == {n: r for n, r in first.items() if n != star}
    assert medallion.run(spark, medallion.RunConfig(layout, **RUN, reload=True)).keys() == SOURCES.keys()
    assert fingerprints(spark, layout)["fact_loan"] == first["fact_loan"]


def test_missing_and_broken_sources_are_reported(spark, folder):
    layout = medallion.Layout(f"{folder}/raw", f"{folder}/lake")
    assert files.list_csv_sources(spark, layout.raw) == []
    with pytest.raises(medallion.RunFailed) as e:
        medallion.run(spark, medallion.RunConfig(layout, **RUN))
    assert set(e.value.failures) == set(SOURCES)
    spark.range(1).write.csv(layout.csv("lms_loan_daily"), header=True)
    with pytest.raises(medallion.RunFailed) as e:
        medallion.run(spark, medallion.RunConfig(layout, **RUN))
    assert "unexpected columns ['id']" in str(e.value.failures["lms_loan_daily"])
    Path(layout.csv("features_attributes")).write_text(raw_attribute_lines("1", "2").replace("2023", "2000"))
    Path(layout.csv("features_attribute")).write_text(raw_attribute_lines("3"))
    with pytest.raises(medallion.RunFailed) as e:
        medallion.run(spark, medallion.RunConfig(layout, **RUN))
    assert set(e.value.failures) == {*SOURCES, "features_attribute"} - {"features_attributes"}
    assert files.table_exists(spark, layout.cleaned(SOURCES["features_attributes"]))


# sources and snapshots


def test_staged_table_goes_with_its_block(spark):
    with staging.staged(spark.range(5), "trial") as table:
        (part,) = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        assert table.count() == 5 and files.table_exists(spark, part)
    assert not files.table_exists(spark, part)


def test_staging_folder_is_empty_when_the_application_has_ended(folder):
    script = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", "{folder}").getOrCreate()
from lendstrata.workload.queries import queries
for name in ("star_as_of", "profile_drift"):
    assert queries()[name](spark, "{SMALL}").count() > 0
import os
assert os.listdir("{folder}")
"""
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", script], cwd=root, check=True, capture_output=True, timeout=200)
    # Spark itself makes an empty folder there
    assert [p for p in Path(folder).glob("*/*")] == []


def test_csv_files_are_sources(spark, folder):
    for name in ("b", "a"):
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write("x\n1\n")
    spark.range(1).write.csv(f"{folder}/c.csv", header=True)
    assert files.list_csv_sources(spark, folder) == ["a", "b", "c"]
    assert files.infer_schema(spark, f"{folder}/a.csv").simpleString() == "struct<x:int>"


def test_column_order_of_a_csv_does_not_matter(spark, folder):
    with open(f"{folder}/features_attributes.csv", "w") as f:
        f.write("snapshot_date,SSN,Age,Name,Customer_ID,Occupation\n")
        f.write("2023-01-01,123-45-6789,23_,n, CUS_1,employed\nbad,1,2,3,4,5\n")
    spec = SOURCES["features_attributes"]
    got = files.read_snapshots(spark, f"{folder}/features_attributes.csv", spec)
    assert got.schema.names == spec.raw.names
    assert [(r.Customer_ID, r.Age, r.snapshot_date) for r in got.collect()] == [(" CUS_1", "23_", date(2023, 1, 1))]


def test_reloading_one_snapshot_leaves_the_others(spark, folder):
    def batch(day, value):
        return spark.createDataFrame([(value, day)], "x int, snapshot_date date")

    jan, feb = date(2023, 1, 1), date(2023, 2, 1)
    files.write_snapshots(batch(jan, 1).unionByName(batch(feb, 2)), f"{folder}/t")
    files.write_snapshots(batch(feb, 3), f"{folder}/t")
    files.write_snapshots(batch(feb, 3), f"{folder}/t")
    assert rows(spark.read.parquet(f"{folder}/t")) == Counter([(1, jan), (3, feb)])
    assert {r[0] for r in files.stored_snapshots(spark, f"{folder}/t").collect()} == {jan, feb}
    assert files.stored_snapshots(spark, f"{folder}/nothing").collect() == []


def test_slices_of_one_pass_equal_passes_per_date(spark):
    months = workload.orders_by_month(spark, SMALL)
    dates = [r[0] for r in months.select("snapshot_date").distinct().limit(5).collect()]
    one_by_one = sum((rows(files.slice_snapshots(months, [d])) for d in dates), Counter())
    assert rows(files.slice_snapshots(months, dates)) == one_by_one


def test_partition_filter_on_stored_snapshots(spark, folder):
    files.write_snapshots(workload.orders_by_month(spark, SMALL), f"{folder}/t")
    sliced = files.slice_snapshots(files.read_table(spark, f"{folder}/t"), [date(1996, 1, 1)])
    assert "PartitionFilters: [isnotnull(snapshot_date" in sliced._jdf.queryExecution().toString()


def test_feature_store(spark, folder):
    for day, value in ((date(2023, 1, 1), 1), (date(2023, 2, 1), 2), (date(2023, 2, 1), 3)):
        feature_store.write_features(spark.createDataFrame([(value,)], "x int"), f"{folder}/fs", day)
    assert [r.x for r in feature_store.read_features(spark, f"{folder}/fs", date(2023, 2, 1)).collect()] == [3]


def test_stream_takes_in_only_new_snapshots(spark, folder):
    spec = SOURCES["features_attributes"]
    raw = inputs.raw_attributes(spark, SMALL)
    early = raw.filter(F.col("snapshot_date") < "1998-01-01")
    paths = (f"{folder}/bronze", f"{folder}/silver", f"{folder}/progress")
    for arrived in (early, raw.exceptAll(early)):
        files.write_snapshots(arrived, paths[0], [specs.LOAD_DATE, specs.SNAPSHOT])
        refresh_cleaned(spark, *paths, spec).awaitTermination()
    want = rows(cleaners.clean_snapshots(raw, spec))
    assert rows(files.read_table(spark, paths[1], spec.cleaned)) == want


@pytest.mark.parametrize("source", list(SOURCES))
def test_cleaners_do_not_depend_on_ansi_mode(spark, source):
    raw = {
        "lms_loan_daily": inputs.raw_loans,
        "features_financials": inputs.raw_financials,
        "features_attributes": inputs.raw_attributes,
        "feature_clickstream": inputs.raw_clickstream,
    }[source](spark, SMALL)
    got = []
    for mode in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", mode)
        got.append(rows(cleaners.clean_snapshots(raw, SOURCES[source])))
    spark.conf.unset("spark.sql.ansi.enabled")
    assert got[0] == got[1] and got[0]


def raw_attribute_lines(*names: str) -> str:
    return "Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n" + "".join(
        f"CUS_{n},Ann,{n},111-22-3333,work,2023-01-01\n" for n in names
    )


def test_csv_with_an_unknown_column_is_refused(spark, folder):
    Path(folder, "x.csv").write_text("Customer_ID,Shoe,snapshot_date\nC,44,2023-01-01\n")
    with pytest.raises(ContractError, match="Shoe"):
        files.read_csv(spark, f"{folder}/x.csv", SOURCES["features_attributes"].raw)


def test_part_file_with_another_column_order_is_refused(spark, folder):
    Path(folder, "x.csv").mkdir()
    Path(folder, "x.csv/a.csv").write_text(raw_attribute_lines("1"))
    Path(folder, "x.csv/b.csv").write_text("Customer_ID,Age,Name,SSN,Occupation,snapshot_date\nC,3,Bob,1,w,2023-01-01\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        files.read_csv(spark, f"{folder}/x.csv", SOURCES["features_attributes"].raw).collect()


def test_value_that_does_not_fit_its_type_is_refused(spark, folder):
    Path(folder, "x.csv").write_text("loan_id,tenure,snapshot_date\nL,12,2023-01-01\nM,10_,2023-01-01\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, f"{folder}/x.csv", SOURCES["lms_loan_daily"].raw).collect()


def test_snapshots_are_replaced_by_nothing(spark, folder):
    jan, feb, mar = date(2023, 1, 1), date(2023, 2, 1), date(2023, 3, 1)
    table = spark.createDataFrame([(1, jan), (2, feb), (3, mar)], "x int, snapshot_date date")
    files.write_snapshots(table, f"{folder}/t")
    files.write_snapshots(table.filter("x = 2"), f"{folder}/t", stands_for=[jan, feb])
    assert rows(spark.read.parquet(f"{folder}/t")) == Counter([(2, feb), (3, mar)])
    files.write_snapshots(table.filter("x = 0"), f"{folder}/t", stands_for=[feb])
    assert [r[0] for r in files.stored_snapshots(spark, f"{folder}/t").collect()] == [mar]


def test_folder_for_intermediate_tables_must_be_named(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging_path(spark, "x")
