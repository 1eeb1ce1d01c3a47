"""The operators over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import FractionalType, StructType

from lendstrata.functions import dates, numeric, text
from lendstrata.operators import cleaning, contracts, digests, features, incremental, profile, quantiles, sketches
from lendstrata.plans import cleaners, gold, increments, mart, medallion
from lendstrata.plans.cleaners import SOURCES, clean_snapshots
from lendstrata.session import loading
from lendstrata.sources import bucketed, feature_store, files, inference, published, specs
from lendstrata.sources.specs import LINEAGE, LOAD_DATE, SNAPSHOT, SourceSpec
from lendstrata.sources.staging import stage, stage_all, staging_path
from lendstrata.streaming.refresh import refresh_cleaned
from lendstrata.workload import inputs
from lendstrata.workload.inputs import table

Query = Callable[[SparkSession, str], DataFrame]

FINANCIALS = SOURCES["features_financials"]
ATTRIBUTES = SOURCES["features_attributes"]


# derived layers


def loans(spark: SparkSession, d: str, snapshot: str = inputs.SHIP_MONTH) -> DataFrame:
    return clean_snapshots(inputs.raw_loans(spark, d, snapshot), SOURCES["lms_loan_daily"])


def financials(spark: SparkSession, d: str) -> DataFrame:
    return clean_snapshots(inputs.raw_financials(spark, d), FINANCIALS)


def attributes(spark: SparkSession, d: str) -> DataFrame:
    return clean_snapshots(inputs.raw_attributes(spark, d), ATTRIBUTES)


def clickstream(spark: SparkSession, d: str) -> DataFrame:
    return clean_snapshots(inputs.raw_clickstream(spark, d), SOURCES["feature_clickstream"])


def mart_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The mart over cleaned tables; those that are read repeatedly are stored first."""
    with loading(spark):
        stored = stage_all(
            loans=loans(spark, d), financials=financials(spark, d), attributes=attributes(spark, d)
        )
    return mart.build_mart(mart.CleanedTables(clickstream=clickstream(spark, d), **stored))


def priced_orders(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")


def orders_by_month(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").withColumn(SNAPSHOT, dates.first_of_month(F.col("o_orderdate")))


# sources and snapshots


def month_spine(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    bounds = table(spark, d, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return dates.month_spine(bounds, "first", "last")


ROWS_PER_CSV = 500_000


def write_raw_csv(raw: DataFrame, path: str, spec: SourceSpec) -> None:
    """A raw source as its producer would deliver it: CSV with header and dates as text, zipped
    in part files of bounded size, as each is read by one task."""
    delivered = raw.drop(LINEAGE, LOAD_DATE).withColumn(SNAPSHOT, F.date_format(SNAPSHOT, spec.snapshot_format))
    zipped = delivered.write.options(**{"zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": ROWS_PER_CSV})
    zipped.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip")


def write_side_by_side(spark: SparkSession, sources: dict[str, DataFrame], folder: str) -> None:
    """Deliver independent sources at once, so that small ones do not leave the cluster idle."""

    def write(name: str) -> None:
        write_raw_csv(sources[name], f"{folder}/{name}.csv", SOURCES[name])

    with ThreadPoolExecutor(len(sources)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), sources))


def ingest_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    root = staging_path(spark, "ingest")
    write_raw_csv(inputs.raw_financials(spark, d), f"{root}/raw.csv", FINANCIALS)
    arrived = files.read_snapshots(spark, f"{root}/raw.csv", FINANCIALS)
    files.write_snapshots(arrived, f"{root}/bronze", [LOAD_DATE, SNAPSHOT])
    bronze = medallion.read_bronze(spark, f"{root}/bronze", FINANCIALS)
    return bronze.withColumn(LINEAGE, F.regexp_extract(LINEAGE, r"([^/]+\.csv)/[^/]+$", 1))


FAULTY = {
    "Num_Bank_Accounts": ("Num_Bank_Accounts = 10 and Interest_Rate % 5 = 0", "ten"),
    "Monthly_Inhand_Salary": ("Num_Credit_Inquiries = 16 and Num_Credit_Card = 8", "unknown"),
    SNAPSHOT: ("Delay_from_due_date = 61", "soon"),
}


def ingest_with_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Financials with faulty fields and lines: what bronze holds of each snapshot, and what was
    set aside for which faults."""
    root = staging_path(spark, "rejects")
    raw = inputs.raw_financials(spark, d).drop(LINEAGE, LOAD_DATE)
    texts = {SNAPSHOT: F.date_format(SNAPSHOT, FINANCIALS.snapshot_format)}
    texts |= {c: F.col(c).cast("string") for c in FAULTY if c != SNAPSHOT}
    faulty = {c: F.when(F.expr(when), F.lit(text)).otherwise(texts[c]) for c, (when, text) in FAULTY.items()}
    raw.withColumns(faulty).write.csv(f"{root}/raw.csv", header=True)
    short = spark.createDataFrame([(",".join(raw.columns),), ("CUS_1,three,fields",), ("CUS_2",)], "value string")
    short.coalesce(1).write.mode("append").text(f"{root}/raw.csv")
    paths = (f"{root}/raw.csv", f"{root}/bronze", FINANCIALS)
    days = [r[0] for r in raw.select(SNAPSHOT).distinct().collect()]
    medallion.load_bronze(spark, *paths, [_as_read(day) for day in days], f"{root}/rejects", most_rejects=0.2)
    bronze = medallion.read_bronze(spark, f"{root}/bronze", FINANCIALS).groupBy(SNAPSHOT)
    stored = bronze.agg(F.count(F.lit(1)).alias("row_count"), F.sum("Interest_Rate").alias("rates"))
    aside = published.read(spark, f"{root}/rejects").groupBy(F.concat_ws("; ", "faults").alias("faults"))
    nothing = F.lit(None)
    return stored.select(nothing.cast("string").alias("faults"), SNAPSHOT, "row_count", "rates").union(
        aside.agg(F.count(F.lit(1)).alias("row_count")).select(
            "faults", nothing.cast("date").alias(SNAPSHOT), "row_count", nothing.cast("long").alias("rates")
        )
    )


def _as_read(day: date) -> date:
    """A day after its year was written with two digits, which read as 20yy."""
    return day.replace(year=2000 + day.year % 100)


def inferred_contract(spark: SparkSession, d: str) -> DataFrame:
    """The types found in three sources delivered as CSV."""
    root, found = staging_path(spark, "inferred"), None
    made = {"lms_loan_daily": inputs.raw_loans, "features_financials": inputs.raw_financials, "features_attributes": inputs.raw_attributes}
    write_side_by_side(spark, {name: raw(spark, d) for name, raw in made.items()}, root)
    for name in made:
        types = inference.column_types(spark, f"{root}/{name}.csv").withColumn("source", F.lit(name))
        found = types if found is None else found.union(types)
    return found.select("source", "position", "column_name", "data_type", "date_format", "n_values", "n_nulls")


def list_csv_sources(spark: SparkSession, d: str) -> DataFrame:
    """Rows per delivered source, for all the sources found in a folder."""
    root = staging_path(spark, "raw")
    write_raw_csv(inputs.raw_financials(spark, d), f"{root}/features_financials.csv", FINANCIALS)
    write_raw_csv(inputs.raw_attributes(spark, d), f"{root}/features_attributes.csv", ATTRIBUTES)
    rows = None
    for name in files.list_csv_sources(spark, root):
        counted = files.read_snapshots(spark, f"{root}/{name}.csv", SOURCES[name]).agg(
            F.first(F.lit(name)).alias("source"), F.count(F.lit(1)).alias("row_count")
        )
        rows = counted if rows is None else rows.unionByName(counted)
    return rows


def snapshot_slice(spark: SparkSession, d: str) -> DataFrame:
    months = [date(1996, 1, 1), date(1998, 6, 1)]
    return files.slice_snapshots(
        orders_by_month(spark, d).select("o_orderkey", "o_custkey", "o_totalprice", SNAPSHOT), months
    )


def snapshot_audit(spark: SparkSession, d: str) -> DataFrame:
    typed = contracts.conform(cleaners.clean_financials(inputs.raw_financials(spark, d)), specs.CLEAN_FINANCIALS)
    audited = [
        "Annual_Income",
        "Num_of_Loan",
        "Credit_Mix",
        "Outstanding_Debt",
        "Payment_of_Min_Amount",
        "Credit_History_Years",
    ]
    counts = cleaning.null_counts(typed.select(*audited))
    return typed.groupBy(SNAPSHOT).agg(*counts).withColumnRenamed("rows", "row_count")


def feature_store_snapshot(spark: SparkSession, d: str) -> DataFrame:
    path = staging_path(spark, "feature-store")
    store = (
        orders_by_month(spark, d)
        .groupBy(F.col("o_custkey").alias("customer_key"), SNAPSHOT)
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("largest_order"))
    )
    files.write_snapshots(store, path)
    return feature_store.read_features(spark, path, date(1997, 3, 1))


def feature_store_write(spark: SparkSession, d: str) -> DataFrame:
    """The features of all customers written as one snapshot, over an earlier version of it."""
    path, day = staging_path(spark, "feature-store"), date(2024, 1, 1)
    features_ = table(spark, d, "customer").select(F.col("c_custkey").alias("customer_key"), "c_acctbal")
    for version in (features_.withColumn("c_acctbal", F.lit(0.0)), features_):
        feature_store.write_features(version, path, day)
    return feature_store.read_features(spark, path, day)


def observed_audit(spark: SparkSession, d: str) -> DataFrame:
    """What each column of the financials costs, counted by the job that writes the rest."""
    audit = Observation("audit")
    cleaned = clean_snapshots(inputs.raw_financials(spark, d), FINANCIALS, audit)
    files.write_table(cleaned, staging_path(spark, "audited"))
    return spark.createDataFrame([(k, v) for k, v in audit.get.items()], "figure string, row_count bigint")


def profile_drift(spark: SparkSession, d: str) -> DataFrame:
    """How the orders of each month differ from those of the month before. Shares of the few
    statuses and priorities are exact; of distinct customers it is told whether the estimate is
    within 5 % of their number."""
    columns = ["o_orderstatus", "o_orderpriority", "o_custkey"]
    sparse = F.when(F.col("o_orderkey") % 10 > 0, F.col("o_orderpriority"))
    orders = stage(orders_by_month(spark, d).withColumn("o_orderpriority", sparse).select(SNAPSHOT, *columns), "orders")
    kept = stage(profile.profiles(orders, columns), "profiles")
    exact = orders.groupBy(SNAPSHOT).agg(F.count_distinct("o_custkey").alias("customers"))
    few = F.col("column_name") != "o_custkey"
    close = F.abs(F.col("n_distinct") - F.col("customers")) <= F.greatest(F.lit(1), 0.05 * F.col("customers"))
    return profile.drift(kept).join(exact, SNAPSHOT).select(
        SNAPSHOT,
        "column_name",
        "row_count",
        F.round("null_share", 9).alias("null_share"),
        F.round("null_share_before", 9).alias("null_share_before"),
        F.when(few, F.round("value_shift", 9)).alias("value_shift"),
        F.when(few, F.col("n_distinct")).alias("n_distinct"),
        F.when(~few, close).alias("within_error"),
    )


def row_digests(spark: SparkSession, d: str) -> DataFrame:
    """The digest of each order's key columns."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    return table(spark, d, "orders").select(*columns, incremental.row_digest(columns).alias("digest"))


# contracts and incremental load


def _second_delivery(first: DataFrame) -> DataFrame:
    """One snapshot is gone, one has its rows twice, one other names; all in another order."""
    day = F.col(SNAPSHOT)
    names = F.when(day == F.lit(date(1997, 5, 1)), F.upper("Name")).otherwise(F.col("Name"))
    changed = first.where(day != F.lit(date(1996, 3, 1))).withColumn("Name", names)
    return changed.union(changed.where(day == F.lit(date(1995, 7, 1)))).repartition(5)


def snapshot_digests(spark: SparkSession, d: str) -> DataFrame:
    """What a second delivery of the attributes changed, told by digests of its snapshots."""
    everything = inputs.raw_attributes(spark, d)
    stored = digests.snapshot_digests(everything.where(F.col(SNAPSHOT) != F.lit(date(1998, 1, 1))))
    incoming = digests.snapshot_digests(_second_delivery(everything))
    states = digests.digest_states(incoming, stored)
    return states.join(incoming.select(SNAPSHOT, "row_count"), SNAPSHOT, "left")


def conform_columns(spark: SparkSession, d: str) -> DataFrame:
    contract = StructType.fromDDL("c_custkey bigint, c_mktsegment string, c_name string, c_acctbal double")
    return contracts.assert_schema(contracts.conform(table(spark, d, "customer"), contract), contract)


def _deliveries(spark: SparkSession, d: str, first: str, last: str) -> DataFrame:
    shipped = F.col("l_shipdate")
    return table(spark, d, "lineitem").filter((shipped >= F.to_date(F.lit(first))) & (shipped < F.to_date(F.lit(last))))


BEGINNING, END, CUT = "0001-01-01", "9999-12-31", "1999-01-01"


def row_fingerprint_intersect(spark: SparkSession, d: str) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    fingerprint = incremental.row_text(columns).alias("fingerprint")
    return incremental.common_rows(
        _deliveries(spark, d, "1997-01-01", END).select(fingerprint),
        _deliveries(spark, d, BEGINNING, CUT).select(fingerprint),
    )


def load_state(spark: SparkSession, d: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber"]
    return incremental.load_state(
        table(spark, d, "lineitem").select(*columns), _deliveries(spark, d, BEGINNING, CUT).select(*columns)
    )


def new_rows_anti(spark: SparkSession, d: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_returnflag"]
    return incremental.new_rows(
        table(spark, d, "lineitem").select(*columns), _deliveries(spark, d, BEGINNING, CUT).select(*columns)
    )


def missing_snapshots(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    bounds = table(spark, d, "lineitem").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return incremental.missing_snapshots(
        dates.month_spine(bounds, "first", "last"), orders_by_month(spark, d)
    )


def _bronze_attributes(spark: SparkSession, d: str) -> tuple[str, str]:
    root = staging_path(spark, "load")
    files.write_snapshots(inputs.raw_attributes(spark, d), f"{root}/bronze", [LOAD_DATE, SNAPSHOT])
    return f"{root}/bronze", root


def incremental_load(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots up to a month first, then all of them, then one month once more."""
    bronze, root = _bronze_attributes(spark, d)
    everything = [r[0] for r in files.stored_snapshots(spark, bronze).collect()]
    early = [s for s in everything if s < date(1998, 1, 1)]
    for wanted, reload in ((early, False), (everything, False), (early[:1], True)):
        medallion.load_cleaned(spark, bronze, f"{root}/silver", ATTRIBUTES, wanted, reload)
    return files.read_table(spark, f"{root}/silver", ATTRIBUTES.cleaned)


def stream_refresh(spark: SparkSession, d: str) -> DataFrame:
    bronze, root = _bronze_attributes(spark, d)
    refresh_cleaned(spark, bronze, f"{root}/silver", f"{root}/progress", ATTRIBUTES).awaitTermination()
    return files.read_table(spark, f"{root}/silver", ATTRIBUTES.cleaned)


# cleaning, one rule at a time


def strip_and_cast(spark: SparkSession, d: str) -> DataFrame:
    def readings(df: DataFrame, source: str, plain: str) -> DataFrame:
        return df.select(
            F.col(source).alias("source_text"),
            text.lenient_float(F.col(source)).alias("as_float"),
            text.lenient_int(F.col(source)).alias("as_int"),
            text.lenient_float(F.col(plain), strip=False).alias("plain_float"),
        )

    incomes = readings(inputs.raw_financials(spark, d), "Annual_Income", "Outstanding_Debt")
    return incomes.unionByName(readings(inputs.raw_attributes(spark, d), "Age", "Age"))


def normalise_key(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", text.normalise_key(F.col("c_name")).alias("name_key"))


def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    bad = F.col("o_orderkey") % 11 == 0
    us = F.when(bad, "13/45/23").otherwise(F.date_format("o_orderdate", "M/d/yy"))
    iso = F.when(bad, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        dates.parse_date(us, dates.SHORT_US_DATE).alias("from_us"),
        dates.parse_date(iso).alias("from_iso"),
    )


def negative_to_null(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", text.negative_to_null(F.col("c_acctbal")).alias("balance"))


def sentinel_replace(spark: SparkSession, d: str) -> DataFrame:
    priority = text.replace_sentinel(F.col("o_orderpriority"), "4-NOT SPECIFIED", "unknown")
    return table(spark, d, "orders").select("o_orderkey", priority.alias("priority"))


def history_age_parse(spark: SparkSession, d: str) -> DataFrame:
    age = F.col("Credit_History_Age")
    return inputs.raw_financials(spark, d).select(
        age.alias("history"),
        text.capture_int(age, text.YEARS_TEXT).alias("years"),
        text.capture_int(age, text.MONTHS_TEXT).alias("months"),
    )


def list_multi_hot(spark: SparkSession, d: str) -> DataFrame:
    listed = inputs.raw_financials(spark, d).select(
        "Type_of_Loan", F.size(text.list_items(F.col("Type_of_Loan"))).alias("n_items")
    )
    return cleaning.multi_hot(listed, "Type_of_Loan", specs.LOAN_TYPES)


def ordinal_encode(spark: SparkSession, d: str) -> DataFrame:
    mix, payment = F.col("Credit_Mix"), F.col("Payment_of_Min_Amount")
    return inputs.raw_financials(spark, d).select(
        mix.alias("mix_text"),
        text.ordinal(mix, cleaners.CREDIT_MIX_CODES).alias("mix"),
        payment.alias("payment_text"),
        text.ordinal(payment, cleaners.MIN_PAYMENT_CODES).alias("payment"),
    )


def format_validity(spark: SparkSession, d: str) -> DataFrame:
    return inputs.raw_attributes(spark, d).select(
        F.col("Name").alias("name"), text.keep_valid(F.col("SSN"), text.SSN_TEXT).alias("ssn")
    )


def complete_cases(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.complete_cases(inputs.raw_loans(spark, d).select("loan_id", "tenure", "balance"))


# mart and gold


def dim_feature(spark: SparkSession, d: str) -> DataFrame:
    """The features with their use in the clickstream."""
    dim = mart.dim_feature(spark)
    use = (
        mart.fact_clickstream(clickstream(spark, d), dim)
        .groupBy("feature_id")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("value").alias("total"))
    )
    return dim.join(use, "feature_id")


def dim_loan_type(spark: SparkSession, d: str) -> DataFrame:
    """The loan types with the number of customer snapshots that hold them."""
    held = financials(spark, d)
    dim = mart.dim_loan_type(spark, mart.loan_flags(held))
    holders = mart.fact_customer_loan_type(held, dim).groupBy("loan_type_id").agg(F.count(F.lit(1)).alias("holders"))
    return dim.join(holders, "loan_type_id")


def dim_snapshot(spark: SparkSession, d: str) -> DataFrame:
    return mart.dim_snapshot(loans(spark, d), clickstream(spark, d), attributes(spark, d), financials(spark, d))


def fact_clickstream(spark: SparkSession, d: str) -> DataFrame:
    return mart.fact_clickstream(clickstream(spark, d), mart.dim_feature(spark))


def fact_customer_loan_type(spark: SparkSession, d: str) -> DataFrame:
    held = financials(spark, d)
    return mart.fact_customer_loan_type(held, mart.dim_loan_type(spark, mart.loan_flags(held)))


def fact_loan(spark: SparkSession, d: str) -> DataFrame:
    return mart.fact_loan(loans(spark, d, inputs.SHIP_DAY))


def label_store(spark: SparkSession, d: str) -> DataFrame:
    return gold.label_store(fact_loan(spark, d), dpd_threshold=30, mob_threshold=6)


def derived_balance(spark: SparkSession, d: str) -> DataFrame:
    balanced = gold.with_monthly_balance(mart.fact_financials(financials(spark, d)))
    return balanced.select("customer_id", SNAPSHOT, "Monthly_Balance")


def _quarterly_attributes(spark: SparkSession, d: str) -> DataFrame:
    """Attributes as of the first month of each quarter."""
    return attributes(spark, d).where(F.month(SNAPSHOT) % 3 == 1)


def dim_customer_history(spark: SparkSession, d: str) -> DataFrame:
    return mart.dim_customer_history(_quarterly_attributes(spark, d))


def star_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Financials with the attributes that their customer had at the time."""
    history = stage(mart.dim_customer_history(_quarterly_attributes(spark, d)), "history")
    facts = stage(mart.fact_financials(financials(spark, d)), "facts")
    return gold.financials_as_of(facts, history).select(
        "customer_id", SNAPSHOT, "Monthly_Balance", "Interest_Rate", "SSN", "Name", "Age", "Occupation", "valid_from"
    )


def star_joins(spark: SparkSession, d: str) -> DataFrame:
    return gold.star_rows(mart_tables(spark, d)).select(
        "loan_id", "customer_id", SNAPSHOT, "mob", "dpd", "Name", "Age", "Monthly_Balance", "credit_mix_id",
        "payment_code", "spend", "value", "loan_type_id", "loan_type_name",
    )


def star_fan_out(spark: SparkSession, d: str) -> DataFrame:
    """How many star rows each customer and snapshot gets, without building them."""
    base = gold.star_base(mart_tables(spark, d))
    return base.groupBy("customer_id", SNAPSHOT).agg(F.sum("_copies").alias("copies"))


BUCKETS = 16


def bucketed_mart(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The mart with the star's facts bucketed by customer and snapshot."""
    tables, root = mart_tables(spark, d), staging_path(spark, "bucketed")
    facts = ("fact_financials", "fact_loan", "fact_customer_loan_type")
    buckets = bucketed.buckets_for([tables[name] for name in facts], BUCKETS)

    def write(name: str) -> DataFrame:
        return bucketed.write_bucketed(tables[name], f"{name}_{root[-32:]}", f"{root}/{name}", gold.BY_SNAPSHOT, buckets)

    with loading(spark), ThreadPoolExecutor(len(facts)) as pool:
        return tables | dict(zip(facts, pool.map(inheritable_thread_target(spark)(write), facts)))


def star_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """The star's fan-out from bucketed facts."""
    base = gold.star_base_bucketed(bucketed_mart(spark, d))
    return base.groupBy("customer_id", SNAPSHOT).agg(F.sum("_copies").alias("copies"))


def iqr_filter(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.iqr_filter(priced_orders(spark, d), ["o_totalprice", "c_acctbal"], k=0.5, relative_error=0)


def iqr_bounds(spark: SparkSession, d: str) -> DataFrame:
    bounds = quantiles.iqr_bounds(priced_orders(spark, d), ["o_totalprice"], relative_error=0)
    return bounds.select(
        F.col("o_totalprice.lower").alias("price_lower"), F.col("o_totalprice.upper").alias("price_upper")
    )


def quartile_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Quartiles with the default error: whether the rank of each is off by no more than it."""
    columns, wanted, error = ["o_totalprice", "c_acctbal"], [0.25, 0.75], 0.01
    prices = priced_orders(spark, d)
    found = quantiles.quantiles(prices, columns, wanted, error).first()
    n = F.count(F.lit(1))
    checks = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(p).alias("quartile"),
            ((F.count_if(F.col(c) < found[c][i]) <= (p + error) * n) & (F.count_if(F.col(c) <= found[c][i]) >= (p - error) * n)).alias(
                "within_error"
            ),
        )
        for c in columns
        for i, p in enumerate(wanted)
    ]
    return prices.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))



def sketch_quartiles(spark: SparkSession, d: str) -> DataFrame:
    """Quartiles merged from sketches of each month, and from one of all rows: whether their
    ranks are off by no more than 1 %."""
    columns, wanted = ["o_totalprice", "c_acctbal"], [0.25, 0.75]
    months = orders_by_month(spark, d).select("o_orderkey", SNAPSHOT)
    prices = priced_orders(spark, d).join(months, "o_orderkey")
    n, checks = F.count(F.lit(1)), []
    for kept, by in (("month", [SNAPSHOT]), ("all", [])):
        found = sketches.sketch_quantiles(sketches.quantile_sketches(prices, columns, by), columns, wanted).first()
        for c in columns:
            for p, value in zip(wanted, found[c]):
                close = (F.count_if(F.col(c) < value) <= (p + 0.01) * n) & (F.count_if(F.col(c) <= value) >= (p - 0.01) * n)
                names = {"kept": F.lit(kept), "column_name": F.lit(c), "quartile": F.lit(p), "within_error": close}
                checks.append(F.struct(*(v.alias(k) for k, v in names.items())))
    return prices.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


def log_features(spark: SparkSession, d: str) -> DataFrame:
    prices = priced_orders(spark, d)
    shifted = features.logarithm("c_acctbal", features.least_value(prices, "c_acctbal"))
    logs = features.derive(prices, [features.logarithm("o_totalprice"), shifted])
    return logs.select("o_orderkey", *(F.round(c, 6).alias(c) for c in ("o_totalprice_Log", "c_acctbal_Log")))


def safe_ratios(spark: SparkSession, d: str) -> DataFrame:
    ratios = [
        ("price_to_balance", "o_totalprice", "c_acctbal"),
        ("balance_to_price", "c_acctbal", "o_totalprice"),
    ]
    with_ratios = features.derive(priced_orders(spark, d), [features.ratio(*r) for r in ratios])
    return with_ratios.select("o_orderkey", *(F.round(name, 6).alias(name) for name, _, _ in ratios))


def is_employed(spark: SparkSession, d: str) -> DataFrame:
    flag = numeric.indicator(F.col("c_mktsegment"), "MACHINERY")
    return table(spark, d, "customer").select("c_custkey", flag.alias("is_employed"))


def drop_collinear(spark: SparkSession, d: str) -> DataFrame:
    balanced = gold.with_monthly_balance(mart.fact_financials(financials(spark, d)))
    return balanced.drop(*gold.COLLINEAR_COLUMNS)


def _rounded(star: DataFrame) -> DataFrame:
    shown = {f.name for f in star.schema if f.dataType.typeName() == "double"}
    utilisation = F.col("Credit_Utilization_Ratio").cast("double")
    return star.withColumns({c: F.round(c, 6) for c in shown} | {"Credit_Utilization_Ratio": utilisation})


def loan_analytics_star(spark: SparkSession, d: str) -> DataFrame:
    """The gold feature table, with exact quartiles so that the oracle can follow."""
    return _rounded(gold.build_star(mart_tables(spark, d), gold.StarOptions(relative_error=0)))


def loan_analytics_star_by_loan(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(gold.build_star(mart_tables(spark, d), gold.StarOptions(grain="loan", relative_error=0)))


#: Two-digit years read as 20yy, so all dates of the run are moved behind 2000.
MONTHS_LATER = 120


def _delivered(spark: SparkSession, d: str) -> tuple[medallion.Layout, date, date, date]:
    """All rows of the four sources as CSV, the first and last of their snapshots as seen while
    they are written, and the month three before the first source ends."""
    root = staging_path(spark, "run")
    layout = medallion.Layout(f"{root}/raw", f"{root}/lake")
    later = F.add_months(SNAPSHOT, MONTHS_LATER)
    sources = {
        "lms_loan_daily": inputs.raw_loans(spark, d).withColumn(SNAPSHOT, later),
        "features_financials": inputs.raw_financials(spark, d).withColumn(SNAPSHOT, later),
        "features_attributes": inputs.raw_attributes(spark, d).withColumn(SNAPSHOT, later),
        "feature_clickstream": inputs.raw_clickstream(spark, d, inputs.CLICK_MONTH),
    }
    spans = {name: Observation(f"span_{name}") for name in sources}
    ends = [F.min(SNAPSHOT).alias("low"), F.max(SNAPSHOT).alias("high")]
    write_side_by_side(spark, {name: df.observe(spans[name], *ends) for name, df in sources.items()}, layout.raw)
    found = spark.createDataFrame([(s.get["low"], s.get["high"]) for s in spans.values()], "low date, high date")
    span = found.agg(F.min("low"), F.max("high"), F.add_months(F.min("high"), -3)).first()
    return layout, *span


def _whole_run(spark: SparkSession, d: str) -> medallion.Layout:
    """All layers over all delivered rows; the calendar spans their snapshots."""
    layout, start, end, _ = _delivered(spark, d)
    medallion.run(spark, medallion.RunConfig(layout, start, end, star=gold.StarOptions(relative_error=0)))
    return layout


def medallion_run(spark: SparkSession, d: str) -> DataFrame:
    """The star of a whole run, read back from gold."""
    return _rounded(medallion.read_gold(spark, _whole_run(spark, d), "loan_analytics_star"))


def incremental_run(spark: SparkSession, d: str) -> DataFrame:
    """The star after two runs that take in what is new: first without the last months, then
    with them."""
    layout, start, end, earlier = _delivered(spark, d)
    for upto in (earlier, end):
        increments.advance(spark, medallion.RunConfig(layout, start, upto, star=gold.StarOptions(relative_error=0)))
    return _rounded(medallion.read_gold(spark, layout, "loan_analytics_star"))


def medallion_labels(spark: SparkSession, d: str) -> DataFrame:
    """The labels of a whole run, read back from gold."""
    return medallion.read_gold(spark, _whole_run(spark, d), "label_store")


def _content(name: str, table: DataFrame) -> DataFrame:
    """Rows of a table, a sum over hashes of its rows' keys, dates and counts, and the sum of its
    amounts in hundredths."""
    amounts = [f.name for f in table.schema if isinstance(f.dataType, FractionalType)]
    texts = [F.col(c).cast("string") for c in sorted(table.columns) if c not in amounts]
    keys = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("long")
    hundredths = sum((F.floor(F.col(c).cast("double") * 100) for c in amounts), F.lit(0).cast("long"))
    return table.agg(
        F.first(F.lit(name)).alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.sum(keys).alias("keys"),
        F.sum(hundredths).alias("hundredths"),
    )


def medallion_mart(spark: SparkSession, d: str) -> DataFrame:
    """What each mart table of a whole run holds, read back."""
    tables = medallion.read_mart(spark, _whole_run(spark, d))
    return reduce(DataFrame.union, [_content(name, t) for name, t in tables.items()])


def reload_withdrawn(spark: SparkSession, d: str) -> DataFrame:
    """Attributes loaded twice: at the second delivery one snapshot is gone and another has no
    valid row left."""
    root = staging_path(spark, "withdrawn")
    later = F.add_months(SNAPSHOT, MONTHS_LATER)
    first = inputs.raw_attributes(spark, d).withColumn(SNAPSHOT, later)
    gone, invalid = date(2006, 3, 1), date(2007, 5, 1)
    second = first.filter(F.col(SNAPSHOT) != F.lit(gone)).withColumn(
        "SSN", F.when(F.col(SNAPSHOT) == F.lit(invalid), F.lit("#F%$D@*&8")).otherwise(F.col("SSN"))
    )
    dates = [r[0] for r in first.select(SNAPSHOT).distinct().collect()]
    for n, (delivery, reload) in enumerate(((first, False), (second, True))):
        write_raw_csv(delivery, f"{root}/raw{n}.csv", ATTRIBUTES)
        medallion.load_bronze(spark, f"{root}/raw{n}.csv", f"{root}/bronze", ATTRIBUTES, dates)
        medallion.load_cleaned(spark, f"{root}/bronze", f"{root}/silver", ATTRIBUTES, dates, reload)
    return files.read_table(spark, f"{root}/silver", ATTRIBUTES.cleaned).drop(LINEAGE)


def queries() -> dict[str, Query]:
    return {
        "month_spine": month_spine,
        "ingest_csv_roundtrip": ingest_csv_roundtrip,
        "ingest_with_rejects": ingest_with_rejects,
        "inferred_contract": inferred_contract,
        "list_csv_sources": list_csv_sources,
        "snapshot_slice": snapshot_slice,
        "snapshot_audit": snapshot_audit,
        "feature_store_snapshot": feature_store_snapshot,
        "feature_store_write": feature_store_write,
        "observed_audit": observed_audit,
        "row_digests": row_digests,
        "snapshot_digests": snapshot_digests,
        "profile_drift": profile_drift,
        "conform_columns": conform_columns,
        "row_fingerprint_intersect": row_fingerprint_intersect,
        "load_state": load_state,
        "new_rows_anti": new_rows_anti,
        "missing_snapshots": missing_snapshots,
        "incremental_load": incremental_load,
        "stream_refresh": stream_refresh,
        "strip_and_cast": strip_and_cast,
        "normalise_key": normalise_key,
        "parse_dates": parse_dates,
        "negative_to_null": negative_to_null,
        "sentinel_replace": sentinel_replace,
        "history_age_parse": history_age_parse,
        "list_multi_hot": list_multi_hot,
        "ordinal_encode": ordinal_encode,
        "format_validity": format_validity,
        "complete_cases": complete_cases,
        "clean_loans": loans,
        "clean_financials": financials,
        "clean_attributes": attributes,
        "clean_clickstream": clickstream,
        "dim_snapshot": dim_snapshot,
        "dim_customer": lambda spark, d: mart.dim_customer(attributes(spark, d)),
        "dim_customer_history": dim_customer_history,
        "dim_feature": dim_feature,
        "dim_credit_mix": lambda spark, d: mart.dim_credit_mix(financials(spark, d)),
        "dim_min_payment": lambda spark, d: mart.dim_min_payment(financials(spark, d)),
        "dim_payment_behaviour": lambda spark, d: mart.dim_payment_behaviour(financials(spark, d)),
        "dim_loan_type": dim_loan_type,
        "fact_clickstream": fact_clickstream,
        "fact_financials": lambda spark, d: mart.fact_financials(financials(spark, d)),
        "fact_loan": fact_loan,
        "fact_customer_loan_type": fact_customer_loan_type,
        "label_store": label_store,
        "derived_balance": derived_balance,
        "star_joins": star_joins,
        "star_fan_out": star_fan_out,
        "star_as_of": star_as_of,
        "star_bucketed": star_bucketed,
        "iqr_filter": iqr_filter,
        "iqr_bounds": iqr_bounds,
        "quartile_ranks": quartile_ranks,
        "sketch_quartiles": sketch_quartiles,
        "log_features": log_features,
        "safe_ratios": safe_ratios,
        "is_employed": is_employed,
        "drop_collinear": drop_collinear,
        "loan_analytics_star": loan_analytics_star,
        "loan_analytics_star_by_loan": loan_analytics_star_by_loan,
        "medallion_run": medallion_run,
        "incremental_run": incremental_run,
        "medallion_labels": medallion_labels,
        "medallion_mart": medallion_mart,
        "reload_withdrawn": reload_withdrawn,
    }
