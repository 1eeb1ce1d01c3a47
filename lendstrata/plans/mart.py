"""Star schema from the four cleaned tables: seven dimensions, four facts. All lazy."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendstrata.functions import credit, text
from lendstrata.operators.history import validity_intervals
from lendstrata.operators.reshape import unpivot
from lendstrata.sources.specs import N_CLICK_FEATURES, SNAPSHOT, click_features

FLAG_PREFIX = "Has_"

# What the facts carry over from the cleaned tables.
FINANCIAL_MEASURES = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Changed_Credit_Limit",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
]
CODED_FINANCIALS = {
    "payment_code": "Payment_of_Min_Amount",
    "payment_behaviour_id": "Payment_Behaviour",
    "credit_mix_id": "Credit_Mix",
}
CREDIT_HISTORY = ["Credit_History_Years", "Credit_History_Months"]
LOAN_TERMS = ["loan_start_date", "tenure", "loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]


@dataclass(frozen=True)
class CleanedTables:
    loans: DataFrame
    attributes: DataFrame
    clickstream: DataFrame
    financials: DataFrame


def dim_snapshot(*tables: DataFrame) -> DataFrame:
    """Snapshots that occur in any of the tables."""
    return reduce(DataFrame.unionByName, (t.select(SNAPSHOT) for t in tables)).distinct()


def dim_snapshot_of(spark: SparkSession, dates: Iterable[date]) -> DataFrame:
    """The same from the stored tables' lists of snapshots, without reading a row."""
    return spark.createDataFrame([(d,) for d in sorted({*dates})], f"{SNAPSHOT} date")


def dim_customer(attributes: DataFrame) -> DataFrame:
    """Distinct customer attributes; a customer whose attributes changed has several rows."""
    return attributes.select(
        F.col("Customer_ID").alias("customer_id"), "SSN", "Name", "Age", "Occupation"
    ).distinct()


CUSTOMER_ATTRIBUTES = ["SSN", "Name", "Age", "Occupation"]


def dim_customer_history(attributes: DataFrame) -> DataFrame:
    """Customer attributes with the days from and to which they hold."""
    named = attributes.withColumnRenamed("Customer_ID", "customer_id")
    return validity_intervals(named, "customer_id", SNAPSHOT, CUSTOMER_ATTRIBUTES)


def dim_feature(spark: SparkSession, n_features: int = N_CLICK_FEATURES) -> DataFrame:
    """Ids and names of the clickstream features, from 1."""
    return spark.range(1, n_features + 1, 1, 1).select(
        F.col("id").alias("feature_id"), F.concat(F.lit("fe_"), "id").alias("feature_name")
    )


def dim_credit_mix(financials: DataFrame) -> DataFrame:
    return financials.select(F.col("Credit_Mix").alias("credit_mix_id")).distinct()


def dim_min_payment(financials: DataFrame) -> DataFrame:
    return financials.select(F.col("Payment_of_Min_Amount").alias("payment_code")).distinct()


def dim_payment_behaviour(financials: DataFrame) -> DataFrame:
    """Distinct behaviours, split into spend (first part) and value (third part, NULL if absent)."""
    behaviours = financials.select(F.col("Payment_Behaviour").alias("payment_behaviour_id")).distinct()
    return behaviours.select(
        "*",
        text.split_part(F.col("payment_behaviour_id"), 0).alias("spend"),
        text.split_part(F.col("payment_behaviour_id"), 2).alias("value"),
    )


def loan_flags(financials: DataFrame) -> list[str]:
    return [c for c in financials.columns if c.startswith(FLAG_PREFIX)]


def dim_loan_type(spark: SparkSession, flags: list[str]) -> DataFrame:
    """Flag columns in schema order, numbered from 1; as many rows as the schema has flags."""
    rows = [(i, flag) for i, flag in enumerate(flags, start=1)]
    return spark.createDataFrame(rows, "loan_type_id bigint, loan_flag_col string").withColumn(
        "loan_type_name", F.replace("loan_flag_col", F.lit(FLAG_PREFIX), F.lit(""))
    )


def fact_clickstream(clickstream: DataFrame, features: DataFrame) -> DataFrame:
    """One row per customer, snapshot and feature. No shuffle: unpivot, then a join to the
    feature dimension, which has one row per column of the clickstream contract."""
    columns = [c for c in click_features() if c in clickstream.columns]
    long = unpivot(clickstream, ["Customer_ID", SNAPSHOT], columns, "feature_name", "value")
    return long.join(F.broadcast(features), "feature_name", "left").select(
        F.col("Customer_ID").alias("customer_id"), "feature_id", "value", SNAPSHOT
    )


def fact_financials(financials: DataFrame) -> DataFrame:
    """Customer financials per snapshot; balance and loan flags live elsewhere."""
    coded = [F.col(source).alias(name) for name, source in CODED_FINANCIALS.items()]
    key = F.col("Customer_ID").alias("customer_id")
    return financials.select(key, SNAPSHOT, *FINANCIAL_MEASURES, *coded, *CREDIT_HISTORY)


def fact_loan(loans: DataFrame) -> DataFrame:
    """Loan snapshots with months on book and days past due."""
    overdue, due, snapshot = F.col("overdue_amt"), F.col("due_amt"), F.col(SNAPSHOT)
    counted = loans.withColumn("installments_missed", credit.installments_missed(overdue, due))
    dated = counted.withColumn(
        "first_missed_date", credit.first_missed_date(snapshot, F.col("installments_missed"))
    )
    return dated.select(
        "loan_id",
        F.col("Customer_ID").alias("customer_id"),
        F.col("installment_num").cast("int").alias("mob"),
        "installments_missed",
        "first_missed_date",
        credit.days_past_due(overdue, snapshot, F.col("first_missed_date")).alias("dpd"),
        SNAPSHOT,
        *LOAN_TERMS,
    )


def fact_customer_loan_type(financials: DataFrame, loan_types: DataFrame) -> DataFrame:
    """One row per customer, snapshot and loan type held. No shuffle: unpivot, filter, then
    a join to the loan types, which has one row per flag column."""
    held = unpivot(
        financials, ["Customer_ID", SNAPSHOT], loan_flags(financials), "loan_flag_col", "_flag"
    ).filter("_flag = 1")
    return held.join(F.broadcast(loan_types), "loan_flag_col", "left").select(
        F.col("Customer_ID").alias("customer_id"), "loan_type_id", SNAPSHOT
    )


@dataclass(frozen=True)
class DistinctDimension:
    """A dimension of the distinct values of some columns of a cleaned table; ``identity``
    names its columns that are never NULL and tell its rows apart."""

    source: str
    columns: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame]
    identity: tuple[str, ...]


#: Snapshot by snapshot, what each fact and dimension follows from.
FACT_SOURCES = {
    "fact_clickstream": "clickstream",
    "fact_financials": "financials",
    "fact_loan": "loans",
    "fact_customer_loan_type": "financials",
}
DISTINCT_DIMENSIONS = {
    "dim_customer": DistinctDimension(
        "attributes",
        ("Customer_ID", "SSN", "Name", "Age", "Occupation"),
        dim_customer,
        ("customer_id", "SSN", "Name", "Age", "Occupation"),
    ),
    "dim_credit_mix": DistinctDimension("financials", ("Credit_Mix",), dim_credit_mix, ("credit_mix_id",)),
    "dim_payment_behaviour": DistinctDimension(
        "financials", ("Payment_Behaviour",), dim_payment_behaviour, ("payment_behaviour_id",)
    ),
    "dim_min_payment": DistinctDimension("financials", ("Payment_of_Min_Amount",), dim_min_payment, ("payment_code",)),
}


def build_fact(name: str, cleaned: DataFrame) -> DataFrame:
    """A fact from (some snapshots of) the cleaned table that it follows from."""
    spark = cleaned.sparkSession
    if name == "fact_clickstream":
        return fact_clickstream(cleaned, dim_feature(spark))
    if name == "fact_financials":
        return fact_financials(cleaned)
    if name == "fact_loan":
        return fact_loan(cleaned)
    if name == "fact_customer_loan_type":
        return fact_customer_loan_type(cleaned, dim_loan_type(spark, loan_flags(cleaned)))
    raise ValueError(f"no fact {name!r}")


def build_mart(cleaned: CleanedTables, dates: Iterable[date] | None = None) -> dict[str, DataFrame]:
    """All mart tables by name. With the ``dates`` of the stored tables' snapshots no row is
    read for these."""
    spark = cleaned.loans.sparkSession
    features = dim_feature(spark)
    loan_types = dim_loan_type(spark, loan_flags(cleaned.financials))
    return {
        "dim_snapshot": dim_snapshot(cleaned.loans, cleaned.clickstream, cleaned.attributes, cleaned.financials)
        if dates is None
        else dim_snapshot_of(spark, dates),
        "dim_customer": dim_customer(cleaned.attributes),
        "dim_feature": features,
        "dim_credit_mix": dim_credit_mix(cleaned.financials),
        "dim_payment_behaviour": dim_payment_behaviour(cleaned.financials),
        "dim_min_payment": dim_min_payment(cleaned.financials),
        "dim_loan_type": loan_types,
        "fact_clickstream": fact_clickstream(cleaned.clickstream, features),
        "fact_financials": fact_financials(cleaned.financials),
        "fact_loan": fact_loan(cleaned.loans),
        "fact_customer_loan_type": fact_customer_loan_type(cleaned.financials, loan_types),
    }
