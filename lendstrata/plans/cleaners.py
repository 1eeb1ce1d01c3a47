"""The cleaner of each source, and the registry that binds sources to them.

A cleaner is a pure ``DataFrame -> DataFrame`` from the raw contract (without the load
date) to the cleaned one. ``clean_snapshots`` adds the parts they share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from lendstrata.functions import text
from lendstrata.operators.cleaning import cast_columns, complete_cases, multi_hot, null_counts
from lendstrata.operators.contracts import assert_schema, conform
from lendstrata.sources import specs
from lendstrata.sources.specs import SourceSpec

# Codes and markers found in the sources.
CREDIT_MIX_CODES = {"Standard": 2, "Good": 1, "Bad": 0}
MIN_PAYMENT_CODES = {"Yes": 1, "No": 0}
UNKNOWN_BEHAVIOUR = "!@9#%8"

# How the amounts and counts of each source are read.
LOAN_AMOUNTS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
LOAN_COUNTS = ["tenure", "installment_num"]
FILLED_AMOUNTS = ["Annual_Income", "Monthly_Inhand_Salary", "Num_of_Delayed_Payment"]
PLAIN_AMOUNTS = [
    "Changed_Credit_Limit",
    "Credit_Utilization_Ratio",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "Total_EMI_per_month",
    "Outstanding_Debt",
]

KEY = "Customer_ID"


def _normalise_customer(df: DataFrame) -> DataFrame:
    return df.withColumn(KEY, text.normalise_key(F.col(KEY)))


def clean_loans(df: DataFrame) -> DataFrame:
    """Normalised key, amounts float, counts int; the contract has the dates as dates."""
    return _normalise_customer(cast_columns(df, floats=LOAN_AMOUNTS, ints=LOAN_COUNTS))


def clean_attributes(df: DataFrame) -> DataFrame:
    """Normalised key, int age, social security number only when well formed."""
    return _normalise_customer(cast_columns(df, ints=["Age"])).withColumn(
        "SSN", text.keep_valid(F.col("SSN"), text.SSN_TEXT)
    )


def clean_clickstream(df: DataFrame) -> DataFrame:
    """Normalised key, so that clickstream customers join the other sources' customers."""
    return _normalise_customer(df)


def clean_financials(df: DataFrame) -> DataFrame:
    """Typed amounts and counts, coded categories, history in years and months, loan flags.

    Amounts read with filler stripped: income, salary, delayed payments. The others must
    be clean text; filler makes them NULL. A negative number of loans is unknown, with or
    without filler.
    """
    stripped = cast_columns(df, floats=FILLED_AMOUNTS, ints=["Num_of_Loan"])
    plain = cast_columns(stripped, floats=PLAIN_AMOUNTS, strip=False)
    coded = _normalise_customer(plain).withColumns(
        {
            "Num_of_Loan": text.negative_to_null(F.col("Num_of_Loan")),
            "Payment_Behaviour": text.replace_sentinel(F.col("Payment_Behaviour"), UNKNOWN_BEHAVIOUR, "unknown"),
            "Credit_History_Years": text.capture_int(F.col("Credit_History_Age"), text.YEARS_TEXT),
            "Credit_History_Months": text.capture_int(F.col("Credit_History_Age"), text.MONTHS_TEXT),
            "Credit_Mix": text.ordinal(F.col("Credit_Mix"), CREDIT_MIX_CODES),
            "Payment_of_Min_Amount": text.ordinal(F.col("Payment_of_Min_Amount"), MIN_PAYMENT_CODES),
        }
    )
    return multi_hot(coded, "Type_of_Loan", specs.LOAN_TYPES).drop("Credit_History_Age")


SOURCES: dict[str, SourceSpec] = {
    s.name: s
    for s in (
        SourceSpec("lms_loan_daily", specs.RAW_LOANS, specs.CLEAN_LOANS, clean_loans),
        SourceSpec("features_attributes", specs.RAW_ATTRIBUTES, specs.CLEAN_ATTRIBUTES, clean_attributes),
        SourceSpec("feature_clickstream", specs.RAW_CLICKSTREAM, specs.CLEAN_CLICKSTREAM, clean_clickstream),
        SourceSpec(
            "features_financials",
            specs.RAW_FINANCIALS,
            specs.CLEAN_FINANCIALS,
            clean_financials,
            specs.FINANCIALS_DATE_FORMAT,
        ),
    )
}


def clean_snapshots(bronze: DataFrame, spec: SourceSpec, audit: Observation | None = None) -> DataFrame:
    """Raw contract in, complete rows in the cleaned contract out, any number of snapshots.

    The action that consumes the result also counts the rows that came in; with ``audit``
    it reports, besides, how many rows each column costs through its NULLs. Observing has
    a second use: the test for complete rows stays above the projection. Pushed below it,
    all the parsing would be done twice, in a method too large for the JIT, which takes
    five times as long.
    """
    assert_schema(bronze, spec.raw, spec.name)
    cleaned = conform(spec.clean(bronze.drop(specs.LOAD_DATE)), spec.cleaned)
    if audit is None:
        observed = cleaned.observe(f"cleaning {spec.name}", F.count(F.lit(1)).alias("rows"))
    else:
        observed = cleaned.observe(audit, *null_counts(cleaned))
    return assert_schema(complete_cases(observed), spec.cleaned, spec.cleaned_name)
