"""Gold tables: default labels and the loan analytics star."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lendstrata.functions.credit import default_label
from lendstrata.functions.numeric import indicator
from lendstrata.operators.features import derive, least_value, logarithm, ratio
from lendstrata.operators.history import as_of
from lendstrata.operators.quantiles import Fences, iqr_fences, within_fences
from lendstrata.operators.skew import ROW_SALT, HotKeys, hot_keys, replicate_rows, skew_join, with_row_salt
from lendstrata.plans.mart import CUSTOMER_ATTRIBUTES
from lendstrata.sources.specs import SNAPSHOT
from lendstrata.sources.staging import stage

# The feature definitions consumers of the gold tables rely on.
OUTLIER_COLUMNS = [
    "Age",
    "Interest_Rate",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Num_of_Loan",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "Annual_Income",
    "Outstanding_Debt",
    "Monthly_Inhand_Salary",
]
LOG_COLUMNS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Num_Credit_Inquiries",
]
BALANCE = "Monthly_Balance"
RATIOS = [
    ("Debt_to_Income_Ratio", "Outstanding_Debt", "Annual_Income"),
    ("EMI_to_Income_Ratio", "Total_EMI_per_month", "Monthly_Inhand_Salary"),
    ("Invest_to_Income_Ratio", "Amount_invested_monthly", "Monthly_Inhand_Salary"),
    ("Credit_Inquiry_to_Loan_Ratio", "Num_Credit_Inquiries", "Num_of_Loan"),
]
COLLINEAR_COLUMNS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Monthly_Balance",
    "Amount_invested_monthly",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Monthly_Inhand_Salary_Log",
]
STAR_COLUMNS = [
    "customer_id",
    "Name",
    "Age",
    "Credit_Utilization_Ratio",
    "Credit_History_Years",
    "Credit_History_Months",
    "Annual_Income_Log",
    "Outstanding_Debt_Log",
    "Total_EMI_per_month_Log",
    "Amount_invested_monthly_Log",
    "Num_Credit_Inquiries_Log",
    "Monthly_Balance_Log",
    "Debt_to_Income_Ratio",
    "EMI_to_Income_Ratio",
    "Invest_to_Income_Ratio",
    "Credit_Inquiry_to_Loan_Ratio",
    "Is_Employed",
    SNAPSHOT,
]
EMPLOYED = "employed"

BY_CUSTOMER = ["customer_id"]
BY_SNAPSHOT = ["customer_id", SNAPSHOT]


@dataclass(frozen=True)
class StarOptions:
    """``grain="loan_type"`` repeats a loan's features for every loan type its customer
    holds; ``grain="loan"`` gives one row per loan and keeps ``loan_id``."""

    grain: str = "loan_type"
    outlier_columns: tuple[str, ...] = tuple(OUTLIER_COLUMNS)
    iqr_factor: float = 1.5
    relative_error: float = 0.01


def label_store(
    loans: DataFrame, dpd_threshold: int = 30, mob_threshold: int = 6, null_dpd_label: int = 0
) -> DataFrame:
    """Default label of every loan at one month on book."""
    return loans.filter(F.col("mob") == mob_threshold).select(
        "loan_id",
        "customer_id",
        default_label(F.col("dpd"), dpd_threshold, null_dpd_label).alias("label"),
        F.lit(f"{dpd_threshold}dpd_{mob_threshold}mob").alias("label_def"),
        SNAPSHOT,
    )


def with_monthly_balance(financials: DataFrame) -> DataFrame:
    return financials.withColumn(
        BALANCE, F.col("Monthly_Inhand_Salary") - F.col("Total_EMI_per_month")
    )


def loan_type_copies(loans: DataFrame, loan_types: DataFrame) -> DataFrame:
    """How often the star repeats a financial row: loans times loan types held, per
    customer and snapshot. Both facts shrink to counts before they are shuffled."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    return (
        loans.select(*BY_SNAPSHOT, one.alias("_loans"), none.alias("_types"))
        .unionByName(loan_types.select(*BY_SNAPSHOT, none.alias("_loans"), one.alias("_types")))
        .groupBy(*BY_SNAPSHOT)
        .agg(F.sum("_loans").alias("_loans"), F.sum("_types").alias("_types"))
        .filter("_loans > 0")
        .select(*BY_SNAPSHOT, F.expr("_loans * greatest(_types, 1)").alias("_copies"))
    )


@dataclass(frozen=True)
class _Fact:
    """A fact scan to join, numbered when it has hot keys, and these keys."""

    rows: DataFrame
    hot_snapshots: HotKeys
    hot_customers: HotKeys

    @staticmethod
    def of(scan: DataFrame) -> _Fact:
        hot_snapshots, hot_customers = hot_keys(scan, BY_SNAPSHOT, BY_CUSTOMER)
        rows = with_row_salt(scan) if hot_snapshots or hot_customers else scan
        return _Fact(rows, hot_snapshots, hot_customers)


def _join_customers(rows: DataFrame, fact: _Fact, customers: DataFrame) -> DataFrame:
    (hot,) = hot_keys(customers, BY_CUSTOMER)
    return skew_join(rows, customers, BY_CUSTOMER, hot_left=fact.hot_customers, hot_right=hot)


def star_base(mart: Mapping[str, DataFrame], grain: str = "loan_type") -> DataFrame:
    """Financials joined to the loans of the same customer and snapshot, and to customers.

    No column of the star comes from a loan or a loan type, so at the grain of loan types
    the joins to those facts only repeat rows: the base holds each row once, with the
    number of its copies in ``_copies``. At the grain of loans the loans are joined, last,
    so that what may multiply is not shuffled again.
    """
    financials = _Fact.of(mart["fact_financials"])
    balanced = with_monthly_balance(financials.rows)
    if grain == "loan_type":
        copies = loan_type_copies(mart["fact_loan"], mart["fact_customer_loan_type"])
        counted = skew_join(balanced, copies, BY_SNAPSHOT, hot_left=financials.hot_snapshots, hot_right={})
        base = _join_customers(counted, financials, mart["dim_customer"])
    elif grain == "loan":
        loans = _Fact.of(mart["fact_loan"].select("loan_id", *BY_SNAPSHOT))
        owned = _join_customers(balanced, financials, mart["dim_customer"])
        base = skew_join(
            loans.rows, owned, BY_SNAPSHOT, hot_left=loans.hot_snapshots, hot_right=financials.hot_snapshots
        ).withColumn("_copies", F.lit(1).cast("long"))
    else:
        raise ValueError(f"unknown grain {grain!r}")
    return base.drop(ROW_SALT, "SSN")


def financials_as_of(financials: DataFrame, history: DataFrame) -> DataFrame:
    """Financial rows with their balance and the attributes that their customer had at their
    snapshot: one customer row each, where the star has one for each version of the customer."""
    return as_of(with_monthly_balance(financials), history, "customer_id", SNAPSHOT, CUSTOMER_ATTRIBUTES)


def fact_joins(financials: DataFrame, loans: DataFrame, loan_types: DataFrame) -> DataFrame:
    """Financial rows with their balance and their number of copies in the star, from facts that
    are bucketed by customer and snapshot: both other facts are counted and joined bucket by
    bucket, without a shuffle."""
    counted = [
        fact.groupBy(*BY_SNAPSHOT).agg(F.count(F.lit(1)).alias(name)) for fact, name in ((loans, "_loans"), (loan_types, "_types"))
    ]
    joined = with_monthly_balance(financials).join(counted[0], BY_SNAPSHOT).join(counted[1], BY_SNAPSHOT, "left")
    copies = F.col("_loans") * F.greatest(F.coalesce("_types", F.lit(0)), F.lit(1))
    return joined.withColumn("_copies", copies).drop("_loans", "_types")


def star_base_bucketed(mart: Mapping[str, DataFrame]) -> DataFrame:
    """``star_base`` at the grain of loan types from bucketed facts. Customers are joined by
    their id alone, which takes the only shuffle."""
    joined = fact_joins(mart["fact_financials"], mart["fact_loan"], mart["fact_customer_loan_type"])
    return skew_join(joined, mart["dim_customer"], BY_CUSTOMER, hot_left=hot_keys(mart["fact_financials"], BY_CUSTOMER)[0]).drop("SSN")


def star_features(
    base: DataFrame,
    options: StarOptions = StarOptions(),
    fences: Fences | None = None,
    least_balance: float | None = None,
) -> DataFrame:
    """Outlier filter, logarithms, ratios, indicator and final columns on a stored base.

    Quartiles count each row ``_copies`` times, and the copies appear in the result. Fences
    and the least balance within them come from ``base`` unless they are given, as they are
    for a part of the snapshots.
    """
    if fences is None:
        fences = iqr_fences(base, options.outlier_columns, options.iqr_factor, options.relative_error, weight="_copies")
    kept = within_fences(base, fences)
    origin = F.lit(least_balance) if least_balance is not None else least_value(kept, BALANCE)
    return _unfolded(featured(kept, origin), options, base)


def featured(kept: DataFrame, least_balance: Column) -> DataFrame:
    """The rows within the fences with all derived columns."""
    logs = [logarithm(c) for c in LOG_COLUMNS] + [logarithm(BALANCE, least_balance)]
    return derive(kept, [*logs, *(ratio(*r) for r in RATIOS)]).withColumn(
        "Is_Employed", indicator(F.col("Occupation"), EMPLOYED)
    )


def _unfolded(rows: DataFrame, options: StarOptions, base: DataFrame) -> DataFrame:
    slim = rows.drop(*COLLINEAR_COLUMNS)
    if options.grain == "loan":
        return slim.select("loan_id", *STAR_COLUMNS)
    return replicate_rows(slim.select(*STAR_COLUMNS, "_copies"), "_copies", _most(base, "_copies"))


def _most(stored: DataFrame, copies: str) -> int:
    return stored.agg(F.max(copies)).first()[0] or 0


def build_star(mart: Mapping[str, DataFrame], options: StarOptions = StarOptions()) -> DataFrame:
    """The loan analytics star. The joins run once, into a staged table that the
    quartiles, the least balance and the features are then read from."""
    return star_features(stage(star_base(mart, options.grain), "star-base"), options)


def enrich_with_dimensions(rows: DataFrame, mart: Mapping[str, DataFrame]) -> DataFrame:
    """Left joins to the four code dimensions, for reports that want their texts.

    The coded dimensions hold at most as many rows as their code has values and are
    broadcast; payment behaviours come from free text, and how they are joined is left to
    adaptive execution.
    """
    coded = (
        rows.join(F.broadcast(mart["dim_credit_mix"]), "credit_mix_id", "left")
        .join(F.broadcast(mart["dim_min_payment"]), "payment_code", "left")
        .join(F.broadcast(mart["dim_loan_type"]), "loan_type_id", "left")
    )
    return coded.join(mart["dim_payment_behaviour"], "payment_behaviour_id", "left")


def star_rows(mart: Mapping[str, DataFrame]) -> DataFrame:
    """Every column of the joined star, one row per loan, financial row, loan type and
    customer row, code dimensions included. For ad-hoc reports; the feature table itself
    is built without materialising these copies.

    Loan types shrink to one row per customer, snapshot and type before they are joined;
    how often each was held is unfolded from the staged result.
    """
    loans, financials = _Fact.of(mart["fact_loan"]), _Fact.of(mart["fact_financials"])
    held = mart["fact_customer_loan_type"].groupBy(*BY_SNAPSHOT, "loan_type_id").agg(F.count(F.lit(1)).alias("_held"))
    typed = skew_join(loans.rows, held, BY_SNAPSHOT, "left", hot_left=loans.hot_snapshots)
    owned = _join_customers(with_monthly_balance(financials.rows), financials, mart["dim_customer"])
    joined = skew_join(typed, owned, BY_SNAPSHOT, hot_left=loans.hot_snapshots, hot_right=financials.hot_snapshots)
    folded = joined.drop(ROW_SALT).withColumn("_held", F.coalesce("_held", F.lit(1)))
    stored = stage(folded, "star-rows")
    return enrich_with_dimensions(replicate_rows(stored, "_held", _most(stored, "_held")), mart)
