"""Schema contracts of the four raw sources and of their cleaned tables.

Fixed values: the column names, types and orders below are the data model that existing
sources and consumers rely on.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from lendstrata.functions.dates import ISO_DATE, SHORT_US_DATE

SNAPSHOT = "snapshot_date"
LOAD_DATE = "date"
LINEAGE = "_metadata_file_name"
N_CLICK_FEATURES = 20

RAW_TAIL = f"{LINEAGE} string, {LOAD_DATE} date, {SNAPSHOT} date"
CLEAN_TAIL = f"{LINEAGE} string, {SNAPSHOT} date"


def click_features(n: int = N_CLICK_FEATURES) -> list[str]:
    return [f"fe_{i}" for i in range(1, n + 1)]


CLICK_COLUMNS = ", ".join(f"{c} int" for c in click_features())

LOAN_TYPES = [
    "Credit-Builder Loan",
    "Student Loan",
    "Mortgage Loan",
    "Payday Loan",
    "Personal Loan",
    "Debt Consolidation Loan",
    "Auto Loan",
    "Home Equity Loan",
]
LOAN_FLAGS = ["Has_" + t.replace(" ", "_") for t in LOAN_TYPES]

TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "float": FloatType(),
    "double": DoubleType(),
    "date": DateType(),
}


def contract(columns: str) -> StructType:
    """A contract from ``"name type, name type"``, readable before any session exists."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, TYPES[type_]) for name, type_ in pairs])


RAW_LOANS = contract(
    f"""loan_id string, Customer_ID string, loan_start_date date, tenure int,
    installment_num int, loan_amt int, due_amt double, paid_amt double,
    overdue_amt double, balance double, {RAW_TAIL}"""
)
RAW_ATTRIBUTES = contract(
    f"Customer_ID string, Name string, Age string, SSN string, Occupation string, {RAW_TAIL}"
)
RAW_CLICKSTREAM = contract(f"{CLICK_COLUMNS}, Customer_ID string, {RAW_TAIL}")
RAW_FINANCIALS = contract(
    f"""Customer_ID string, Annual_Income string, Monthly_Inhand_Salary double,
    Num_Bank_Accounts int, Num_Credit_Card int, Interest_Rate int, Num_of_Loan string,
    Type_of_Loan string, Delay_from_due_date int, Num_of_Delayed_Payment string,
    Changed_Credit_Limit string, Num_Credit_Inquiries int, Credit_Mix string,
    Outstanding_Debt string, Credit_Utilization_Ratio double, Credit_History_Age string,
    Payment_of_Min_Amount string, Total_EMI_per_month double,
    Amount_invested_monthly string, Payment_Behaviour string, Monthly_Balance string,
    {RAW_TAIL}"""
)

CLEAN_LOANS = contract(
    f"""loan_id string, Customer_ID string, loan_start_date date, tenure int,
    installment_num int, loan_amt float, due_amt float, paid_amt float,
    overdue_amt float, balance float, {CLEAN_TAIL}"""
)
CLEAN_ATTRIBUTES = contract(
    f"Customer_ID string, Name string, Age int, SSN string, Occupation string, {CLEAN_TAIL}"
)
CLEAN_CLICKSTREAM = contract(f"{CLICK_COLUMNS}, Customer_ID string, {CLEAN_TAIL}")
CLEAN_FINANCIALS = contract(
    f"""Customer_ID string, Annual_Income float, Monthly_Inhand_Salary float,
    Num_Bank_Accounts int, Num_Credit_Card int, Interest_Rate int, Num_of_Loan int,
    Delay_from_due_date int, Num_of_Delayed_Payment float, Changed_Credit_Limit float,
    Num_Credit_Inquiries int, Credit_Mix int, Outstanding_Debt float,
    Credit_Utilization_Ratio float, Payment_of_Min_Amount int, Total_EMI_per_month float,
    Amount_invested_monthly float, Payment_Behaviour string, Monthly_Balance float,
    {CLEAN_TAIL}, Credit_History_Years int, Credit_History_Months int,
    """
    + ", ".join(f"{flag} int" for flag in LOAN_FLAGS)
)


@dataclass(frozen=True)
class SourceSpec:
    """What there is to know about one source: its contracts, date format and cleaner."""

    name: str
    raw: StructType
    cleaned: StructType
    clean: Callable[[DataFrame], DataFrame]
    snapshot_format: str = ISO_DATE

    @property
    def cleaned_name(self) -> str:
        return f"{self.name}_cleaned"


FINANCIALS_DATE_FORMAT = SHORT_US_DATE
