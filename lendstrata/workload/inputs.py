"""Raw loan sources derived from whole driver tables.

The driver has no loan data, so orders, line items, customers and events are recast into
the four raw contracts, dirty text included. The recasting is stated once, in SQL that
Spark and the oracle both read; the operators under test are not part of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendstrata.sources.specs import LOAN_TYPES

ORDER_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"
SHIP_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"
SHIP_DAY = "CAST(l_shipdate AS DATE)"
CUSTOMER = "concat(' CUS_', o_custkey, ' ')"


def _pick(index: str, values: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


def loans_sql(snapshot: str = SHIP_MONTH) -> str:
    """One loan instalment per line item; no due amount for single pieces, some balances unknown."""
    return f"""
    SELECT concat('LN_', l_orderkey, '_', l_linenumber, '_', l_partkey) AS loan_id,
           {CUSTOMER} AS Customer_ID,
           CAST(o_orderdate AS DATE) AS loan_start_date,
           CAST(l_quantity AS INT) AS tenure,
           CAST(l_linenumber AS INT) AS installment_num,
           CAST(floor(l_extendedprice) AS INT) AS loan_amt,
           CASE WHEN l_quantity = 1 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS due_amt,
           l_extendedprice * (1 - l_discount) AS paid_amt,
           l_extendedprice * abs(l_discount) * 50 AS overdue_amt,
           CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE l_extendedprice * (1 + l_tax) END AS balance,
           'lineitem' AS _metadata_file_name,
           {snapshot} AS date,
           {snapshot} AS snapshot_date
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey"""


def financials_sql() -> str:
    """Financials of a customer per order, with filler, sentinels and unreadable values."""
    first, second, third = (
        _pick(i, LOAN_TYPES) for i in ("o_orderkey % 8", "(o_orderkey + 3) % 8", "(o_orderkey * 5 + 1) % 8")
    )
    return f"""
    SELECT {CUSTOMER} AS Customer_ID,
           concat(CAST(CAST(o_totalprice AS DECIMAL(14, 2)) AS STRING),
                  CASE WHEN o_orderkey % 7 = 0 THEN '_' ELSE '' END) AS Annual_Income,
           o_totalprice / 12 AS Monthly_Inhand_Salary,
           CAST(o_orderkey % 11 AS INT) AS Num_Bank_Accounts,
           CAST(o_orderkey % 9 AS INT) AS Num_Credit_Card,
           CAST(1 + o_orderkey % 34 AS INT) AS Interest_Rate,
           CASE o_orderkey % 40 WHEN 0 THEN '-100' WHEN 1 THEN '-100_'
                WHEN 2 THEN concat(o_orderkey % 9, '_') ELSE concat(o_orderkey % 9, '') END AS Num_of_Loan,
           CASE WHEN o_orderkey % 13 = 0 THEN 'Not Specified'
                WHEN o_orderkey % 3 = 0 THEN {first}
                WHEN o_orderkey % 3 = 1 THEN concat({first}, ', and ', {second})
                ELSE concat({first}, ', ', {third}, ', and ', {first}) END AS Type_of_Loan,
           CAST(o_orderkey % 63 AS INT) AS Delay_from_due_date,
           concat(o_orderkey % 28, CASE WHEN o_orderkey % 10 = 0 THEN '_' ELSE '' END) AS Num_of_Delayed_Payment,
           CASE WHEN o_orderkey % 50 = 0 THEN '_'
                ELSE concat(o_orderkey % 30, '.', o_orderkey % 10) END AS Changed_Credit_Limit,
           CAST(o_orderkey % 17 AS INT) AS Num_Credit_Inquiries,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Bad' WHEN '2-HIGH' THEN 'Standard'
                WHEN '3-MEDIUM' THEN 'Good' WHEN '4-NOT SPECIFIED' THEN 'Standard'
                ELSE CASE WHEN o_orderkey % 5 = 0 THEN '_' ELSE 'Good' END END AS Credit_Mix,
           concat(o_orderkey % 5000, '.', 10 + o_orderkey % 90,
                  CASE WHEN o_orderkey % 41 = 0 THEN '_' ELSE '' END) AS Outstanding_Debt,
           20 + CAST(o_orderkey % 3000 AS DOUBLE) / 100 AS Credit_Utilization_Ratio,
           CASE WHEN o_orderkey % 25 = 0 THEN 'NA'
                ELSE concat(o_orderkey % 30, ' Years and ', o_orderkey % 12, ' Months') END AS Credit_History_Age,
           CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No'
                ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'NM' ELSE 'Yes' END END AS Payment_of_Min_Amount,
           CAST(o_orderkey % 1000 AS DOUBLE) / 10
                * CASE WHEN o_orderkey % 97 = 0 THEN 100 ELSE 1 END AS Total_EMI_per_month,
           CASE WHEN o_orderkey % 60 = 0 THEN '__10000__'
                ELSE concat(o_orderkey % 700, '.5') END AS Amount_invested_monthly,
           CASE WHEN o_orderkey % 33 = 0 THEN '!@9#%8'
                ELSE concat(CASE WHEN o_orderkey % 2 = 0 THEN 'High' ELSE 'Low' END, '_spent_',
                            {_pick('o_orderkey % 3', ['Small', 'Medium', 'Large'])},
                            '_value_payments') END AS Payment_Behaviour,
           concat(o_orderkey % 900, '.25') AS Monthly_Balance,
           'orders' AS _metadata_file_name,
           {ORDER_MONTH} AS date,
           {ORDER_MONTH} AS snapshot_date
    FROM {{orders}}"""


def attributes_sql() -> str:
    """Attributes of a customer per order: the age grows, some numbers are malformed."""
    return f"""
    SELECT {CUSTOMER} AS Customer_ID,
           c_name AS Name,
           concat(18 + o_custkey % 60 + CAST(floor((year(o_orderdate) - 1995) / 4) AS INT),
                  CASE WHEN o_custkey % 9 = 0 THEN '_' ELSE '' END) AS Age,
           CASE WHEN o_custkey % 37 = 0 THEN '#F%$D@*&8'
                ELSE concat(lpad(CAST(o_custkey % 1000 AS STRING), 3, '0'), '-',
                            lpad(CAST(o_custkey % 100 AS STRING), 2, '0'), '-',
                            lpad(CAST(o_custkey % 10000 AS STRING), 4, '0')) END AS SSN,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'employed' ELSE c_mktsegment END AS Occupation,
           'customer' AS _metadata_file_name,
           {ORDER_MONTH} AS date,
           {ORDER_MONTH} AS snapshot_date
    FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey"""


EVENT_TYPES = ["click", "view", "error", "signup", "purchase"]


CLICK_DAY = "CAST(ts AS DATE)"
CLICK_MONTH = "CAST(date_trunc('month', ts) AS DATE)"


def clickstream_sql(snapshot: str = CLICK_DAY) -> str:
    """Events of a user and snapshot, counted by type and quarter of the day into 20 features."""
    features = ",\n           ".join(
        f"CAST(count(CASE WHEN event_type = '{t}' AND hour(ts) >= {6 * q} AND hour(ts) < {6 * q + 6}"
        f" THEN 1 END) AS INT) AS fe_{4 * i + q + 1}"
        for i, t in enumerate(EVENT_TYPES)
        for q in range(4)
    )
    return f"""
    SELECT {features},
           concat(' CUS_', user_id, ' ') AS Customer_ID,
           'events' AS _metadata_file_name,
           {snapshot} AS date,
           {snapshot} AS snapshot_date
    FROM {{events}} GROUP BY user_id, {snapshot}"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derive(spark: SparkSession, sf_dir: str, sql: str, *tables: str, **scans: DataFrame) -> DataFrame:
    return spark.sql(sql, **scans, **{t: table(spark, sf_dir, t) for t in tables})


def _spread_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dealt out evenly while they are narrow: a file of one row group is read by one
    task, which would write all the text, too."""
    return table(spark, sf_dir, "orders").hint("rebalance")


def raw_loans(spark: SparkSession, sf_dir: str, snapshot: str = SHIP_MONTH) -> DataFrame:
    return _derive(spark, sf_dir, loans_sql(snapshot), "lineitem", "orders")


def raw_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, financials_sql(), orders=_spread_orders(spark, sf_dir))


def raw_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, attributes_sql(), "orders", "customer")


def raw_clickstream(spark: SparkSession, sf_dir: str, snapshot: str = CLICK_DAY) -> DataFrame:
    return _derive(spark, sf_dir, clickstream_sql(snapshot), "events")
