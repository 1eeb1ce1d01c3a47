"""SQL equivalents of the workload queries, for DuckDB on the same tables.

Each oracle is one statement made of named layers (raw, cleaned, mart), which are written
independently of the Spark operators.
"""

from __future__ import annotations

from lendstrata.sources.specs import CLEAN_FINANCIALS, LINEAGE, LOAD_DATE, LOAN_TYPES, RAW_ATTRIBUTES, RAW_FINANCIALS, RAW_LOANS
from lendstrata.workload import inputs

TABLES = ("lineitem", "orders", "customer", "events")


def _on_views(sql: str) -> str:
    return sql.format(**{t: t for t in TABLES})


def _key(c: str = "Customer_ID") -> str:
    return f"trim(lower({c}))"


def _float(c: str) -> str:
    return f"TRY_CAST(replace({c}, '_', '') AS FLOAT)"


def _plain_float(c: str) -> str:
    return f"CASE WHEN strpos({c}, '_') = 0 THEN TRY_CAST({c} AS FLOAT) END"


def _int(c: str) -> str:
    return rf"TRY_CAST(regexp_extract(replace({c}, '_', ''), '^\s*([+-]?\d+)(\.\d*)?\s*$', 1) AS INTEGER)"


def _nonnegative_int(c: str) -> str:
    return f"CASE WHEN {_int(c)} >= 0 THEN {_int(c)} END"


def _history(unit: str, c: str = "Credit_History_Age") -> str:
    return rf"TRY_CAST(regexp_extract({c}, '(\d+) {unit}', 1) AS INTEGER)"


def _items(c: str = "Type_of_Loan") -> str:
    return rf"list_distinct(string_split_regex(regexp_replace({c}, ',\s*and\s*', ',', 'g'), ',\s*'))"


def _two_digit_year(c: str) -> str:
    """A year written with two digits is read as 20yy."""
    return f"CASE WHEN {c} < DATE '2000-01-01' THEN CAST({c} + INTERVAL 100 YEAR AS DATE) ELSE {c} END"


FLAGS = {'"Has_' + t.replace(" ", "_") + '"': t for t in LOAN_TYPES}
FLAG_COLUMNS = ",\n           ".join(
    f"CAST(list_contains({_items()}, '{t}') AS INTEGER) AS {flag}" for flag, t in FLAGS.items()
)
CREDIT_MIX = "CASE Credit_Mix WHEN 'Standard' THEN 2 WHEN 'Good' THEN 1 WHEN 'Bad' THEN 0 END"
MIN_PAYMENT = "CASE Payment_of_Min_Amount WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END"
BEHAVIOUR = "CASE WHEN Payment_Behaviour = '!@9#%8' THEN 'unknown' ELSE Payment_Behaviour END"
SSN = r"CASE WHEN regexp_full_match(SSN, '\d{3}-\d{2}-\d{4}') THEN SSN END"

LAYERS: dict[str, str] = {
    "raw_loans": _on_views(inputs.loans_sql()),
    "raw_loans_daily": _on_views(inputs.loans_sql(inputs.SHIP_DAY)),
    "raw_financials": _on_views(inputs.financials_sql()),
    "raw_attributes": _on_views(inputs.attributes_sql()),
    "raw_clicks": _on_views(inputs.clickstream_sql()),
    "typed_financials": f"""
    SELECT {_key()} AS Customer_ID,
           {_float('Annual_Income')} AS Annual_Income,
           CAST(Monthly_Inhand_Salary AS FLOAT) AS Monthly_Inhand_Salary,
           Num_Bank_Accounts, Num_Credit_Card, Interest_Rate,
           {_nonnegative_int('Num_of_Loan')} AS Num_of_Loan,
           Delay_from_due_date,
           {_float('Num_of_Delayed_Payment')} AS Num_of_Delayed_Payment,
           {_plain_float('Changed_Credit_Limit')} AS Changed_Credit_Limit,
           Num_Credit_Inquiries,
           {CREDIT_MIX} AS Credit_Mix,
           {_plain_float('Outstanding_Debt')} AS Outstanding_Debt,
           CAST(Credit_Utilization_Ratio AS FLOAT) AS Credit_Utilization_Ratio,
           {MIN_PAYMENT} AS Payment_of_Min_Amount,
           CAST(Total_EMI_per_month AS FLOAT) AS Total_EMI_per_month,
           {_plain_float('Amount_invested_monthly')} AS Amount_invested_monthly,
           {BEHAVIOUR} AS Payment_Behaviour,
           {_plain_float('Monthly_Balance')} AS Monthly_Balance,
           _metadata_file_name, snapshot_date,
           {_history('Years')} AS Credit_History_Years,
           {_history('Months')} AS Credit_History_Months,
           {FLAG_COLUMNS}
    FROM raw_financials""",
    "financials": """
    SELECT * FROM typed_financials
    WHERE COLUMNS(*) IS NOT NULL""",
    "attributes": f"""
    SELECT * FROM (
        SELECT {_key()} AS Customer_ID, Name, {_int('Age')} AS Age, {SSN} AS SSN, Occupation,
               _metadata_file_name, snapshot_date
        FROM raw_attributes)
    WHERE COLUMNS(*) IS NOT NULL""",
    "clicks": f"SELECT * EXCLUDE (date) REPLACE ({_key()} AS Customer_ID) FROM raw_clicks",
}


def _loans(raw: str) -> str:
    return f"""
    SELECT loan_id, {_key()} AS Customer_ID, loan_start_date, tenure, installment_num,
           CAST(loan_amt AS FLOAT) AS loan_amt, CAST(due_amt AS FLOAT) AS due_amt,
           CAST(paid_amt AS FLOAT) AS paid_amt, CAST(overdue_amt AS FLOAT) AS overdue_amt,
           CAST(balance AS FLOAT) AS balance, _metadata_file_name, snapshot_date
    FROM {raw} WHERE balance IS NOT NULL"""


def _fact_loan(loans: str) -> str:
    return f"""
    SELECT loan_id, Customer_ID AS customer_id, installment_num AS mob, missed AS installments_missed,
           first_missed_date,
           CASE WHEN overdue_amt > 0
                THEN CAST(date_diff('day', first_missed_date, snapshot_date) AS INTEGER) ELSE 0 END AS dpd,
           snapshot_date, loan_start_date, tenure, loan_amt, due_amt, paid_amt, overdue_amt, balance
    FROM (SELECT *, CASE WHEN missed > 0
                         THEN CAST(snapshot_date - to_months(missed) AS DATE) END AS first_missed_date
          FROM (SELECT *, CASE WHEN due_amt > 0
                               THEN CAST(ceil(CAST(overdue_amt AS DOUBLE) / CAST(due_amt AS DOUBLE)) AS INTEGER)
                               ELSE 0 END AS missed
                FROM {loans}))"""


LAYERS |= {
    "loans": _loans("raw_loans"),
    "loans_daily": _loans("raw_loans_daily"),
    "fact_loan": _fact_loan("loans"),
    "fact_loan_daily": _fact_loan("loans_daily"),
    "dim_customer": "SELECT DISTINCT Customer_ID AS customer_id, SSN, Name, Age, Occupation FROM attributes",
    "dim_credit_mix": "SELECT DISTINCT Credit_Mix AS credit_mix_id FROM financials",
    "dim_min_payment": "SELECT DISTINCT Payment_of_Min_Amount AS payment_code FROM financials",
    "dim_payment_behaviour": """
    SELECT DISTINCT Payment_Behaviour AS payment_behaviour_id,
           string_split(Payment_Behaviour, '_')[1] AS spend, string_split(Payment_Behaviour, '_')[3] AS value
    FROM financials""",
    "dim_feature": "SELECT i AS feature_id, concat('fe_', i) AS feature_name FROM range(1, 21) r(i)",
    "dim_loan_type": "SELECT * FROM (VALUES "
    + ", ".join(
        f"(CAST({i} AS BIGINT), '{flag.strip(chr(34))}', '{flag.strip(chr(34)).removeprefix('Has_')}')"
        for i, flag in enumerate(FLAGS, start=1)
    )
    + ") v(loan_type_id, loan_flag_col, loan_type_name)",
    "dim_snapshot": """
    SELECT snapshot_date FROM loans UNION SELECT snapshot_date FROM clicks
    UNION SELECT snapshot_date FROM attributes UNION SELECT snapshot_date FROM financials""",
    "fact_clickstream": """
    SELECT Customer_ID AS customer_id, feature_id, value, snapshot_date
    FROM (UNPIVOT clicks ON COLUMNS('fe_.*') INTO NAME feature_name VALUE value)
    LEFT JOIN dim_feature USING (feature_name)""",
    "fact_financials": """
    SELECT Customer_ID AS customer_id, snapshot_date, Annual_Income, Monthly_Inhand_Salary,
           Num_Bank_Accounts, Num_Credit_Card, Interest_Rate, Num_of_Loan, Delay_from_due_date,
           Num_of_Delayed_Payment, Changed_Credit_Limit, Num_Credit_Inquiries, Outstanding_Debt,
           Credit_Utilization_Ratio, Total_EMI_per_month, Amount_invested_monthly,
           Payment_of_Min_Amount AS payment_code, Payment_Behaviour AS payment_behaviour_id,
           Credit_Mix AS credit_mix_id, Credit_History_Years, Credit_History_Months
    FROM financials""",
    "fact_customer_loan_type": """
    SELECT Customer_ID AS customer_id, loan_type_id, snapshot_date
    FROM (UNPIVOT (SELECT Customer_ID, snapshot_date, COLUMNS('Has_.*') FROM financials)
          ON COLUMNS('Has_.*') INTO NAME loan_flag_col VALUE flag)
    LEFT JOIN dim_loan_type USING (loan_flag_col)
    WHERE flag = 1""",
    "balanced": "SELECT *, Monthly_Inhand_Salary - Total_EMI_per_month AS Monthly_Balance FROM fact_financials",
    "star_rows": """
    SELECT * FROM fact_loan JOIN balanced USING (customer_id, snapshot_date)
    LEFT JOIN fact_customer_loan_type USING (customer_id, snapshot_date)
    JOIN dim_customer USING (customer_id)
    LEFT JOIN dim_credit_mix USING (credit_mix_id)
    LEFT JOIN dim_payment_behaviour USING (payment_behaviour_id)
    LEFT JOIN dim_min_payment USING (payment_code)
    LEFT JOIN dim_loan_type USING (loan_type_id)""",
    "loan_rows": """
    SELECT * FROM fact_loan JOIN balanced USING (customer_id, snapshot_date)
    JOIN dim_customer USING (customer_id)""",
}

NEEDS: dict[str, list[str]] = {
    "typed_financials": ["raw_financials"],
    "financials": ["typed_financials"],
    "attributes": ["raw_attributes"],
    "clicks": ["raw_clicks"],
    "loans": ["raw_loans"],
    "loans_daily": ["raw_loans_daily"],
    "fact_loan": ["loans"],
    "fact_loan_daily": ["loans_daily"],
    "dim_customer": ["attributes"],
    "dim_credit_mix": ["financials"],
    "dim_min_payment": ["financials"],
    "dim_payment_behaviour": ["financials"],
    "dim_snapshot": ["loans", "clicks", "attributes", "financials"],
    "fact_clickstream": ["clicks", "dim_feature"],
    "fact_financials": ["financials"],
    "fact_customer_loan_type": ["financials", "dim_loan_type"],
    "balanced": ["fact_financials"],
    "star_rows": [
        "fact_loan",
        "balanced",
        "fact_customer_loan_type",
        "dim_customer",
        "dim_credit_mix",
        "dim_payment_behaviour",
        "dim_min_payment",
        "dim_loan_type",
    ],
    "loan_rows": ["fact_loan", "balanced", "dim_customer"],
}


def _with(
    layers: list[str],
    select: str,
    extra: dict[str, str] | None = None,
    instead: dict[str, str] | None = None,
) -> str:
    """``select`` over the layers it names, preceded by all they build on."""
    order: list[str] = []

    def visit(name: str) -> None:
        for below in NEEDS.get(name, []):
            visit(below)
        if name not in order:
            order.append(name)

    for name in layers:
        visit(name)
    parts = {n: (instead or {}).get(n, LAYERS[n]) for n in order} | (extra or {})
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in parts.items()) + f"\n{select}"


def _layer(name: str) -> str:
    return _with([name], f"SELECT * FROM {name}")


# The columns whose outliers the star leaves out.
OUTLIERS = [
    "Age", "Interest_Rate", "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan",
    "Num_of_Delayed_Payment", "Num_Credit_Inquiries", "Total_EMI_per_month",
    "Amount_invested_monthly", "Monthly_Balance", "Annual_Income", "Outstanding_Debt",
    "Monthly_Inhand_Salary",
]


def _iqr(rows: str, columns: list[str], k: float) -> dict[str, str]:
    """Quartiles, fences and the kept rows of ``rows`` as further layers."""
    quartiles = ", ".join(
        f"quantile_disc(CAST({c} AS DOUBLE), {p}) AS {c}_q{q}" for c in columns for q, p in ((1, 0.25), (3, 0.75))
    )
    inside = " AND ".join(
        f"CAST({c} AS DOUBLE) BETWEEN {c}_q1 - CAST({k} AS DOUBLE) * ({c}_q3 - {c}_q1)"
        f" AND {c}_q3 + CAST({k} AS DOUBLE) * ({c}_q3 - {c}_q1)"
        for c in columns
    )
    return {
        "quartiles": f"SELECT {quartiles} FROM {rows}",
        "kept": f"SELECT {rows}.* FROM {rows}, quartiles WHERE {inside}",
    }


def _log(c: str, digits: int = 6) -> str:
    return f"round(CASE WHEN {c} > -1 THEN ln(1 + CAST({c} AS DOUBLE)) END, {digits})"


def _ratio(num: str, den: str) -> str:
    return f"round(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0 END, 6)"


STAR_SELECT = f"""
SELECT customer_id, Name, Age, CAST(Credit_Utilization_Ratio AS DOUBLE) AS Credit_Utilization_Ratio,
       Credit_History_Years, Credit_History_Months,
       {_log('Annual_Income')} AS Annual_Income_Log,
       {_log('Outstanding_Debt')} AS Outstanding_Debt_Log,
       {_log('Total_EMI_per_month')} AS Total_EMI_per_month_Log,
       {_log('Amount_invested_monthly')} AS Amount_invested_monthly_Log,
       {_log('Num_Credit_Inquiries')} AS Num_Credit_Inquiries_Log,
       {_log('(CAST(Monthly_Balance AS DOUBLE) - (SELECT CAST(min(Monthly_Balance) AS DOUBLE) FROM kept) + 1)')}
           AS Monthly_Balance_Log,
       {_ratio('Outstanding_Debt', 'Annual_Income')} AS Debt_to_Income_Ratio,
       {_ratio('Total_EMI_per_month', 'Monthly_Inhand_Salary')} AS EMI_to_Income_Ratio,
       {_ratio('Amount_invested_monthly', 'Monthly_Inhand_Salary')} AS Invest_to_Income_Ratio,
       {_ratio('Num_Credit_Inquiries', 'Num_of_Loan')} AS Credit_Inquiry_to_Loan_Ratio,
       CASE WHEN Occupation = 'employed' THEN 1 ELSE 0 END AS Is_Employed,
       snapshot_date"""

LABELS = """
SELECT loan_id, customer_id, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
       '30dpd_6mob' AS label_def, snapshot_date
FROM {fact} WHERE mob = 6"""

PRICES = "SELECT o_orderkey, o_custkey, o_totalprice, c_acctbal FROM orders JOIN customer ON o_custkey = c_custkey"


def _content(name: str, keys: str, amounts: str) -> str:
    """Rows of a layer, a sum over hashes of its keys, and the sum of its amounts in hundredths."""
    texts = ", ".join(f"CAST({c} AS VARCHAR)" for c in sorted(keys.split()))
    hundredths = " + ".join(["0", *(f"CAST(floor(CAST({c} AS DOUBLE) * 100) AS BIGINT)" for c in amounts.split())])
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count,
        CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {texts})), 1, 8) AS BIGINT)) AS BIGINT) AS keys,
        CAST(sum({hundredths}) AS BIGINT) AS hundredths FROM {name}"""


HISTORY = """
daily AS (
    SELECT * FROM attributes WHERE month(snapshot_date) % 3 = 1
    QUALIFY row_number() OVER (PARTITION BY Customer_ID, snapshot_date ORDER BY SSN, Name, Age, Occupation) = 1),
starts AS (
    SELECT * FROM daily
    WINDOW w AS (PARTITION BY Customer_ID ORDER BY snapshot_date)
    QUALIFY row_number() OVER w = 1 OR (SSN, Name, Age, Occupation)
            IS DISTINCT FROM (lag(SSN) OVER w, lag(Name) OVER w, lag(Age) OVER w, lag(Occupation) OVER w)),
history AS (
    SELECT Customer_ID AS customer_id, SSN, Name, Age, Occupation, snapshot_date AS valid_from,
           lead(snapshot_date) OVER (PARTITION BY Customer_ID ORDER BY snapshot_date) AS valid_to
    FROM starts)"""


def _after(layers: str, more: str, select: str) -> str:
    """A query over some layers and further ones."""
    return f"{layers}".replace("\nSELECT 0", f",{more}\n{select}")


def _digest_states() -> str:
    return _with(
        ["raw_attributes"],
        """SELECT snapshot_date, CASE WHEN snapshot_date NOT IN (SELECT snapshot_date FROM stored) THEN 'new'
                  WHEN snapshot_date NOT IN (SELECT snapshot_date FROM incoming) THEN 'gone'
                  WHEN snapshot_date IN (SELECT snapshot_date FROM differ) THEN 'changed' ELSE 'same' END AS state,
                  (SELECT CASE WHEN count(*) > 0 THEN count(*) END FROM incoming i WHERE i.snapshot_date = d.snapshot_date) AS row_count
           FROM (SELECT snapshot_date FROM stored UNION SELECT snapshot_date FROM incoming) d""",
        {
            "stored": "SELECT * FROM raw_attributes WHERE snapshot_date <> DATE '1998-01-01'",
            "changed": """SELECT * REPLACE (CASE WHEN snapshot_date = DATE '1997-05-01' THEN upper(Name) ELSE Name END AS Name)
                          FROM raw_attributes WHERE snapshot_date <> DATE '1996-03-01'""",
            "incoming": "SELECT * FROM changed UNION ALL SELECT * FROM changed WHERE snapshot_date = DATE '1995-07-01'",
            "differ": """(SELECT * FROM incoming EXCEPT ALL SELECT * FROM stored)
                         UNION ALL (SELECT * FROM stored EXCEPT ALL SELECT * FROM incoming)""",
        },
    )


def _rejects() -> str:
    salary = "Num_Credit_Inquiries = 16 AND Num_Credit_Card = 8"
    accounts, soon = "Num_Bank_Accounts = 10 AND Interest_Rate % 5 = 0", "Delay_from_due_date = 61"
    return _with(
        ["raw_financials"],
        """SELECT NULL::VARCHAR AS faults, snapshot_date, count(*) AS row_count, CAST(sum(Interest_Rate) AS BIGINT) AS rates
           FROM judged WHERE faults = '' GROUP BY snapshot_date
           UNION ALL SELECT faults, NULL, count(*), NULL FROM judged WHERE faults <> '' GROUP BY faults
           UNION ALL SELECT 'number of fields', NULL, 2, NULL""",
        {
            "judged": f"""SELECT Interest_Rate, {_two_digit_year('snapshot_date')} AS snapshot_date, concat_ws('; ',
                CASE WHEN {salary} THEN 'Monthly_Inhand_Salary is no double: unknown' END,
                CASE WHEN {accounts} THEN 'Num_Bank_Accounts is no int: ten' END,
                CASE WHEN {soon} THEN 'snapshot_date is no date: soon' END) AS faults FROM raw_financials""",
        },
    )


def _inferred() -> str:
    """Types by the text of each value, merged by AND."""
    parts, extra = [], {}
    for source, layer in {
        "lms_loan_daily": "raw_loans",
        "features_financials": "raw_financials",
        "features_attributes": "raw_attributes",
    }.items():
        # the columns as they stand in the file: those of the raw layer without the two added ones
        names = RAW_ORDER[source]
        for i, c in enumerate(names):
            text = f"CAST({c} AS VARCHAR)"
            if c == "snapshot_date" and source == "features_financials":
                text = "strftime(snapshot_date, '%-m/%-d/%y')"
            parts.append(
                f"""SELECT '{source}' AS source, {i} AS position, '{c}' AS column_name, count(t) AS n_values,
                    count(*) - count(t) AS n_nulls,
                    bool_and(regexp_full_match(t, '-?(0|[1-9][0-9]*)')) AS whole,
                    bool_and(try_cast(t AS INTEGER) IS NOT NULL) AS narrow,
                    bool_and(regexp_full_match(t, '-?(0|[1-9][0-9]*)([.][0-9]+)?([eE][-+]?[0-9]+)?')) AS number,
                    bool_and(regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) AS iso,
                    bool_and(regexp_full_match(t, '[0-9]+/[0-9]+/[0-9]{{2}}')) AS us
                    FROM (SELECT nullif(trim({text}), '') AS t FROM {layer})"""
            )
    types = """SELECT source, position, column_name,
        CASE WHEN n_values = 0 THEN 'void' WHEN whole AND narrow THEN 'int' WHEN whole THEN 'bigint'
             WHEN number THEN 'double' WHEN iso OR us THEN 'date' ELSE 'string' END AS data_type,
        CASE WHEN n_values > 0 AND NOT number THEN CASE WHEN iso THEN 'yyyy-MM-dd' WHEN us THEN 'M/d/yy' END END AS date_format,
        n_values, n_nulls FROM found"""
    return _with(["raw_loans", "raw_financials", "raw_attributes"], types, {"found": " UNION ALL ".join(parts)})


#: The columns of each delivered file, in the order of the tables that they are made from.
RAW_ORDER = {
    "lms_loan_daily": [n for n in RAW_LOANS.names if n not in (LINEAGE, LOAD_DATE)],
    "features_financials": [n for n in RAW_FINANCIALS.names if n not in (LINEAGE, LOAD_DATE)],
    "features_attributes": [n for n in RAW_ATTRIBUTES.names if n not in (LINEAGE, LOAD_DATE)],
}


def _audited_columns() -> list[str]:
    return [f'"{c}"' for c in CLEAN_FINANCIALS.names]


def oracle_sql() -> dict[str, str]:
    kept_star = STAR_SELECT + " FROM kept"
    star_iqr = _iqr("star_rows", OUTLIERS, 1.5)
    later = {
        raw: f"""SELECT * REPLACE (CAST(snapshot_date + INTERVAL 120 MONTH AS DATE) AS snapshot_date) FROM ({LAYERS[raw]})"""
        for raw in ("raw_loans", "raw_financials", "raw_attributes")
    } | {"raw_clicks": _on_views(inputs.clickstream_sql(inputs.CLICK_MONTH))}
    loan_terms = "loan_amt due_amt paid_amt overdue_amt balance"
    financial_keys = """Num_Bank_Accounts Num_Credit_Card Interest_Rate Num_of_Loan Delay_from_due_date Num_Credit_Inquiries
        payment_code payment_behaviour_id credit_mix_id Credit_History_Years Credit_History_Months customer_id snapshot_date"""
    financial_amounts = """Annual_Income Monthly_Inhand_Salary Num_of_Delayed_Payment Changed_Credit_Limit Outstanding_Debt
        Credit_Utilization_Ratio Total_EMI_per_month Amount_invested_monthly"""
    mart = {
        "dim_snapshot": ("snapshot_date", ""),
        "dim_customer": ("customer_id SSN Name Age Occupation", ""),
        "dim_feature": ("feature_id feature_name", ""),
        "dim_credit_mix": ("credit_mix_id", ""),
        "dim_payment_behaviour": ("payment_behaviour_id spend value", ""),
        "dim_min_payment": ("payment_code", ""),
        "dim_loan_type": ("loan_type_id loan_flag_col loan_type_name", ""),
        "fact_clickstream": ("customer_id feature_id value snapshot_date", ""),
        "fact_financials": (financial_keys, financial_amounts),
        "fact_loan": (
            "loan_id customer_id mob installments_missed first_missed_date dpd snapshot_date loan_start_date tenure",
            loan_terms,
        ),
        "fact_customer_loan_type": ("customer_id loan_type_id snapshot_date", ""),
    }
    return {
        # sources and snapshots
        "month_spine": """
            SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate),
                   INTERVAL 1 MONTH)) AS DATE) AS snapshot_date FROM orders""",
        "ingest_csv_roundtrip": _with(
            ["raw_financials"],
            f"""SELECT * REPLACE ('raw.csv' AS _metadata_file_name, {_two_digit_year('date')} AS date, {_two_digit_year('snapshot_date')} AS snapshot_date)
                FROM raw_financials""",
        ),
        "list_csv_sources": """
            SELECT 'features_attributes' AS source, count(*) AS row_count
            FROM orders JOIN customer ON o_custkey = c_custkey
            UNION ALL SELECT 'features_financials', count(*) FROM orders""",
        "snapshot_slice": """
            SELECT o_orderkey, o_custkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date
            FROM orders WHERE date_trunc('month', o_orderdate) IN (DATE '1996-01-01', DATE '1998-06-01')""",
        "snapshot_audit": _with(
            ["typed_financials"],
            """SELECT snapshot_date, count(*) AS row_count,
                      CAST(count_if(Annual_Income IS NULL) AS BIGINT) AS null_Annual_Income,
                      CAST(count_if(Num_of_Loan IS NULL) AS BIGINT) AS null_Num_of_Loan,
                      CAST(count_if(Credit_Mix IS NULL) AS BIGINT) AS null_Credit_Mix,
                      CAST(count_if(Outstanding_Debt IS NULL) AS BIGINT) AS null_Outstanding_Debt,
                      CAST(count_if(Payment_of_Min_Amount IS NULL) AS BIGINT) AS null_Payment_of_Min_Amount,
                      CAST(count_if(Credit_History_Years IS NULL) AS BIGINT) AS null_Credit_History_Years
               FROM typed_financials GROUP BY snapshot_date""",
        ),
        "feature_store_snapshot": """
            SELECT CAST(o_custkey AS BIGINT) AS customer_key, count(*) AS n_orders,
                   CAST(max(o_totalprice) AS DOUBLE) AS largest_order, DATE '1997-03-01' AS snapshot_date
            FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1997-03-01' GROUP BY o_custkey""",
        "feature_store_write": """
            SELECT c_custkey AS customer_key, c_acctbal, DATE '2024-01-01' AS snapshot_date FROM customer""",
        "observed_audit": _with(
            ["typed_financials"],
            f"""UNPIVOT (SELECT count(*) AS rows, {', '.join(f'CAST(count_if({c} IS NULL) AS BIGINT) AS "null_{c.strip(chr(34))}"' for c in _audited_columns())}
                         FROM typed_financials) ON COLUMNS(*) INTO NAME figure VALUE row_count""",
        ),
        "row_digests": """
            SELECT o_orderkey, o_custkey, o_orderstatus,
                   sha256(format('{{"o_orderkey":{},"o_custkey":{},"o_orderstatus":"{}"}}',
                                 o_orderkey, o_custkey, o_orderstatus)) AS digest FROM orders""",
        "ingest_with_rejects": _rejects(),
        "inferred_contract": _inferred(),
        "snapshot_digests": _digest_states(),
        "profile_drift": """
            WITH months AS (
                SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, o_orderstatus,
                       CASE WHEN o_orderkey % 10 > 0 THEN o_orderpriority END AS o_orderpriority,
                       CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders),
            long AS (
                SELECT snapshot_date, 'o_orderstatus' AS column_name, o_orderstatus AS v FROM months
                UNION ALL SELECT snapshot_date, 'o_orderpriority', o_orderpriority FROM months
                UNION ALL SELECT snapshot_date, 'o_custkey', o_custkey FROM months),
            figures AS (
                SELECT snapshot_date, column_name, count(*) AS row_count, 1 - count(v) / count(*) AS null_share,
                       count(v) AS held, count(DISTINCT v) AS n_distinct,
                       row_number() OVER (PARTITION BY column_name ORDER BY snapshot_date) AS nth
                FROM long GROUP BY snapshot_date, column_name),
            shares AS (
                SELECT column_name, nth, v, count(*) / held AS share
                FROM long JOIN figures USING (snapshot_date, column_name) WHERE v IS NOT NULL
                GROUP BY column_name, nth, v, held),
            shifts AS (
                SELECT column_name, nth, sum(abs(change)) / 2 AS shift FROM (
                    SELECT column_name, nth, v, sum(share) AS change FROM (
                        SELECT column_name, nth, v, share FROM shares
                        UNION ALL SELECT column_name, nth + 1, v, -share FROM shares) GROUP BY ALL) GROUP BY ALL)
            SELECT f.snapshot_date, f.column_name, f.row_count, round(f.null_share, 9) AS null_share,
                   round(b.null_share, 9) AS null_share_before,
                   CASE WHEN f.column_name <> 'o_custkey' AND b.nth IS NOT NULL THEN round(s.shift, 9) END AS value_shift,
                   CASE WHEN f.column_name <> 'o_custkey' THEN f.n_distinct END AS n_distinct,
                   CASE WHEN f.column_name = 'o_custkey' THEN true END AS within_error
            FROM figures f LEFT JOIN figures b ON b.column_name = f.column_name AND b.nth = f.nth - 1
            LEFT JOIN shifts s ON s.column_name = f.column_name AND s.nth = f.nth""",
        # contracts and incremental load
        "conform_columns": "SELECT c_custkey, c_mktsegment, c_name, c_acctbal FROM customer",
        "row_fingerprint_intersect": """
            SELECT concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus)
                   AS fingerprint FROM lineitem WHERE l_shipdate >= DATE '1997-01-01'
            INTERSECT
            SELECT concat_ws('_', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus)
            FROM lineitem WHERE l_shipdate < DATE '1999-01-01'""",
        "load_state": """
            WITH incoming AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
                 stored AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
                            WHERE l_shipdate < DATE '1999-01-01')
            SELECT (SELECT count(*) FROM incoming) AS incoming_rows,
                   (SELECT count(*) FROM incoming JOIN stored USING (l_orderkey, l_linenumber)) AS stored_rows,
                   (SELECT count(*) FROM incoming ANTI JOIN stored USING (l_orderkey, l_linenumber)) = 0
                       AS already_loaded""",
        "new_rows_anti": """
            SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem a
            WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_shipdate < DATE '1999-01-01'
                              AND a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
                              AND a.l_returnflag = b.l_returnflag)""",
        "missing_snapshots": """
            WITH spine AS (SELECT CAST(unnest(generate_series(date_trunc('month', min(l_shipdate)),
                           max(l_shipdate), INTERVAL 1 MONTH)) AS DATE) AS snapshot_date FROM lineitem)
            SELECT snapshot_date FROM spine
            WHERE snapshot_date NOT IN (SELECT date_trunc('month', o_orderdate) FROM orders)""",
        "incremental_load": _layer("attributes"),
        "stream_refresh": _layer("attributes"),
        # cleaning, one rule at a time
        "strip_and_cast": _with(
            ["raw_financials", "raw_attributes"],
            f"""SELECT Annual_Income AS source_text, {_float('Annual_Income')} AS as_float,
                       {_int('Annual_Income')} AS as_int, {_plain_float('Outstanding_Debt')} AS plain_float
                FROM raw_financials
                UNION ALL SELECT Age, {_float('Age')}, {_int('Age')}, {_plain_float('Age')} FROM raw_attributes""",
        ),
        "normalise_key": f"SELECT c_custkey, {_key('c_name')} AS name_key FROM customer",
        "parse_dates": f"""
            SELECT o_orderkey, {_two_digit_year("CAST(try_strptime(us, '%m/%d/%y') AS DATE)")} AS from_us,
                   CAST(try_strptime(iso, '%Y-%m-%d') AS DATE) AS from_iso
            FROM (SELECT o_orderkey,
                         CASE WHEN o_orderkey % 11 = 0 THEN '13/45/23' ELSE strftime(o_orderdate, '%-m/%-d/%y') END AS us,
                         CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso
                  FROM orders)""",
        "negative_to_null": "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer",
        "sentinel_replace": """
            SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
                                    ELSE o_orderpriority END AS priority FROM orders""",
        "history_age_parse": _with(
            ["raw_financials"],
            f"""SELECT Credit_History_Age AS history, {_history('Years')} AS years, {_history('Months')} AS months
                FROM raw_financials""",
        ),
        "list_multi_hot": _with(
            ["raw_financials"],
            f"SELECT CAST(len({_items()}) AS INTEGER) AS n_items, {FLAG_COLUMNS} FROM raw_financials",
        ),
        "ordinal_encode": _with(
            ["raw_financials"],
            f"""SELECT Credit_Mix AS mix_text, {CREDIT_MIX} AS mix, Payment_of_Min_Amount AS payment_text,
                       {MIN_PAYMENT} AS payment FROM raw_financials""",
        ),
        "format_validity": _with(["raw_attributes"], f"SELECT Name AS name, {SSN} AS ssn FROM raw_attributes"),
        "complete_cases": _with(
            ["raw_loans"], "SELECT loan_id, tenure, balance FROM raw_loans WHERE balance IS NOT NULL"
        ),
        # source cleaners
        "clean_loans": _layer("loans"),
        "clean_financials": _layer("financials"),
        "clean_attributes": _layer("attributes"),
        "clean_clickstream": _layer("clicks"),
        # mart
        "dim_snapshot": _layer("dim_snapshot"),
        "dim_customer": _layer("dim_customer"),
        "dim_customer_history": _after(_with(["attributes"], "SELECT 0"), HISTORY, "SELECT * FROM history"),
        "dim_feature": _with(
            ["fact_clickstream"],
            """SELECT feature_id, feature_name, CAST(count(*) AS BIGINT) AS row_count,
                      CAST(sum(value) AS BIGINT) AS total
               FROM dim_feature JOIN fact_clickstream USING (feature_id) GROUP BY ALL""",
        ),
        "dim_credit_mix": _layer("dim_credit_mix"),
        "dim_min_payment": _layer("dim_min_payment"),
        "dim_payment_behaviour": _layer("dim_payment_behaviour"),
        "dim_loan_type": _with(
            ["fact_customer_loan_type"],
            """SELECT loan_type_id, loan_flag_col, loan_type_name, count(*) AS holders
               FROM dim_loan_type JOIN fact_customer_loan_type USING (loan_type_id) GROUP BY ALL""",
        ),
        "fact_clickstream": _layer("fact_clickstream"),
        "fact_financials": _layer("fact_financials"),
        "fact_loan": _layer("fact_loan_daily"),
        "fact_customer_loan_type": _layer("fact_customer_loan_type"),
        # gold
        "label_store": _with(["fact_loan_daily"], LABELS.format(fact="fact_loan_daily")),
        "derived_balance": _with(
            ["balanced"], "SELECT customer_id, snapshot_date, Monthly_Balance FROM balanced"
        ),
        "star_joins": _with(
            ["star_rows"],
            """SELECT loan_id, customer_id, snapshot_date, mob, dpd, Name, Age, Monthly_Balance,
                      credit_mix_id, payment_code, spend, value, loan_type_id, loan_type_name
               FROM star_rows""",
        ),
        "star_fan_out": _with(
            ["star_rows"],
            "SELECT customer_id, snapshot_date, count(*) AS copies FROM star_rows GROUP BY ALL",
        ),
        "star_bucketed": _with(
            ["star_rows"],
            "SELECT customer_id, snapshot_date, count(*) AS copies FROM star_rows GROUP BY ALL",
        ),
        "star_as_of": _after(
            _with(["attributes", "balanced"], "SELECT 0"),
            HISTORY,
            """SELECT b.customer_id, snapshot_date, Monthly_Balance, Interest_Rate, SSN, Name, Age, Occupation, valid_from
               FROM balanced b ASOF JOIN history h ON b.customer_id = h.customer_id AND b.snapshot_date >= h.valid_from""",
        ),
        "iqr_filter": f"WITH prices AS ({PRICES}), "
        + ", ".join(f"{n} AS ({s})" for n, s in _iqr("prices", ["o_totalprice", "c_acctbal"], 0.5).items())
        + " SELECT * FROM kept",
        "iqr_bounds": f"""
            WITH prices AS ({PRICES}), quartiles AS (
                SELECT quantile_disc(o_totalprice, 0.25) AS q1, quantile_disc(o_totalprice, 0.75) AS q3 FROM prices)
            SELECT q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS price_lower,
                   q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS price_upper FROM quartiles""",
        "quartile_ranks": f"""
            WITH prices AS ({PRICES})
            SELECT column_name, quartile, count(*) > 0 AS within_error
            FROM prices, (VALUES ('o_totalprice', 0.25::DOUBLE), ('o_totalprice', 0.75), ('c_acctbal', 0.25), ('c_acctbal', 0.75))
                 q(column_name, quartile) GROUP BY ALL""",
        "sketch_quartiles": f"""
            WITH prices AS ({PRICES})
            SELECT kept, column_name, quartile, count(*) > 0 AS within_error
            FROM prices, (VALUES ('month'), ('all')) k(kept),
                 (VALUES ('o_totalprice', 0.25::DOUBLE), ('o_totalprice', 0.75), ('c_acctbal', 0.25), ('c_acctbal', 0.75))
                 q(column_name, quartile) GROUP BY ALL""",
        "log_features": f"""
            WITH prices AS ({PRICES})
            SELECT o_orderkey, {_log('o_totalprice')} AS o_totalprice_Log,
                   {_log('(c_acctbal - (SELECT min(c_acctbal) FROM prices) + 1)')} AS c_acctbal_Log
            FROM prices""",
        "safe_ratios": f"""
            WITH prices AS ({PRICES})
            SELECT o_orderkey, {_ratio('o_totalprice', 'c_acctbal')} AS price_to_balance,
                   {_ratio('c_acctbal', 'o_totalprice')} AS balance_to_price FROM prices""",
        "is_employed": """
            SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS is_employed FROM customer""",
        "drop_collinear": _with(
            ["balanced"],
            """SELECT * EXCLUDE (Annual_Income, Monthly_Inhand_Salary, Monthly_Balance, Amount_invested_monthly,
                      Outstanding_Debt, Total_EMI_per_month) FROM balanced""",
        ),
        "loan_analytics_star": _with(["star_rows"], kept_star, star_iqr),
        "medallion_run": _with(["star_rows"], kept_star, star_iqr, later),
        "incremental_run": _with(["star_rows"], kept_star, star_iqr, later),
        "medallion_labels": _with(["fact_loan"], LABELS.format(fact="fact_loan"), instead=later),
        "medallion_mart": _with(list(mart), " UNION ALL ".join(_content(name, *mart[name]) for name in mart), instead=later),
        "reload_withdrawn": _with(
            ["attributes"],
            """SELECT * EXCLUDE (_metadata_file_name) FROM attributes
               WHERE snapshot_date NOT IN (DATE '2006-03-01', DATE '2007-05-01')""",
            instead=later,
        ),
        "loan_analytics_star_by_loan": _with(
            ["loan_rows"],
            kept_star.replace("SELECT customer_id", "SELECT loan_id, customer_id", 1),
            _iqr("loan_rows", OUTLIERS, 1.5),
        ),
    }
