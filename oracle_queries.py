"""DuckDB SQL for the registered queries, written apart from the Spark code.

Each query is a list of common table expressions followed by a select. ``try_cast`` rounds decimals in DuckDB, so the
tail of a decimal is cut by a pattern before it is read as a whole number.
"""

_FEATURES = [f"fe_{n}" for n in range(1, 21)]
_MONEY = ["Annual_Income", "Changed_Credit_Limit", "Outstanding_Debt", "Amount_invested_monthly", "Monthly_Balance"]
_DECIMALS = ["Monthly_Inhand_Salary", "Num_Credit_Inquiries", "Credit_Utilization_Ratio", "Total_EMI_per_month"]
_WHOLE = ["Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Delay_from_due_date"]
_BLANKABLE = ["Num_of_Loan", "Num_of_Delayed_Payment"]
_FINANCIAL_FEATURES = [
    "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
    "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix",
    "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age_Years", "Payment_of_Min_Amount",
    "Total_EMI_per_month", "Amount_invested_monthly", "Payment_Behaviour", "Monthly_Balance",
]
_FINANCIAL_TEXTS = ["Type_of_Loan", "Credit_Mix", "Credit_History_Age", "Payment_of_Min_Amount", "Payment_Behaviour"]
_TEXT_FEATURES = ["Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]

_ID = """CASE WHEN c % 499 = 8 THEN '   ' WHEN c % 7 = 0 THEN ' cus_' || CAST(c AS VARCHAR) || ' ' WHEN c % 101 = 0 THEN NULL
    ELSE 'CUS_' || CAST(c AS VARCHAR) END AS Customer_ID"""


def _months_from_orders(skip: int) -> str:
    return f"""(SELECT DISTINCT o_custkey AS c, CAST(date_trunc('month', o_orderdate) AS DATE) AS snap,
    month(o_orderdate) AS mm FROM orders) x JOIN (VALUES (1), (2)) twice(copy) ON copy = 1 OR c % 53 = 0
    WHERE (c + mm) % {skip} <> 0"""


def _fe(n: int) -> str:
    share = f"CASE WHEN (c + {n}) % 31 = 0 THEN 0.75 WHEN (c + {n}) % 29 = 0 THEN 3e9 ELSE 0 END"
    value = f"CAST((c * 31 + mm * 7 + {17 * n}) % 400 - 100 AS DOUBLE) + {share}"
    return f"CASE WHEN (c + {n}) % 23 = 0 THEN NULL ELSE {value} END AS fe_{n}"


def _dirty(value: str, null_every: int, mark_every: int, head: str = "", tail: str = "_") -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"""CASE WHEN (c + mm) % {null_every} = 0 THEN NULL
    WHEN (c + mm) % {mark_every} = 0 THEN '{head}' || {text} || '{tail}' ELSE {text} END"""


def _int(column: str) -> str:
    cut = rf"regexp_replace({column}, '^\s*([+-]?)([0-9]*)[.][0-9]*\s*$', '\10\2')"
    return rf"CASE WHEN regexp_matches({cut}, '^\s*[+-]?[0-9]+\s*$') THEN TRY_CAST(trim({cut}) AS INTEGER) END"


def _silver_money(name: str) -> str:
    bare = f"replace({name}, '_', '')"
    return f"""CASE WHEN {name} IS NULL OR {bare} = '' THEN CAST(0 AS FLOAT)
    ELSE TRY_CAST({bare} AS FLOAT) END AS {name}"""


def _silver_decimal(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN CAST(0 AS FLOAT) ELSE TRY_CAST({name} AS FLOAT) END AS {name}"


def _silver_whole(name: str) -> str:
    missing = f"{name} IS NULL" + (f" OR {name} = ''" if name in _BLANKABLE else "")
    return f"CASE WHEN {missing} THEN 0 ELSE {_int(name)} END AS {name}"


def _amount(name: str) -> str:
    return f"CASE WHEN {name} IS NULL OR {name} < 0 THEN CAST(0 AS DOUBLE) ELSE {name} END AS {name}"


_SEP = ",\n    "
_CLEAN_ID = "trim(upper(Customer_ID)) AS Customer_ID"
_CUSTOMER_KEYS = "Customer_ID IS NOT NULL AND snapshot_date IS NOT NULL"
_LOAN_KEYS = f"{_CUSTOMER_KEYS} AND loan_id IS NOT NULL"

# Source tables.
_RAW = {
    "raw_clickstream": f"""SELECT {_ID}, snap AS snapshot_date, {_SEP.join(_fe(n) for n in range(1, 21))}
    FROM {_months_from_orders(10)}""",
    "raw_attributes": f"""SELECT {_ID}, snap AS snapshot_date,
    CASE WHEN c % 13 = 0 THEN NULL ELSE '  Customer ' || CAST(c AS VARCHAR) || ' ' END AS Name,
    CASE c % 10 WHEN 0 THEN CAST(18 + c % 60 AS VARCHAR) || '_' WHEN 1 THEN '-500' WHEN 2 THEN '8698'
        WHEN 3 THEN NULL WHEN 4 THEN CAST(18 + c % 60 AS VARCHAR) || '.0' ELSE CAST(18 + c % 60 AS VARCHAR) END AS Age,
    CASE WHEN c % 5 = 0 THEN '#F%$D@*&8' ELSE '000-00-' || CAST(1000 + c AS VARCHAR) END AS SSN,
    CASE c % 4 WHEN 0 THEN '_______' WHEN 1 THEN 'Media_Manager' WHEN 2 THEN NULL ELSE ' Teacher ' END AS Occupation
    FROM {_months_from_orders(12)}""",
    "raw_financials": f"""SELECT {_ID}, snap AS snapshot_date,
    {_dirty('7000 + c % 200 * 1000', 17, 5)} AS Annual_Income,
    CASE c % 6 WHEN 0 THEN NULL WHEN 1 THEN '.5' ELSE CAST(500 + c % 90 * 10 AS VARCHAR) || '.25' END
        AS Monthly_Inhand_Salary,
    CAST(c % 11 - 1 AS VARCHAR) AS Num_Bank_Accounts,
    CAST(c % 12 AS VARCHAR) || '.0' AS Num_Credit_Card,
    CASE WHEN c % 19 = 0 THEN NULL ELSE CAST(1 + c % 34 AS VARCHAR) END AS Interest_Rate,
    {_dirty('c % 9 - 1', 15, 4)} AS Num_of_Loan,
    CASE c % 3 WHEN 0 THEN NULL WHEN 1 THEN ' Auto Loan, and Student Loan ' ELSE 'Payday Loan' END AS Type_of_Loan,
    CAST(c % 67 - 5 AS VARCHAR) AS Delay_from_due_date,
    {_dirty('c % 28 - 2', 14, 6)} AS Num_of_Delayed_Payment,
    CASE WHEN c % 8 = 0 THEN '_' ELSE CAST(c % 40 - 5 AS VARCHAR) || '.5' END AS Changed_Credit_Limit,
    CASE WHEN c % 18 = 0 THEN NULL ELSE CAST(c % 17 AS VARCHAR) || '.0' END AS Num_Credit_Inquiries,
    CASE c % 6 WHEN 0 THEN '_' WHEN 1 THEN 'Bad' WHEN 2 THEN 'Good' WHEN 3 THEN 'Standard' WHEN 4 THEN NULL
        ELSE 'good' END AS Credit_Mix,
    {_dirty('c % 5000', 21, 9)} AS Outstanding_Debt,
    CASE WHEN c % 29 = 0 THEN NULL ELSE CAST(20 + c % 70 AS VARCHAR) || '.5' END AS Credit_Utilization_Ratio,
    CASE c % 5 WHEN 0 THEN NULL WHEN 1 THEN 'NA' WHEN 2 THEN '1 Year and 3 Months'
        ELSE CAST(c % 33 AS VARCHAR) || ' Years and ' || CAST(mm AS VARCHAR) || ' Months' END AS Credit_History_Age,
    CASE c % 4 WHEN 0 THEN 'NM' WHEN 1 THEN 'Yes' WHEN 2 THEN ' no ' ELSE NULL END AS Payment_of_Min_Amount,
    CASE WHEN c % 31 = 0 THEN NULL ELSE CAST(c % 300 AS VARCHAR) || '.75' END AS Total_EMI_per_month,
    {_dirty('c % 1000', 16, 7, '__', '__')} AS Amount_invested_monthly,
    CASE WHEN c % 9 = 0 THEN NULL WHEN c % 9 = 1 THEN '!@9#%8' ELSE ' High_spent_Small_value_payments ' END
        AS Payment_Behaviour,
    CASE WHEN c % 50 = 0 THEN '__-333333333333333333333333333__' ELSE CAST(c % 900 AS VARCHAR) || '.125' END
        AS Monthly_Balance
    FROM {_months_from_orders(14)}""",
    "raw_loans": f"""SELECT ' L' || CAST(o_orderkey AS VARCHAR) || ' ' AS loan_id, {_ID},
    CAST(o_orderdate AS DATE) AS loan_start_date, CAST(start_ts + to_months(k) AS DATE) AS snapshot_date,
    10 AS tenure, k AS installment_num,
    CASE WHEN o_orderkey % 37 = 0 THEN -amt WHEN o_orderkey % 41 = 0 THEN NULL ELSE amt END AS loan_amt,
    CASE WHEN k = 0 OR o_orderkey % 43 = 0 THEN CAST(0 AS DOUBLE) ELSE due END AS due_amt,
    CASE WHEN k = 0 OR m > 0 THEN CAST(0 AS DOUBLE) ELSE due END AS paid_amt,
    CASE WHEN k = 0 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 47 = 0 THEN -due
        WHEN o_orderkey % 59 = 0 AND m > 0 THEN due * m + 0.01 ELSE due * m END AS overdue_amt,
    due * (10 - k) AS balance
    FROM (SELECT o_orderkey, o_custkey AS c, o_orderdate, k, date_trunc('month', o_orderdate) AS start_ts,
        CAST(CAST(floor(o_totalprice / 1000) AS INTEGER) * 1000 + 1000 AS DOUBLE) AS amt,
        CAST(CAST(floor(o_totalprice / 1000) AS INTEGER) * 100 + 100 AS DOUBLE) AS due,
        CASE WHEN (o_orderkey * 7 + k * 3) % 11 = 0 THEN least(k, CAST(1 + o_orderkey % 3 AS INTEGER)) ELSE 0 END AS m
        FROM orders, (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10)) t(k)) x""",
}

_SILVER = {
    "silver_clickstream": f"""SELECT {_CLEAN_ID}, snapshot_date,
    {_SEP.join(f'coalesce({name}, 0) AS {name}' for name in _FEATURES)}
    FROM raw_clickstream WHERE {_CUSTOMER_KEYS}""",
    "silver_attributes": f"""SELECT {_CLEAN_ID}, snapshot_date, trim(Name) AS Name,
    CASE WHEN age_years BETWEEN 0 AND 120 THEN age_years ELSE 0 END AS Age, 'MASKED' AS SSN,
    CASE WHEN Occupation IS NULL THEN 'Unknown' ELSE trim(replace(Occupation, '_', ' ')) END AS Occupation
    FROM (SELECT *, {_int('Age')} AS age_years FROM raw_attributes WHERE {_CUSTOMER_KEYS}) x""",
    "silver_financials": f"""SELECT {_CLEAN_ID}, snapshot_date,
    {_SEP.join(_silver_money(name) for name in _MONEY)},
    {_SEP.join(_silver_decimal(name) for name in _DECIMALS)},
    {_SEP.join(_silver_whole(name) for name in _WHOLE + _BLANKABLE)},
    CASE WHEN Type_of_Loan IS NULL OR Type_of_Loan = '' THEN 'None' ELSE trim(Type_of_Loan) END AS Type_of_Loan,
    CASE WHEN Credit_Mix IN ('Bad', 'Good', 'Standard') THEN Credit_Mix ELSE 'Unknown' END AS Credit_Mix,
    Credit_History_Age,
    CASE WHEN Payment_of_Min_Amount IS NULL THEN 'Unknown' WHEN Payment_of_Min_Amount = 'NM' THEN 'No'
        ELSE trim(upper(Payment_of_Min_Amount)) END AS Payment_of_Min_Amount,
    CASE WHEN Payment_Behaviour IS NULL THEN 'Unknown' ELSE trim(Payment_Behaviour) END AS Payment_Behaviour,
    CASE WHEN Credit_History_Age LIKE '%Years%'
        THEN TRY_CAST(regexp_replace(Credit_History_Age, ' Years.*', '') AS INTEGER)
        ELSE 0 END AS Credit_History_Age_Years
    FROM raw_financials WHERE {_CUSTOMER_KEYS}""",
    "silver_loans": f"""SELECT loan_id, Customer_ID, loan_start_date, snapshot_date, tenure, installment_num, loan_amt,
    due_amt, paid_amt, overdue_amt, balance, mob, missed AS installments_missed, first_missed AS first_missed_date,
    CASE WHEN overdue_amt > 0 THEN CAST(datediff('day', first_missed, snapshot_date) AS INTEGER) ELSE 0 END AS dpd
    FROM (SELECT *, CASE WHEN missed > 0 THEN CAST(snapshot_date - to_months(missed) AS DATE) END AS first_missed
        FROM (SELECT *, coalesce(CAST(ceil(overdue_amt / nullif(due_amt, 0)) AS INTEGER), 0) AS missed,
            CAST(datesub('month', loan_start_date, snapshot_date) AS INTEGER) AS mob
            FROM (SELECT trim(loan_id) AS loan_id, {_CLEAN_ID}, loan_start_date, snapshot_date,
                coalesce(tenure, 0) AS tenure, coalesce(installment_num, 0) AS installment_num, {_amount('loan_amt')},
                {_amount('due_amt')}, {_amount('paid_amt')}, {_amount('overdue_amt')}, {_amount('balance')}
                FROM raw_loans WHERE {_LOAN_KEYS}) a) b) d""",
}

_FINANCIAL_LIST = ", ".join(_FINANCIAL_FEATURES)
_NUMBERS = ["loan_amt", "tenure", "Age", *[f for f in _FINANCIAL_FEATURES if f not in _TEXT_FEATURES]]
_FILLED = ", ".join(
    [f"coalesce({name}, 0) AS {name}" for name in _NUMBERS]
    + [f"coalesce({name}, 'Unknown') AS {name}" for name in _TEXT_FEATURES]
)
_RATIOS = """CASE WHEN Annual_Income > 0
    THEN CAST(Total_EMI_per_month * CAST(12 AS FLOAT) AS DOUBLE) / CAST(Annual_Income AS DOUBLE)
    ELSE 0 END AS income_to_loan_ratio,
    CASE WHEN Annual_Income > 0 THEN CAST(Outstanding_Debt AS DOUBLE) / CAST(Annual_Income AS DOUBLE)
    ELSE 0 END AS debt_to_income_ratio"""
_BAND = """CASE WHEN Credit_Utilization_Ratio > 80 THEN 'High' WHEN Credit_Utilization_Ratio > 50 THEN 'Medium'
    ELSE 'Low' END AS credit_utilization_risk"""

_GOLD = {
    "gold_applications": """SELECT loan_id, Customer_ID, loan_amt, tenure, loan_start_date, snapshot_date
    FROM silver_loans WHERE installment_num = 0""",
    "gold_joined": f"""SELECT * FROM gold_applications LEFT JOIN silver_clickstream USING (Customer_ID, snapshot_date)
    LEFT JOIN (SELECT Customer_ID, snapshot_date, Age, Occupation FROM silver_attributes) a
        USING (Customer_ID, snapshot_date)
    LEFT JOIN (SELECT Customer_ID, snapshot_date, {_FINANCIAL_LIST} FROM silver_financials) f
        USING (Customer_ID, snapshot_date)""",
    "gold_filled": f"""SELECT Customer_ID, snapshot_date, loan_id, loan_start_date, {', '.join(_FEATURES)}, {_FILLED}
    FROM gold_joined""",
    "gold_features": f"SELECT *, {_RATIOS}, {_BAND} FROM gold_filled",
    "gold_labels": """SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
    '30dpd_6mob' AS label_def, snapshot_date FROM silver_loans WHERE mob = 6""",
}

_ALL = {**_RAW, **_SILVER, **_GOLD}


def _with(select: str) -> str:
    """Put the tables that a select uses, directly or through others, in front of it."""
    needed, texts = [], [select]
    while texts:
        text = texts.pop()
        for name in _ALL:
            if name in text and name not in needed:
                needed.append(name)
                texts.append(_ALL[name])
    tables = ",\n".join(f"{name} AS ({_ALL[name]})" for name in _ALL if name in needed)
    return f"WITH {tables}\n{select}"


_SLICE = "DATE '1996-03-01'"


def _audit_part(stages: dict[str, str], source: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT snapshot_date, '{stage.split('.')[0]}' AS layer, '{stage.split('.')[1]}' AS table_name,
    '{stage.split('.')[2]}' AS stage, count(*) AS n FROM {source} WHERE {condition} GROUP BY snapshot_date"""
        for stage, condition in stages.items()
    )


def _every_month(counted: list[str], labels: list[tuple], names: list[str]) -> str:
    """Counts for each month of the data and each label, 0 where there is none."""
    rows = ", ".join("('" + "', '".join(label) + "')" for label in labels)
    same = " AND ".join(f"f.{name} = s.{name}" for name in names)
    union = "\nUNION ALL ".join(counted)
    return f"""SELECT m.snapshot_date, {', '.join(f's.{name}' for name in names)},
    CAST(coalesce(f.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 MONTH)) AS DATE)
    AS snapshot_date FROM raw_loans) m
CROSS JOIN (VALUES {rows}) s({', '.join(names)})
LEFT JOIN ({union}) f ON f.snapshot_date = m.snapshot_date AND {same}"""


def _audit() -> str:
    parts, stages = [], []
    for table in ["clickstream", "attributes", "financials", "loans"]:
        keys = _LOAN_KEYS if table == "loans" else _CUSTOMER_KEYS
        listed = {
            f"bronze.{table}.slice": "true",
            f"silver.{table}.input": "true",
            f"silver.{table}.output": keys,
            f"gold.feature_store.{table}_input": keys,
        }
        if table == "loans":
            mob = "datesub('month', loan_start_date, snapshot_date) = 6"
            listed["gold.feature_store.at_application"] = f"{keys} AND coalesce(installment_num, 0) = 0"
            listed["gold.feature_store.base"] = listed["gold.feature_store.at_application"]
            listed["gold.label_store.input"] = keys
            listed["gold.label_store.at_mob"] = f"{keys} AND {mob}"
            listed["gold.label_store.output"] = f"{keys} AND {mob}"
        parts.append(_audit_part(listed, f"raw_{table}"))
        stages += listed
    parts.append(_audit_part({"gold.feature_store.output": "true"}, "gold_features"))
    stages.append("gold.feature_store.output")
    return _every_month(parts, [tuple(stage.split(".")) for stage in stages], ["layer", "table_name", "stage"])


def _processed() -> str:
    tables = {
        (layer, table): f"{prefix}_{table}"
        for layer, prefix in [("bronze", "raw"), ("silver", "silver")]
        for table in ["clickstream", "attributes", "financials", "loans"]
    }
    tables["gold", "feature_store"], tables["gold", "label_store"] = "gold_features", "gold_labels"
    counted = [
        f"""SELECT snapshot_date, '{layer}' AS layer, '{table}' AS table_name, count(*) AS n FROM {source}
    GROUP BY snapshot_date"""
        for (layer, table), source in tables.items()
    ]
    rows = _every_month(counted, list(tables), ["layer", "table_name"])
    return f"SELECT snapshot_date, layer, table_name, n AS n_rows FROM ({rows}) p"


def _schema_rows(table: str, source: str, columns: list[tuple[str, str]]) -> str:
    rows = ", ".join(f"({n}, '{name}', '{kind}')" for n, (name, kind) in enumerate(columns, start=1))
    return f"""SELECT '{table}' AS table_name, c.ordinal, c.column_name, c.data_type,
    (SELECT count(*) FROM {source}) AS n_rows FROM (VALUES {rows}) c(ordinal, column_name, data_type)"""


def _kind(name: str) -> str:
    if name in _MONEY or name in _DECIMALS:
        return "float"
    return "string" if name in _TEXT_FEATURES else "int"


_FEATURE_SCHEMA = (
    [("Customer_ID", "string"), ("snapshot_date", "date"), ("loan_id", "string"), ("loan_amt", "double")]
    + [("tenure", "int"), ("loan_start_date", "date")]
    + [(name, "double") for name in _FEATURES]
    + [("Age", "int"), ("Occupation", "string")]
    + [(name, _kind(name)) for name in _FINANCIAL_FEATURES]
    + [("income_to_loan_ratio", "double"), ("debt_to_income_ratio", "double"), ("credit_utilization_risk", "string")]
)
_LABEL_SCHEMA = [
    ("loan_id", "string"), ("Customer_ID", "string"), ("label", "int"), ("label_def", "string"),
    ("snapshot_date", "date"),
]


def _required() -> str:
    exists = " AND ".join(
        f"EXISTS (SELECT 1 FROM silver_{table} t WHERE t.snapshot_date = m.snapshot_date)"
        for table in ["clickstream", "attributes", "financials"]
    )
    return f"SELECT snapshot_date FROM (SELECT DISTINCT snapshot_date FROM silver_loans) m WHERE {exists}"


def _join(table: str, columns: str) -> str:
    return f"""SELECT * FROM gold_applications
LEFT JOIN (SELECT Customer_ID, snapshot_date, {columns} FROM silver_{table}) r USING (Customer_ID, snapshot_date)"""


def _written_audit() -> str:
    """All rows arrive, so what is counted is what is expected; no row of the sources lies outside the months."""
    rows = _processed().replace("n AS n_rows", "n")
    whole = f"""SELECT snapshot_date, layer, table_name, n AS n_expected, n AS n_counted, CAST(0 AS BIGINT) AS n_missing
FROM ({rows}) w WHERE n > 0"""
    tables = ", ".join(f"('{table}')" for table in ["clickstream", "attributes", "financials", "loans"])
    return f"""{whole} UNION ALL SELECT CAST(NULL AS DATE), 'rejected', t.table_name, CAST(0 AS BIGINT),
    CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM (VALUES {tables}) t(table_name)"""


def _refreshed() -> str:
    """Financials of one month have changed: their month is loaded, cleaned and joined again."""
    tables = ["clickstream", "attributes", "financials", "loans"]
    names = [(layer, table) for layer in ["bronze", "silver"] for table in tables]
    names += [("gold", "feature_store"), ("gold", "label_store")]
    values = ", ".join(f"('{layer}', '{table}')" for layer, table in names)
    again = "table_name IN ('financials', 'feature_store')"
    return f"""SELECT t.layer, t.table_name, m.snapshot_date,
    CASE WHEN {again} AND m.snapshot_date = {_SLICE} THEN 'rebuilt' ELSE 'skipped' END AS action
FROM (SELECT CAST(unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 MONTH)) AS DATE)
    AS snapshot_date FROM raw_loans) m CROSS JOIN (VALUES {values}) t(layer, table_name)"""


def _left_out() -> str:
    """Financials of the second month and loans of the third month are never processed."""
    months = "(SELECT DISTINCT snapshot_date, dense_rank() OVER (ORDER BY snapshot_date) AS nth FROM raw_loans)"
    return f"""SELECT r.layer, r.table_name, m.snapshot_date, r.missing FROM {months} m JOIN (VALUES
    (2, 'silver', 'financials', 'bronze.financials'), (2, 'gold', 'feature_store', 'silver.financials'),
    (3, 'silver', 'loans', 'bronze.loans'), (3, 'gold', 'label_store', 'silver.loans')
    ) r(nth, layer, table_name, missing) ON r.nth = m.nth"""


def _drift() -> str:
    """Kinds of all values of the financial source. An empty text is written like NULL."""
    kinds = {"Customer_ID": "string", "snapshot_date": "date"}
    kinds |= {name: _kind(name) for name in _MONEY + _DECIMALS + _WHOLE + _BLANKABLE}
    kinds |= {name: "string" for name in _FINANCIAL_TEXTS}
    fitting = {"string": "true", "date": "kind IN ('missing', 'date')", "int": "kind IN ('missing', 'int')"}
    fitting["float"] = "kind IN ('missing', 'int', 'bigint', 'double')"
    parts = [
        f"SELECT '{name}' AS column_name, '{kind}' AS declared, CAST({name} AS VARCHAR) AS x FROM raw_financials"
        for name, kind in kinds.items()
    ]
    fits = " ".join(f"WHEN '{kind}' THEN {test}" for kind, test in fitting.items())
    return f"""SELECT column_name, declared, sum(CAST(kind <> 'missing' AS BIGINT))::BIGINT AS n_values,
    sum(CAST(kind = 'missing' AS BIGINT))::BIGINT AS n_missing,
    sum(CASE WHEN CASE declared {fits} END THEN 0 ELSE 1 END)::BIGINT AS n_misfits,
    CASE WHEN bool_or(kind = 'string') OR (bool_or(kind = 'date') AND bool_or(kind IN ('int', 'bigint', 'double')))
    THEN 'string' WHEN bool_or(kind = 'date') THEN 'date' WHEN bool_or(kind = 'double') THEN 'double'
    WHEN bool_or(kind = 'bigint') THEN 'bigint' WHEN bool_or(kind = 'int') THEN 'int' ELSE 'void' END AS narrowest
FROM (SELECT column_name, declared, CASE WHEN x IS NULL OR trim(x) = '' THEN 'missing'
    WHEN regexp_matches(x, '^\\s*[+-]?[0-9]+\\s*$') AND TRY_CAST(trim(x) AS INTEGER) IS NOT NULL THEN 'int'
    WHEN regexp_matches(x, '^\\s*[+-]?[0-9]+\\s*$') AND TRY_CAST(trim(x) AS BIGINT) IS NOT NULL THEN 'bigint'
    WHEN regexp_matches(x, '^\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*$') THEN 'double'
    WHEN regexp_matches(x, '^\\s*[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\\s*$') AND TRY_CAST(trim(x) AS DATE) IS NOT NULL
    THEN 'date' ELSE 'string' END AS kind FROM ({" UNION ALL ".join(parts)}) v) k
GROUP BY column_name, declared"""


_SELECTS = {
    "snapshot_calendar": """SELECT CAST(unnest(generate_series(min(snapshot_date), max(snapshot_date),
    INTERVAL 1 MONTH)) AS DATE) AS snapshot_date FROM raw_loans""",
    "bronze_snapshot_slice": f"SELECT * FROM raw_loans WHERE snapshot_date = {_SLICE}",
    "bronze_clickstream": "SELECT * FROM raw_clickstream",
    "bronze_attributes": "SELECT * FROM raw_attributes",
    "bronze_financials": "SELECT * FROM raw_financials",
    "bronze_loans": "SELECT * FROM raw_loans",
    "silver_clickstream": "SELECT * FROM silver_clickstream",
    "silver_attributes": "SELECT * FROM silver_attributes",
    "silver_financials": "SELECT * FROM silver_financials",
    "silver_loans": "SELECT * FROM silver_loans",
    "credit_age_years": """SELECT Customer_ID, snapshot_date, Credit_History_Age, Credit_History_Age_Years
FROM silver_financials""",
    "loan_mob": "SELECT loan_id, snapshot_date, loan_start_date, mob FROM silver_loans",
    "loan_dpd": """SELECT loan_id, snapshot_date, overdue_amt, due_amt, installments_missed, first_missed_date, dpd
FROM silver_loans""",
    "loans_at_application": "SELECT * FROM gold_applications",
    "join_loans_clickstream": _join("clickstream", ", ".join(_FEATURES)),
    "join_loans_attributes": _join("attributes", "Age, Occupation"),
    "join_loans_financials": _join("financials", _FINANCIAL_LIST),
    "feature_null_fill": "SELECT * FROM gold_filled",
    "ratio_features": f"""SELECT Customer_ID, snapshot_date, Annual_Income, Total_EMI_per_month, Outstanding_Debt,
{_RATIOS} FROM silver_financials""",
    "risk_band": f"SELECT Customer_ID, snapshot_date, Credit_Utilization_Ratio, {_BAND} FROM silver_financials",
    "gold_feature_store": "SELECT * FROM gold_features",
    "gold_label_store": "SELECT * FROM gold_labels",
    "gold_label_store_60dpd_9mob": """SELECT loan_id, Customer_ID, CASE WHEN dpd >= 60 THEN 1 ELSE 0 END AS label,
'60dpd_9mob' AS label_def, snapshot_date FROM silver_loans WHERE mob = 9""",
    "label_distribution": "SELECT label, count(*) AS n FROM gold_labels GROUP BY label",
    "dataset_profile": f"""SELECT 'feature_store' AS table_name, count(*) AS n_rows, {len(_FEATURE_SCHEMA)} AS n_columns
FROM gold_features UNION ALL
SELECT 'label_store' AS table_name, count(*) AS n_rows, {len(_LABEL_SCHEMA)} AS n_columns FROM gold_labels""",
    "layer_row_audit": _audit(),
    "lake_stage_counts": _audit(),
    "lake_logged_label_distribution": "SELECT label, count(*) AS n FROM gold_labels GROUP BY label",
    "lake_logged_profile": f"""SELECT 'feature_store' AS table_name, count(*) AS n_rows, {len(_FEATURE_SCHEMA)} AS n_columns
FROM gold_features UNION ALL
SELECT 'label_store' AS table_name, count(*) AS n_rows, {len(_LABEL_SCHEMA)} AS n_columns FROM gold_labels""",
    "lake_refresh_actions": _refreshed(),
    "schema_report": f"""{_schema_rows('feature_store', 'gold_features', _FEATURE_SCHEMA)}
UNION ALL {_schema_rows('label_store', 'gold_labels', _LABEL_SCHEMA)}""",
    "csv_scan_clickstream": "SELECT * FROM raw_clickstream",
    "csv_scan_attributes": "SELECT * FROM raw_attributes",
    "csv_scan_loans": "SELECT * FROM raw_loans",
    "csv_by_month": "SELECT * FROM raw_clickstream",
    "csv_schema_drift": _drift(),
    "csv_multi_line_scan": """SELECT Customer_ID, snapshot_date, Name || chr(10) || '"x", y' AS Name, Age, SSN, Occupation
FROM raw_attributes""",
    "csv_roundtrip_scan": "SELECT * FROM raw_financials",
    "partition_pruned_scan": f"SELECT * FROM silver_loans WHERE snapshot_date = {_SLICE}",
    "multi_partition_scan": "SELECT * FROM gold_labels",
    "partition_overwrite_roundtrip": f"""SELECT * FROM raw_attributes WHERE snapshot_date <> {_SLICE}
UNION ALL SELECT Customer_ID, snapshot_date, upper(Name) AS Name, Age, SSN, Occupation
FROM raw_attributes WHERE snapshot_date = {_SLICE}""",
    "required_months": _required(),
    "training_set": """SELECT f.*, l.label, l.label_def FROM gold_features f
JOIN (SELECT loan_id, label, label_def FROM gold_labels) l USING (loan_id)""",
    "lake_training_set": """SELECT f.*, l.label, l.label_def FROM gold_features f
JOIN (SELECT loan_id, label, label_def FROM gold_labels) l USING (loan_id)""",
    "join_loans_clickstream_salted": _join("clickstream", ", ".join(_FEATURES)),
    "training_set_salted": """SELECT f.*, l.label, l.label_def FROM gold_features f
JOIN (SELECT loan_id, label, label_def FROM gold_labels) l USING (loan_id)""",
    "month_rerun_without_rows": f"SELECT * FROM raw_attributes WHERE snapshot_date <> {_SLICE}",
    "lake_row_audit": _written_audit(),
    "lake_left_out_months": _left_out(),
    "lake_feature_store": "SELECT * FROM gold_features",
    "lake_label_store": "SELECT * FROM gold_labels",
    "lake_processed_rows": _processed(),
    "lake_label_distribution": "SELECT label, count(*) AS n FROM gold_labels GROUP BY label",
}

ORACLE_SQL = {name: _with(select) for name, select in _SELECTS.items()}
