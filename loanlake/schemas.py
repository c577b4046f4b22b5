"""Declared schemas and column groups of every table.

Declaring the schema keeps a column's type the same in every month and saves the pass over the data that inference
needs. Columns a source carries beyond these can be added by passing an extended ``StructType``.
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Key columns.
CUSTOMER = "Customer_ID"
LOAN = "loan_id"
SNAPSHOT = "snapshot_date"
CUSTOMER_MONTH = [CUSTOMER, SNAPSHOT]

# The twenty behaviour features.
CLICK_FEATURES = [f"fe_{n}" for n in range(1, 21)]

# Money text that carries stray underscores; blank means 0.
UNDERSCORED_MONEY = [
    "Annual_Income", "Changed_Credit_Limit", "Outstanding_Debt", "Amount_invested_monthly", "Monthly_Balance",
]
# Decimal text without underscores.
PLAIN_DECIMALS = [
    "Monthly_Inhand_Salary", "Num_Credit_Inquiries", "Credit_Utilization_Ratio", "Total_EMI_per_month",
]
# Whole numbers held as text.
WHOLE_NUMBERS = ["Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Delay_from_due_date"]
# Whole numbers held as text, blank means 0.
BLANKABLE_WHOLE_NUMBERS = ["Num_of_Loan", "Num_of_Delayed_Payment"]

# Loan ledger numbers; amounts are never negative.
LOAN_COUNTS = ["tenure", "installment_num"]
LOAN_AMOUNTS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]

# What the feature store takes from each table, in output order.
LOAN_FEATURES = [LOAN, "loan_amt", "tenure", "loan_start_date"]
#: What the training set takes from the label store.
LABELS = ["label", "label_def"]
ATTRIBUTE_FEATURES = ["Age", "Occupation"]
FINANCIAL_FEATURES = [
    "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
    "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix",
    "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age_Years", "Payment_of_Min_Amount",
    "Total_EMI_per_month", "Amount_invested_monthly", "Payment_Behaviour", "Monthly_Balance",
]
# Text features; every other filled feature is a number. The fe_* columns are not filled: a loan
# without clickstream keeps NULL there.
TEXT_FEATURES = ["Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"]
NUMBER_FEATURES = [
    name
    for name in ["loan_amt", "tenure", *ATTRIBUTE_FEATURES, *FINANCIAL_FEATURES]
    if name not in TEXT_FEATURES
]


def _struct(types: dict) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


_TEXT, _INT, _FLOAT, _DOUBLE, _DATE = StringType(), IntegerType(), FloatType(), DoubleType(), DateType()
_KEYS = {CUSTOMER: _TEXT, SNAPSHOT: _DATE}

# Column order of the financial source.
_FINANCIAL_SOURCE = [
    "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_of_Loan",
    "Type_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries",
    "Credit_Mix", "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age", "Payment_of_Min_Amount",
    "Total_EMI_per_month", "Amount_invested_monthly", "Payment_Behaviour", "Monthly_Balance",
]
_LOAN_SOURCE = {
    LOAN: _TEXT,
    CUSTOMER: _TEXT,
    "loan_start_date": _DATE,
    SNAPSHOT: _DATE,
    **dict.fromkeys(LOAN_COUNTS, _INT),
    **dict.fromkeys(LOAN_AMOUNTS, _DOUBLE),
}

BRONZE = {
    "clickstream": _struct({**_KEYS, **dict.fromkeys(CLICK_FEATURES, _DOUBLE)}),
    "attributes": _struct({**_KEYS, **dict.fromkeys(["Name", "Age", "SSN", "Occupation"], _TEXT)}),
    "financials": _struct({**_KEYS, **dict.fromkeys(_FINANCIAL_SOURCE, _TEXT)}),
    "loans": _struct(_LOAN_SOURCE),
}


def _financial_type(name: str):
    if name in UNDERSCORED_MONEY or name in PLAIN_DECIMALS:
        return _FLOAT
    if name in WHOLE_NUMBERS or name in BLANKABLE_WHOLE_NUMBERS:
        return _INT
    return _TEXT


_SILVER_FINANCIALS = {
    **_KEYS,
    **{name: _financial_type(name) for name in _FINANCIAL_SOURCE},
    "Credit_History_Age_Years": _INT,
}

SILVER = {
    "clickstream": BRONZE["clickstream"],
    "attributes": _struct({**_KEYS, "Name": _TEXT, "Age": _INT, "SSN": _TEXT, "Occupation": _TEXT}),
    "financials": _struct(_SILVER_FINANCIALS),
    "loans": _struct(
        {**_LOAN_SOURCE, "mob": _INT, "installments_missed": _INT, "first_missed_date": _DATE, "dpd": _INT}
    ),
}

GOLD = {
    "feature_store": _struct(
        {
            **_KEYS,
            **{name: _LOAN_SOURCE[name] for name in LOAN_FEATURES},
            **dict.fromkeys(CLICK_FEATURES, _DOUBLE),
            "Age": _INT,
            "Occupation": _TEXT,
            **{name: _SILVER_FINANCIALS[name] for name in FINANCIAL_FEATURES},
            "income_to_loan_ratio": _DOUBLE,
            "debt_to_income_ratio": _DOUBLE,
            "credit_utilization_risk": _TEXT,
        }
    ),
    "label_store": _struct({LOAN: _TEXT, CUSTOMER: _TEXT, "label": _INT, "label_def": _TEXT, SNAPSHOT: _DATE}),
}

TABLES = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}
