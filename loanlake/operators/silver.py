"""Bronze rows to silver rows: key filter, clean-up, typing and loan metrics.

Each function is one filter and a projection, with no shuffle and no Python code in the tasks, and works on one month
or on all months. Columns that are not named here pass through.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake import schemas as s
from loanlake.functions import loans as fn
from loanlake.functions import text


def with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all present. Ids are cleaned later, so a blank id counts as present."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def clean_clickstream(bronze: DataFrame) -> DataFrame:
    kinds = {field.name: field.dataType.simpleString() for field in bronze.schema}
    features = {name: text.null_as_zero(F.col(name), kinds[name]) for name in s.CLICK_FEATURES}
    return with_keys(bronze, s.CUSTOMER_MONTH).withColumns(
        {s.CUSTOMER: text.clean_id(F.col(s.CUSTOMER)), **features}
    )


def clean_attributes(bronze: DataFrame) -> DataFrame:
    return with_keys(bronze, s.CUSTOMER_MONTH).withColumns(
        {
            s.CUSTOMER: text.clean_id(F.col(s.CUSTOMER)),
            "Name": F.trim("Name"),
            "Age": text.valid_age(F.col("Age")),
            "SSN": F.lit("MASKED"),
            "Occupation": text.occupation(F.col("Occupation")),
        }
    )


def clean_financials(bronze: DataFrame) -> DataFrame:
    """Two steps, texts first and types second.

    The code generated for these columns comes close to the size beyond which the JVM does not compile a method and
    each row takes several times as long; a longer expression here has to be timed on a large table.
    """
    years = "Credit_History_Age_Years"
    texts = with_keys(bronze, s.CUSTOMER_MONTH).withColumns(
        {
            s.CUSTOMER: text.clean_id(F.col(s.CUSTOMER)),
            **{name: text.strip_underscores(F.col(name)) for name in s.UNDERSCORED_MONEY},
            **{name: text.whole_part(text.zero_if_null(F.col(name))) for name in s.WHOLE_NUMBERS},
            **{name: text.whole_part(text.zero_if_blank(F.col(name))) for name in s.BLANKABLE_WHOLE_NUMBERS},
            years: text.credit_age_text(F.col("Credit_History_Age")),
        }
    )
    return texts.withColumns(
        {
            **{name: text.parse_float(text.zero_if_blank(F.col(name))) for name in s.UNDERSCORED_MONEY},
            **{name: text.parse_float(text.zero_if_null(F.col(name))) for name in s.PLAIN_DECIMALS},
            **{name: F.col(name).try_cast("int") for name in s.WHOLE_NUMBERS},
            **{name: text.whole_number(F.col(name)) for name in [*s.BLANKABLE_WHOLE_NUMBERS, years]},
            "Credit_Mix": text.credit_mix(F.col("Credit_Mix")),
            "Payment_of_Min_Amount": text.minimum_payment(F.col("Payment_of_Min_Amount")),
            "Payment_Behaviour": text.payment_behaviour(F.col("Payment_Behaviour")),
            "Type_of_Loan": text.loan_types(F.col("Type_of_Loan")),
        }
    )


def clean_loan_rows(bronze: DataFrame) -> DataFrame:
    """Loan ledger with clean keys, no missing numbers and no negative amounts."""
    return with_keys(bronze, [s.CUSTOMER, s.LOAN, s.SNAPSHOT]).withColumns(
        {
            s.CUSTOMER: text.clean_id(F.col(s.CUSTOMER)),
            s.LOAN: F.trim(s.LOAN),
            **{name: text.null_as_zero(F.col(name), "int") for name in s.LOAN_COUNTS},
            **{name: fn.non_negative(F.col(name)) for name in s.LOAN_AMOUNTS},
        }
    )


def add_months_on_book(df: DataFrame) -> DataFrame:
    return df.withColumn("mob", fn.months_on_book(F.col(s.SNAPSHOT), F.col("loan_start_date")))


def add_days_past_due(df: DataFrame) -> DataFrame:
    """``installments_missed``, ``first_missed_date`` and ``dpd`` of a clean ledger.

    Days follow the calendar: one missed installment is 28 days on 1 March and 30 or 31 days on most other months.
    """
    snapshot, overdue = F.col(s.SNAPSHOT), F.col("overdue_amt")
    return (
        df.withColumn("installments_missed", fn.installments_missed(overdue, F.col("due_amt")))
        .withColumn("first_missed_date", fn.first_missed_date(snapshot, F.col("installments_missed")))
        .withColumn("dpd", fn.days_past_due(snapshot, overdue, F.col("first_missed_date")))
    )


def clean_loans(bronze: DataFrame) -> DataFrame:
    return add_days_past_due(add_months_on_book(clean_loan_rows(bronze)))


CLEANERS = {
    "clickstream": clean_clickstream,
    "attributes": clean_attributes,
    "financials": clean_financials,
    "loans": clean_loans,
}
