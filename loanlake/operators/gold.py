"""Silver tables to the feature store, the label store and the training set."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake import schemas as s
from loanlake.functions import loans as fn
from loanlake.operators.joins import SkewPolicy, inner_join, left_joins


def loans_at_application(loans: DataFrame) -> DataFrame:
    """Each loan as it stood when it was taken out; later installments would leak the outcome into the features."""
    return loans.where(F.col("installment_num") == 0).select(
        s.LOAN, s.CUSTOMER, "loan_amt", "tenure", "loan_start_date", s.SNAPSHOT
    )


def customer_features(
    clickstream: DataFrame, attributes: DataFrame, financials: DataFrame
) -> dict[str, DataFrame]:
    """What the feature store takes from the three customer tables; all of clickstream."""
    return {
        "clickstream": clickstream,
        "attributes": attributes.select(*s.CUSTOMER_MONTH, *s.ATTRIBUTE_FEATURES),
        "financials": financials.select(*s.CUSTOMER_MONTH, *s.FINANCIAL_FEATURES),
    }


def join_customer_features(
    applications: DataFrame,
    customers: dict[str, DataFrame],
    policy: SkewPolicy | None = None,
    hot: dict[str, DataFrame] | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Left-join customer tables to the loans of the same customer and month, keys first.

    A key that occurs twice in a customer table gives two rows. For ``policy`` and ``hot`` see :func:`left_joins`.
    ``carried`` are columns of the loans besides their features; they come last.
    """
    joined = left_joins(applications, customers, s.CUSTOMER_MONTH, policy, hot)
    own = [name for df in customers.values() for name in df.columns if name not in s.CUSTOMER_MONTH]
    return joined.select(*s.CUSTOMER_MONTH, *s.LOAN_FEATURES, *own, *carried)


def fill_features(df: DataFrame) -> DataFrame:
    """0 for missing numbers and ``Unknown`` for missing text, for those columns that exist."""
    kinds = {field.name: field.dataType.simpleString() for field in df.schema}
    numbers = {
        name: F.coalesce(F.col(name), F.lit(0).cast(kinds[name])) for name in s.NUMBER_FEATURES if name in kinds
    }
    texts = {name: F.coalesce(F.col(name), F.lit("Unknown")) for name in s.TEXT_FEATURES if name in kinds}
    return df.withColumns({**numbers, **texts})


def add_ratios(df: DataFrame) -> DataFrame:
    income = F.col("Annual_Income")
    return df.withColumns(
        {
            "income_to_loan_ratio": fn.yearly_share(F.col("Total_EMI_per_month"), income),
            "debt_to_income_ratio": fn.income_share(F.col("Outstanding_Debt"), income),
        }
    )


def add_risk_band(df: DataFrame) -> DataFrame:
    return df.withColumn("credit_utilization_risk", fn.risk_band(F.col("Credit_Utilization_Ratio")))


def feature_store(
    loans: DataFrame,
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    policy: SkewPolicy | None = None,
) -> DataFrame:
    """Features of each loan at application time, for all months at once: the join keys include the month.

    With a ``policy``, hot keys are looked up and their rows spread; without, building this runs no job.
    """
    return features_of(loans_at_application(loans), clickstream, attributes, financials, policy)


def features_of(
    applications: DataFrame,
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    policy: SkewPolicy | None = None,
    hot: dict[str, DataFrame] | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """The feature store of given applications, and last the columns of them that are ``carried``."""
    customers = customer_features(clickstream, attributes, financials)
    joined = join_customer_features(applications, customers, policy, hot, carried)
    features = add_risk_band(add_ratios(fill_features(joined)))
    return features.select(*[name for name in features.columns if name not in carried], *carried) if carried else features


def feature_counts(
    loans: DataFrame, clickstream: DataFrame, attributes: DataFrame, financials: DataFrame
) -> DataFrame:
    """``snapshot_date, n``: the rows of :func:`feature_store` by month, without making them.

    Every row of a key meets every other, so rows of a key are counted in each table and the counts multiplied.
    """
    found = loans_at_application(loans).groupBy(*s.CUSTOMER_MONTH).agg(F.count("*").alias("n"))
    n = F.col("n")
    for name, df in {"clickstream": clickstream, "attributes": attributes, "financials": financials}.items():
        met = df.groupBy(*s.CUSTOMER_MONTH).agg(F.count("*").alias(f"n_{name}"))
        found = found.join(met, s.CUSTOMER_MONTH, "left")
        n = n * F.coalesce(f"n_{name}", F.lit(1))
    return found.groupBy(s.SNAPSHOT).agg(F.sum(n).alias("n"))


def label_store(loans: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """Loans at ``mob`` months on book, labelled 1 if ``dpd`` or more days past due."""
    return loans.where(F.col("mob") == mob).select(
        s.LOAN,
        s.CUSTOMER,
        fn.default_label(F.col("dpd"), dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        s.SNAPSHOT,
    )


def training_set(features: DataFrame, labels: DataFrame, policy: SkewPolicy | None = None) -> DataFrame:
    """Features with the label of the same loan. Their months differ, so only the loan id is joined on."""
    return inner_join(features, labels.select(s.LOAN, *s.LABELS), [s.LOAN], policy)


def training_features(
    loans: DataFrame,
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    labels: DataFrame,
    policy: SkewPolicy | None = None,
) -> DataFrame:
    """The :func:`training_set` of the :func:`feature_store` of these tables.

    Labels are joined to applications, which have the loan ids of their features. So rows of a key meet each other after
    all shuffles, and what is shuffled is in proportion to the tables, not to the features. With a ``policy``, rows of loans
    that are hot among applications or labels are spread.
    """
    labelled = training_set(loans_at_application(loans), labels, policy)
    features = features_of(labelled, clickstream, attributes, financials, carried=s.LABELS)
    return features.select(s.LOAN, *[name for name in features.columns if name != s.LOAN])


def present_months(df: DataFrame) -> DataFrame:
    """The months that have rows; one row per month leaves each task, so a large month is no hot group."""
    return df.select(s.SNAPSHOT).distinct()


def required_months(months: DataFrame, *tables: DataFrame) -> DataFrame:
    """The given months that have rows in every table.

    The pipeline asks less: a month counts if it was processed, with rows or not; see ``Lake.processed_months``.
    """
    for df in tables:
        months = months.join(present_months(df), s.SNAPSHOT, "left_semi")
    return months
