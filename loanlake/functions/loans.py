"""Loan performance and derived feature expressions, equal with ANSI mode on and off."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_negative(c: Column) -> Column:
    """NULL and negative amounts become 0; NaN stays."""
    return F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0))


def months_on_book(snapshot: Column, start: Column) -> Column:
    """Whole months from ``start`` to ``snapshot``. Two month ends count as whole months apart."""
    return F.months_between(snapshot, start).cast("int")


def installments_missed(overdue: Column, due: Column) -> Column:
    """Installments that the overdue amount covers, rounded up; 0 where nothing was due."""
    return F.coalesce(F.ceil(F.try_divide(overdue, due)).try_cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(snapshot: Column, overdue: Column, first_missed: Column) -> Column:
    """Calendar days since the first missed installment, NULL if something is overdue but no date is known."""
    return F.when(overdue > 0, F.date_diff(snapshot, first_missed)).otherwise(F.lit(0))


def yearly_share(monthly: Column, income: Column) -> Column:
    """Twelve times a monthly 32-bit amount, rounded to 32 bits, over the yearly income; 0 without income."""
    return income_share(monthly * F.lit(12).cast("float"), income)


def income_share(amount: Column, income: Column) -> Column:
    return F.when(income > 0, F.try_divide(amount.cast("double"), income.cast("double"))).otherwise(F.lit(0.0))


def risk_band(utilization: Column) -> Column:
    """NaN sorts above every number, so it counts as high."""
    return (
        F.when(utilization > 80, F.lit("High"))
        .when(utilization > 50, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )


def default_label(days: Column, threshold: int) -> Column:
    """1 if ``days`` reaches the threshold, 0 otherwise and where it is unknown."""
    return F.when(days >= threshold, F.lit(1)).otherwise(F.lit(0))
