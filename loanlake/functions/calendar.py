"""Snapshot months: the first day of every month of a range."""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.schemas import SNAPSHOT


def as_date(day: str | date) -> date:
    """Check and convert a ``yyyy-MM-dd`` argument."""
    return day if isinstance(day, date) else date.fromisoformat(day)


def month_starts(start: str | date, end: str | date) -> list[date]:
    """Every first of month from the month of ``start`` up to ``end``, inclusive."""
    first, last = as_date(start), as_date(end)
    span = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [date(n // 12, n % 12 + 1, 1) for n in span]


def month_sequence(start: Column, end: Column) -> Column:
    """Array of the month starts from the month of ``start`` up to ``end``; empty if ``end`` comes first."""
    first = F.trunc(start, "MM").cast("date")
    months = F.sequence(first, end, F.expr("interval 1 month"))
    return F.when(first <= end, months).otherwise(F.array().cast("array<date>"))


def snapshot_calendar(spark: SparkSession, start: str | date, end: str | date) -> DataFrame:
    """The months of :func:`month_starts` as a one-column table."""
    bounds = F.lit(as_date(start)), F.lit(as_date(end))
    return spark.range(1).select(F.explode(month_sequence(*bounds)).alias(SNAPSHOT))


def data_calendar(df: DataFrame) -> DataFrame:
    """Every month from the earliest to the latest snapshot in ``df``, those without rows included."""
    bounds = df.agg(F.min(SNAPSHOT).alias("first"), F.max(SNAPSHOT).alias("last"))
    return bounds.select(F.explode(month_sequence(F.col("first"), F.col("last"))).alias(SNAPSHOT))
