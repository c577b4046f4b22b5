"""Text clean-up and recoding expressions.

All of them give the same value whether ``spark.sql.ansi.enabled`` is on or off: text that is no number becomes NULL
and never an error.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal number as text, blanks around it ignored, and its whole part; a whole number as text.
_DECIMAL_TEXT = r"^[\x00-\x20]*(?<sign>[+-]?)(?<digits>[0-9]*)[.][0-9]*[\x00-\x20]*$"
_WHOLE_PART = "${sign}0${digits}"
_WHOLE_TEXT = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"

# Credit mixes that are kept.
CREDIT_MIXES = ["Bad", "Good", "Standard"]


def clean_id(c: Column) -> Column:
    """Upper-case an id and cut the blanks around it."""
    return F.trim(F.upper(c))


def whole_part(c: Column) -> Column:
    """Text of a number without its decimals: ``'24.9'`` gives ``'024'``. Other text stays as it is."""
    return F.regexp_replace(c, _DECIMAL_TEXT, _WHOLE_PART)


def whole_number(c: Column) -> Column:
    """Whole number held as text, NULL if it is none.

    The pattern is tested before the cast, as a failing cast raises and catches an error for each row.
    """
    return F.when(c.rlike(_WHOLE_TEXT), c.try_cast("int"))


def parse_int(c: Column) -> Column:
    """Whole part of a number held as text: ``' 24 '`` and ``'24.9'`` give 24, ``'24_'`` gives NULL."""
    return whole_number(whole_part(c))


def parse_float(c: Column) -> Column:
    """32-bit float held as text; NULL if it is none."""
    return c.try_cast("float")


def strip_underscores(c: Column) -> Column:
    return F.translate(c, "_", "")


def null_as_zero(c: Column, kind: str) -> Column:
    """NULL becomes 0 without widening the column type ``kind``."""
    return F.coalesce(c, F.lit(0).cast(kind))


def zero_if_null(c: Column) -> Column:
    """Text of a number, ``0`` where it is missing. Unreadable text stays as it is."""
    return F.coalesce(c, F.lit("0"))


def zero_if_blank(c: Column) -> Column:
    """Like :func:`zero_if_null`, with empty text counted as missing."""
    return zero_if_null(F.nullif(c, F.lit("")))


def valid_age(c: Column) -> Column:
    """Age in years, 0 where it is missing, unreadable or outside 0 to 120."""
    years = parse_int(c)
    return F.when(years.between(0, 120), years).otherwise(F.lit(0))


def unknown_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit("Unknown"))


def occupation(c: Column) -> Column:
    """Underscores become blanks. A value of underscores only ends up empty, not ``Unknown``."""
    return unknown_if_null(F.trim(F.translate(c, "_", " ")))


def credit_mix(c: Column) -> Column:
    """Only the exact spellings of :data:`CREDIT_MIXES` are kept."""
    return F.when(c.isin(CREDIT_MIXES), c).otherwise(F.lit("Unknown"))


def minimum_payment(c: Column) -> Column:
    """``NM`` becomes ``No``; everything else is upper-cased, so a plain ``No`` becomes ``NO``."""
    return unknown_if_null(F.when(c == "NM", F.lit("No")).otherwise(F.trim(F.upper(c))))


def payment_behaviour(c: Column) -> Column:
    return unknown_if_null(F.trim(c))


def loan_types(c: Column) -> Column:
    return F.coalesce(F.trim(F.nullif(c, F.lit(""))), F.lit("None"))


def credit_age_text(c: Column) -> Column:
    """What stands before `` Years`` in ``'22 Years and 1 Months'``, ``0`` where no ``Years`` is named."""
    years = whole_part(F.substring_index(c, " Years", 1))
    return F.when(c.contains("Years"), years).otherwise(F.lit("0"))


def credit_age_years(c: Column) -> Column:
    return whole_number(credit_age_text(c))
