"""Edge values of each expression, with ANSI mode on and off."""

import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from loanlake.functions import calendar, loans, text


def apply(spark, build, kinds, values):
    """Evaluate ``build`` on columns a, b, ... of the given rows, in order."""
    names = "abcdef"[: len(kinds)]
    schema = "i int, " + ", ".join(f"{name} {kind}" for name, kind in zip(names, kinds))
    data = [(i, *(value if isinstance(value, tuple) else (value,))) for i, value in enumerate(values)]
    df = spark.createDataFrame(data, schema).repartition(1)
    return [row[0] for row in df.sort("i").select(build(*[F.col(name) for name in names])).collect()]


TEXT_CASES = {
    "parse_int": (
        text.parse_int,
        [None, "", "24_", "24.0", " 24 ", "-3.9", "+7", ".5", ".", "-", "1e2", "24d", "2147483648", "\t5", "1_000"],
        [None, None, None, 24, 24, -3, 7, 0, 0, None, None, None, None, 5, None],
    ),
    "valid_age": (
        text.valid_age,
        [None, "", "24_", "24.0", " 24 ", "-500", "121", "120", "0"],
        [0, 0, 0, 24, 24, 0, 0, 120, 0],
    ),
    "count": (
        lambda c: text.parse_int(text.zero_if_blank(c)),
        ["3_", None, "", "-100", "4"],
        [None, 0, 0, -100, 4],
    ),
    "money": (
        lambda c: text.parse_float(text.zero_if_blank(text.strip_underscores(c))),
        ["10000_", "__10000__", "_", "", None, "abc", "1_0", "1e3"],
        [10000.0, 10000.0, 0.0, 0.0, 0.0, None, 10.0, 1000.0],
    ),
    "decimal": (
        lambda c: text.parse_float(text.zero_if_null(c)),
        [None, "", "0.5", "7_", "inf"],
        [0.0, None, 0.5, None, math.inf],
    ),
    "clean_id": (text.clean_id, [" cus_1 ", "  ", None], ["CUS_1", "", None]),
    "occupation": (
        text.occupation,
        [None, "_______", "Media_Manager", " Teacher "],
        ["Unknown", "", "Media Manager", "Teacher"],
    ),
    "credit_mix": (
        text.credit_mix,
        ["_", "good", "Good", "Bad", "Standard", None],
        ["Unknown", "Unknown", "Good", "Bad", "Standard", "Unknown"],
    ),
    "minimum_payment": (
        text.minimum_payment,
        ["NM", " no ", "No", "Yes", None],
        ["No", "NO", "NO", "YES", "Unknown"],
    ),
    "payment_behaviour": (text.payment_behaviour, [None, " a ", "!@9#%8"], ["Unknown", "a", "!@9#%8"]),
    "loan_types": (text.loan_types, [None, "", " x ", " "], ["None", "None", "x", ""]),
    "credit_age": (
        text.credit_age_years,
        ["22 Years and 1 Months", "1 Year and 3 Months", "NA", None, "22Years", "22.5 Years"],
        [22, 0, 0, 0, None, 22],
    ),
}


@pytest.mark.parametrize("name", TEXT_CASES)
def test_text(spark, any_ansi, name):
    build, values, expected = TEXT_CASES[name]
    assert apply(spark, build, ["string"], values) == expected


def test_months_on_book(spark, any_ansi):
    starts = [date(2023, 1, 1), date(2023, 1, 2), date(2022, 8, 31), date(2023, 2, 15), None]
    snapshots = [date(2023, 7, 1), date(2023, 7, 1), date(2023, 2, 28), date(2023, 1, 1), date(2023, 1, 1)]
    pairs = list(zip(snapshots, starts))
    assert apply(spark, loans.months_on_book, ["date", "date"], pairs) == [6, 5, 6, -1, None]


def test_installments_missed(spark, any_ansi):
    pairs = [(100.0, 100.0), (101.0, 100.0), (0.0, 100.0), (100.0, 0.0), (0.0, 0.0), (None, 1.0), (300.0, 100.0)]
    assert apply(spark, loans.installments_missed, ["double", "double"], pairs) == [1, 2, 0, 0, 0, 0, 3]


def _dpd(snapshot, overdue, due):
    missed = loans.installments_missed(overdue, due)
    return loans.days_past_due(snapshot, overdue, loans.first_missed_date(snapshot, missed))


def test_days_past_due(spark, any_ansi):
    cases = [
        (date(2023, 3, 1), 100.0, 100.0),
        (date(2024, 3, 1), 100.0, 100.0),
        (date(2023, 5, 1), 100.0, 100.0),
        (date(2023, 8, 1), 100.0, 100.0),
        (date(2023, 8, 1), 100.0, 0.0),
        (date(2023, 8, 1), 0.0, 100.0),
    ]
    days = apply(spark, _dpd, ["date", "double", "double"], cases)
    assert days == [28, 29, 30, 31, None, 0]
    label = lambda a, b, c: loans.default_label(_dpd(a, b, c), 30)
    assert apply(spark, label, ["date", "double", "double"], cases) == [0, 0, 1, 1, 0, 0]


def test_more_installments_than_an_int_holds(spark, any_ansi):
    """A plain cast would wrap around to a date that does not exist; the number counts as unknown instead."""
    case = [(date(2023, 8, 1), 1e12, 0.1)]
    assert apply(spark, lambda a, b, c: loans.installments_missed(b, c), ["date", "double", "double"], case) == [0]
    assert apply(spark, _dpd, ["date", "double", "double"], case) == [None]


def test_non_negative(spark, any_ansi):
    found = apply(spark, loans.non_negative, ["double"], [-5.0, None, 7.0, math.nan])
    assert found[:3] == [0.0, 0.0, 7.0] and math.isnan(found[3])


def test_ratio_keeps_the_32_bit_product(spark, any_ansi):
    found = apply(spark, loans.yearly_share, ["float", "float"], [(0.1, 3.0), (0.1, 0.0), (0.1, -1.0)])
    assert found == [0.40000001589457196, 0.0, 0.0]


def test_risk_band(spark, any_ansi):
    values = [80.0, 80.5, 50.0, 50.5, math.nan, None]
    assert apply(spark, loans.risk_band, ["float"], values) == ["Medium", "High", "Low", "Medium", "High", "Low"]


def test_calendar(spark):
    assert calendar.month_starts("2023-01-15", "2023-03-01") == [date(2023, m, 1) for m in (1, 2, 3)]
    assert len(calendar.month_starts("2023-01-01", "2024-12-01")) == 24
    assert calendar.month_starts("2023-02-01", "2023-01-01") == []
    for start, end in [("2023-11-20", "2024-02-01"), ("2023-02-01", "2023-01-01"), ("2023-01-01", "2024-12-31")]:
        table = calendar.snapshot_calendar(spark, start, end)
        assert sorted(row[0] for row in table.collect()) == calendar.month_starts(start, end)
    with pytest.raises(ValueError):
        calendar.month_starts("2023-13-01", "2024-01-01")
