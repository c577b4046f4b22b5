"""Expressions on random dirty values against plain casts with ANSI mode off, which is what they stand for."""

import math
import random

import pytest
from pyspark.sql import functions as F

from loanlake.functions import loans, text

CHARACTERS = "0123456789" * 3 + "..+-__ e\tNad"


@pytest.fixture(scope="module")
def values(spark):
    draw = random.Random(7)
    texts = ["".join(draw.choices(CHARACTERS, k=draw.randint(0, 7))) for _ in range(3000)]
    texts += [f"{draw.randint(-200, 10**11)}{tail}" for tail in ("", "_", ".0", ".75", " ", "f") for _ in range(200)]
    texts += [f"{t} Years and 3 Months" for t in texts[:1500]] + ["NaN", "inf", "-inf", "Infinity", None, "Years"]
    # More installments than an int holds are another case, see test_expressions.
    amounts = [0.0, 1.0, 0.1, 0.3, 100.0, 250.5, 1e8, None]
    rows = [(t, draw.choice(amounts), draw.choice(amounts)) for t in texts]
    return spark.createDataFrame(rows, "c string, overdue double, due double").repartition(4)


PLAIN = {
    "parse_int": (text.parse_int, "cast(c as int)"),
    "parse_float": (text.parse_float, "cast(c as float)"),
    "valid_age": (
        text.valid_age,
        "case when coalesce(cast(c as int), 0) not between 0 and 120 then 0 else coalesce(cast(c as int), 0) end",
    ),
    "money": (
        lambda c: text.parse_float(text.zero_if_blank(text.strip_underscores(c))),
        "if(c is null or replace(c, '_', '') = '', cast(0 as float), cast(replace(c, '_', '') as float))",
    ),
    "decimal": (
        lambda c: text.parse_float(text.zero_if_null(c)),
        "if(c is null, cast(0 as float), cast(c as float))",
    ),
    "whole": (
        lambda c: text.whole_part(text.zero_if_null(c)).try_cast("int"),
        "if(c is null, 0, cast(c as int))",
    ),
    "count": (
        lambda c: text.parse_int(text.zero_if_blank(c)),
        "if(c is null or c = '', 0, cast(c as int))",
    ),
    "credit_age": (
        text.credit_age_years,
        "if(c like '%Years%', cast(regexp_replace(c, ' Years.*', '') as int), 0)",
    ),
    "missed": (
        lambda c: loans.installments_missed(F.col("overdue"), F.col("due")),
        "coalesce(cast(ceil(overdue / due) as int), 0)",
    ),
}


def same(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("name", PLAIN)
def test_equals_plain_cast(spark, values, name):
    build, plain = PLAIN[name]
    before = spark.conf.get("spark.sql.ansi.enabled")
    found = {}
    try:
        for mode in ["true", "false"]:
            spark.conf.set("spark.sql.ansi.enabled", mode)
            expected = F.expr(plain) if mode == "false" else F.lit(None)
            rows = values.select("c", "overdue", "due", build(F.col("c")).alias("got"), expected.alias("want")).collect()
            found[mode] = rows
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    wrong = [tuple(row) for row in found["false"] if not same(row["got"], row["want"])]
    assert wrong == []
    assert all(same(a["got"], b["got"]) for a, b in zip(found["true"], found["false"]))
