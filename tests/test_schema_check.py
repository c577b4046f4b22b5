"""Types that fit the values of a text source."""

from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from loanlake.operators.schema_check import KINDS, kind, schema_drift


def of(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    return [row[0] for row in df.select(kind(df.c)).collect()]


def test_kinds(spark, any_ansi):
    assert of(spark, None, "", "  ") == ["missing"] * 3
    assert of(spark, "1", " -7 ", "+2147483647") == ["int"] * 3
    assert of(spark, "2147483648", "-9223372036854775808") == ["bigint"] * 2
    assert of(spark, "9223372036854775808") == ["double"]
    assert of(spark, "1.", ".5", "-2.50", "1e3", "7E-2") == ["double"] * 5
    assert of(spark, "2024-02-29", " 1996-01-01 ") == ["date"] * 2
    assert of(spark, "2023-02-29", "12_", "x", "NaN", "1,5", "1.2.3", "2023-1-1") == ["string"] * 7
    assert set(KINDS) >= {"missing", "string"}


def test_drift(spark, any_ansi):
    rows = [("1", "5", "2024-01-01", "9", "x", None), ("2", "6.5", "2024-01-02", None, "2024-01-01", None),
            ("3000000000", "7", "soon", "", "1", None)]
    text = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")
    kinds = {"a": IntegerType(), "b": DoubleType(), "c": DateType(), "d": LongType(), "e": StringType(), "f": DateType(),
             "gone": IntegerType()}
    schema = StructType([StructField(k, t) for k, t in kinds.items()])
    found = {r["column_name"]: tuple(r)[1:] for r in schema_drift(text, schema).collect()}
    assert found == {
        "a": ("int", 3, 0, 1, "bigint"), "b": ("double", 3, 0, 0, "double"), "c": ("date", 3, 0, 1, "string"),
        "d": ("bigint", 1, 2, 0, "int"), "e": ("string", 3, 0, 0, "string"), "f": ("date", 0, 3, 0, "void"),
        "gone": ("int", None, None, None, None),
    }
    empty = {r["column_name"]: r["n_values"] for r in schema_drift(text.limit(0), schema).collect()}
    assert empty == dict.fromkeys(kinds)
