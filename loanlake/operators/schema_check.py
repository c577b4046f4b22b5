"""What the values of a text source could be read as, next to what they are declared as.

Declared types spare the pass that inference takes, but a source that has drifted then fails a read late, or turns into
NULLs. This is that pass as an audit: every value has a kind, kinds of a column are counted in one scan, and the narrowest
type that holds them all follows from which kinds occur. Only a few counts per task and column are shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

MISSING, INT, LONG, DOUBLE, DATE, TEXT = KINDS = ["missing", "int", "bigint", "double", "date", "string"]

_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_DECIMAL = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
_DAY = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}\s*$"

#: The kinds that a column of a declared type can hold.
_FITTING = {
    "int": [MISSING, INT], "bigint": [MISSING, INT, LONG], "date": [MISSING, DATE],
    "float": [MISSING, INT, LONG, DOUBLE], "double": [MISSING, INT, LONG, DOUBLE],
}


def kind(c: Column) -> Column:
    """Of a value held as text. Patterns are tested before casts, as failing casts are slow."""
    whole = c.rlike(_WHOLE)
    return (
        F.when(c.isNull() | (F.trim(c) == ""), MISSING)
        .when(whole & F.trim(c).try_cast("int").isNotNull(), INT)
        .when(whole & F.trim(c).try_cast("bigint").isNotNull(), LONG)
        .when(c.rlike(_DECIMAL), DOUBLE)
        .when(c.rlike(_DAY) & F.trim(c).try_cast("date").isNotNull(), DATE)
        .otherwise(TEXT)
    )


def column_kinds(text: DataFrame) -> DataFrame:
    """``column_name, kind, n`` of all columns of a table of text."""
    values = [F.struct(F.lit(name).alias("column_name"), kind(F.col(f"`{name}`")).alias("kind")) for name in text.columns]
    return text.select(F.inline(F.array(*values))).groupBy("column_name", "kind").agg(F.count("*").alias("n"))


def narrowest(has: dict[str, Column]) -> Column:
    """The type that holds all kinds that occur: numbers widen, days mix with nothing, and text holds everything."""
    number = has[INT] | has[LONG] | has[DOUBLE]
    return (
        F.when(has[TEXT] | (has[DATE] & number), TEXT)
        .when(has[DATE], DATE)
        .when(has[DOUBLE], DOUBLE)
        .when(has[LONG], LONG)
        .when(has[INT], INT)
        .otherwise("void")
    )


def _fits(declared: DataType) -> list[str]:
    return _FITTING.get(declared.simpleString(), KINDS)


def schema_drift(text: DataFrame, schema: StructType) -> DataFrame:
    """Per declared column its declared and its narrowest type, values that are there, missing, and of a kind that the
    declared type cannot hold. A declared column that the source lacks has NULL instead of counts.
    """
    declared = [(f.name, f.dataType.simpleString(), _fits(f.dataType)) for f in schema]
    wanted = text.sparkSession.createDataFrame(declared, "column_name string, declared string, fitting array<string>")
    found = column_kinds(text.select(*[F.col(f"`{f.name}`") for f in schema if f.name in text.columns]))
    n = F.col("n")
    judged = found.join(F.broadcast(wanted), "column_name").groupBy("column_name").agg(  # a row per column and kind
        F.sum(F.when(F.col("kind") != MISSING, n).otherwise(0)).alias("n_values"),
        F.sum(F.when(F.col("kind") == MISSING, n).otherwise(0)).alias("n_missing"),
        F.sum(F.when(~F.array_contains("fitting", F.col("kind")), n).otherwise(0)).alias("n_misfits"),
        narrowest({k: F.bool_or(F.col("kind") == k) for k in KINDS}).alias("narrowest"),
    )
    return wanted.drop("fitting").join(judged, "column_name", "left")
