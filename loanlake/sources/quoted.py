"""Records of CSV files whose quoted text has line breaks, read by many tasks per file.

A line begins a record if the quotes before it in its file come in pairs; doubled quotes inside quoted text are pairs
too. Files are read by line in byte ranges. One pass adds up the parity of each range, a prefix sum over the ranges of a
file gives the parity at the start of each, and a running sum inside a range that at each of its lines. Lines that are
whole records are done then. The others are numbered by record, again by prefix sums over ranges, and joined.

A quote that is never closed makes the rest of its file one record, as it does for any reader; a record of more than
``most_lines`` lines is an error that names the file.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlake.sources.scratch import scratch_root

MOST_LINES = 100_000
_RANGE = ["file", "start"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, start`` of the byte range, ``at``, which orders the lines of a range, ``value`` and whether it has an
    ``odd`` number of quotes."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value", (quotes % 2).alias("odd"),
    )


def _before(ranges: DataFrame, column: str, name: str) -> DataFrame:
    """The sum of ``column`` over the ranges of the same file before each one; a row per range."""
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.select(*_RANGE, F.coalesce(F.sum(column).over(earlier), F.lit(0)).alias(name))


def quoted_records(spark: SparkSession, path: str, most_lines: int = MOST_LINES) -> DataFrame:
    """``file, record, first``: the text of each record without its line end, and whether it is its file's first.

    Blank lines between records are left out. Line breaks inside of quotes stay, as one character in a file whose first
    line ends in two.
    """
    lines = _lines(spark, path)
    parity = _before(lines.groupBy(*_RANGE).agg(F.sum("odd").alias("odd")), "odd", "quotes")
    inside = Window.partitionBy(*_RANGE).orderBy("at")
    earlier = F.coalesce(F.sum("odd").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(parity, _RANGE).select(
        *_RANGE, "at", "value", "odd", ((F.col("quotes") + earlier) % 2 == 1).alias("goes_on"),
        ((F.col("start") == 0) & (F.row_number().over(inside) == 1)).alias("first"),
    )
    # Read three times from here on: written instead of sorted again.
    folder = f"{scratch_root(spark)}/lines"
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)
    whole = ~F.col("goes_on") & (F.col("odd") == 0)
    alone = placed.where(whole).select("file", F.col("value").alias("record"), "first")
    parts = placed.where(~whole).withColumn("opens", (~F.col("goes_on")).cast("long"))
    numbers = _before(parts.groupBy(*_RANGE).agg(F.sum("opens").alias("opens")), "opens", "opened")
    number = F.sum("opens").over(inside) + F.col("opened")
    numbered = parts.join(numbers, _RANGE).withColumn("number", number)
    line = F.struct("start", "at", "value")
    joined = numbered.groupBy("file", "number").agg(
        F.count("*").alias("n"), F.max("first").alias("first"), F.sort_array(F.collect_list(line)).alias("lines")
    )
    too_long = F.raise_error(F.concat(F.lit(f"a record of more than {most_lines} lines in "), F.col("file")))
    text = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    joined = joined.select("file", F.when(F.col("n") > most_lines, too_long.cast("string")).otherwise(text).alias("record"), "first")
    # A row per file with lines that end in two characters, which are read as one, as the reader of whole files does.
    two = placed.where(F.col("first") & F.col("value").endswith("\r")).select("file", F.lit(True).alias("two"))
    record = F.when(F.col("two"), F.replace("record", F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
    records = alone.unionByName(joined).join(two, "file", "left")
    records = records.select("file", F.regexp_replace(record, r"\r\z", "").alias("record"), "first")
    return records.where(F.trim("record") != "")


def parsed_records(records: DataFrame, header: list[str], schema: str, options: dict[str, str]) -> DataFrame:
    """The columns of each record that is no header, parsed by Spark; a file with another header is an error."""
    names = ", ".join(f"`_c{i}` string" for i in range(len(header)))
    first = F.from_csv("record", F.lit(names), options)
    same = [F.coalesce(first[f"_c{i}"], F.lit("")) == F.lit(name) for i, name in enumerate(header)]
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("file")))
    is_header = F.forall(F.array(*same), lambda x: x)
    kept = records.where(~F.col("first") | F.when(is_header, F.lit(False)).otherwise(wrong.cast("boolean")))
    return kept.select(F.from_csv("record", F.lit(schema), options).alias("row")).select("row.*")
