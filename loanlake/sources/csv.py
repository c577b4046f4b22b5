"""CSV files with a header, as sources and as an export format."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, NumericType, StringType, StructField, StructType

from loanlake import schemas as s
from loanlake.sources.quoted import parsed_records, quoted_records

# File names of the four sources.
SOURCE_FILES = {
    "clickstream": "feature_clickstream.csv",
    "attributes": "features_attributes.csv",
    "financials": "features_financials.csv",
    "loans": "lms_loan_daily.csv",
}


def read_text(spark: SparkSession, *paths: str, multi_line: bool = False) -> DataFrame:
    """All columns as text, named by the header. Blank and quoted empty fields are NULL."""
    return spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').csv(list(paths))


def read_source(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """A CSV source with the declared columns, found by name and in any order; unreadable values become NULL.

    One line is read to learn the header, there is no pass over the data. All parts must have that header: reading a
    part with the columns in another order fails, so no value gets into another column. Quotes in quoted text are
    doubled. ``multi_line`` allows line breaks in quoted text; records are then put together from lines, many tasks to
    a file, and the lines are written once in between.

    Numbers are parsed by the reader, whole ones by way of double so that ``5.0`` is accepted for 5. A number that is
    not whole or too large for such a column fails the read; it is never cut.
    """
    header = read_text(spark, path, multi_line=multi_line).columns
    missing = [field.name for field in schema if field.name not in header]
    if missing:
        raise ValueError(f"columns missing from the source: {', '.join(missing)}")
    numbers = [field.name for field in schema if isinstance(field.dataType, NumericType)]
    parsed = StructType(
        [StructField(name, DoubleType() if name in numbers else StringType()) for name in header]
    )
    if multi_line:
        names = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in parsed)
        raw = parsed_records(quoted_records(spark, path), header, names, {"escape": '"', "multiLine": "true"})
    else:
        raw = spark.read.schema(parsed).options(header=True, enforceSchema=False, escape='"').csv(path)
    return raw.select(*[_typed(F.col(field.name), field).alias(field.name) for field in schema])


def _typed(c: Column, field: StructField) -> Column:
    if isinstance(field.dataType, (StringType, DoubleType)):
        return c
    if isinstance(field.dataType, IntegerType):
        refused = F.raise_error(F.concat(F.lit(f"no 32-bit whole number in {field.name}: "), c.cast("string")))
        whole = (c % 1 == 0) & c.between(-(2**31), 2**31 - 1)
        return F.when(c.isNull(), F.lit(None)).when(whole, c.try_cast("int")).otherwise(refused.cast("int"))
    return c.try_cast(field.dataType)


def read_sources(
    spark: SparkSession, folder: str, schemas: dict[str, StructType] = s.BRONZE
) -> dict[str, DataFrame]:
    """The four sources below ``folder``."""
    return {
        name: read_source(spark, f"{folder.rstrip('/')}/{SOURCE_FILES[name]}", schema)
        for name, schema in schemas.items()
    }


def _one_line(name: str) -> Column:
    c = F.col(name)
    refused = F.raise_error(F.lit(f"text with a line break in {name} cannot be written as CSV"))
    return F.when(c.contains("\n") | c.contains("\r"), refused.cast("string")).otherwise(c)


def write_csv(df: DataFrame, path: str, by_month: bool = False, multi_line: bool = False, packed: int = 0) -> None:
    """CSV parts with a header that :func:`read_source` reads back unchanged, blanks around values included.

    ``by_month`` makes a folder of each month, of which other months stay when one is written again. Empty text is
    written like NULL, as a CSV source cannot tell them apart. Text with line breaks fails the write, since readers
    split files at line ends, unless ``multi_line`` says that they don't. With ``packed``, files are compressed and hold so
    many rows at most: a compressed file is read by one task.
    """
    texts = [field.name for field in df.schema if isinstance(field.dataType, StringType)]
    if not multi_line:
        df = df.withColumns({name: _one_line(name) for name in texts})
    writer = df.write.mode("overwrite").options(
        header=True, emptyValue="", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    if packed:
        # Two fifths less time than at the usual level, for a third more bytes.
        writer = writer.options(compression="gzip", maxRecordsPerFile=packed).option("zlib.compress.level", "BEST_SPEED")
    if by_month:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(s.SNAPSHOT)
    writer.csv(path)
