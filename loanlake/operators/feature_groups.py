"""The feature store with the rows of a customer and month as one row of lists.

Each loan of a customer and month meets each row of that key in three tables, so n rows of a key in every table give n to
the fourth features; all blank ids of a month are one key. A group has the key and four lists, one a table, and stands
for every combination of their elements. Building, writing, counting and fingerprinting groups takes time and space in
proportion to the rows of the four tables; only :func:`expand` makes the features one by one.

Elements are final: filled, with ratios and risk band, which all follow from the columns of one table. A loan without rows in
a table has one element of filled values there. Keys with more rows than a list should have are hot keys of
``operators.joins``: their rows are dealt into lists, and there is a group of every combination of lists. Exact copies that
one task reads stay in one list. The order within lists is arbitrary. Without rows there are no groups.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from loanlake import schemas as s
from loanlake.functions import loans as fn
from loanlake.operators import gold
from loanlake.operators.joins import SkewPolicy, spread

PARTS = ["loans", "clickstream", "attributes", "financials"]
RATIOS = ["income_to_loan_ratio", "debt_to_income_ratio", "credit_utilization_risk"]
#: Rows of a key from which on a table's rows are dealt into several lists: a few megabytes a list.
LIST_ROWS = 20_000


def part_columns(schema: StructType) -> dict[str, list[str]]:
    """The columns of a feature store by the table that they come from; those that no other table has are clickstream's."""
    own = {
        "loans": s.LOAN_FEATURES, "attributes": s.ATTRIBUTE_FEATURES, "financials": [*s.FINANCIAL_FEATURES, *RATIOS],
    }
    table = {name: part for part, names in own.items() for name in names}
    rest = [name for name in schema.names if name not in s.CUSTOMER_MONTH]
    return {part: [name for name in rest if table.get(name, "clickstream") == part] for part in PARTS}


def group_schema(schema: StructType) -> StructType:
    """Of the groups of a feature store with the given schema."""
    lists = [
        StructField(part, ArrayType(StructType([schema[name] for name in names])))
        for part, names in part_columns(schema).items()
    ]
    return StructType([schema[s.CUSTOMER], *lists, schema[s.SNAPSHOT]])


def _no_match(schema: StructType, names: list[str]) -> Column:
    """The element of a table for loans without rows there."""

    def filled(name: str) -> Column:
        if name in s.TEXT_FEATURES:
            return F.lit("Unknown")
        return F.lit(0 if name in s.NUMBER_FEATURES else None).cast(schema[name].dataType)

    def value(name: str) -> Column:
        if name == "income_to_loan_ratio":
            return fn.yearly_share(filled("Total_EMI_per_month"), filled("Annual_Income"))
        if name == "debt_to_income_ratio":
            return fn.income_share(filled("Outstanding_Debt"), filled("Annual_Income"))
        if name == "credit_utilization_risk":
            return fn.risk_band(filled("Credit_Utilization_Ratio"))
        return filled(name)

    return F.array(F.struct(*[value(name).alias(name) for name in names]))


def feature_groups(
    applications: DataFrame,
    clickstream: DataFrame,
    attributes: DataFrame,
    financials: DataFrame,
    schema: StructType = s.GOLD["feature_store"],
    hot: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """The groups of :func:`gold.features_of`. ``hot`` maps table names (``"left"`` for the applications) to keys with many
    rows; without it this runs no job and a key has one list a table."""
    customers = gold.customer_features(clickstream, attributes, financials)
    tables = {
        "loans": gold.fill_features(applications),
        "clickstream": customers["clickstream"],
        "attributes": gold.fill_features(customers["attributes"]),
        "financials": gold.add_risk_band(gold.add_ratios(gold.fill_features(customers["financials"]))),
    }
    columns, hot, groups = part_columns(schema), hot or {}, None
    for part, rows in tables.items():
        keys, many = list(s.CUSTOMER_MONTH), hot.get("left" if part == "loans" else part)
        if many is not None:
            rows, keys = spread(rows, s.CUSTOMER_MONTH, many, "_list"), [*keys, "_list"]
        lists = rows.groupBy(*keys).agg(F.collect_list(F.struct(*columns[part])).alias(part)).drop("_list")
        groups = lists if groups is None else groups.join(lists, s.CUSTOMER_MONTH, "left")
    kinds = group_schema(schema)
    matched = {
        part: F.coalesce(F.col(part), _no_match(schema, columns[part])).cast(kinds[part].dataType) for part in PARTS[1:]
    }
    return groups.withColumns(matched).select(*kinds.names)


def of_rows(features: DataFrame) -> DataFrame:
    """A group of each row of a feature store."""
    lists = [F.array(F.struct(*names)).alias(part) for part, names in part_columns(features.schema).items()]
    return features.select(s.CUSTOMER, *lists, s.SNAPSHOT)


def expand(groups: DataFrame, schema: StructType) -> DataFrame:
    """The features that groups stand for, with the given schema."""
    return _inlined(groups, PARTS).select(*schema.names)


def _inlined(groups: DataFrame, parts: list[str]) -> DataFrame:
    """The combinations of the elements of these lists, made one at a time.

    Generated code keeps all rows that it makes of one input row until the last of them is made, which for several lists
    in a row is every combination of a group. ``transform`` is not part of generated code, so lists but the last are
    taken apart row by row as rows are asked for, and what is kept is one list's rows at most.
    """
    for part in parts:
        elements = F.col(part) if part == parts[-1] else F.transform(part, lambda element: element)
        groups = groups.select(*[name for name in groups.columns if name != part], F.inline(elements))
    return groups


def training_set(
    groups: DataFrame, labels: DataFrame, schema: StructType, policy: SkewPolicy | None = None
) -> DataFrame:
    """The :func:`gold.training_set` of the features that groups stand for.

    Labels are joined to the loans of the lists, each list once, and labelled loans meet the other lists of their groups by
    the key and a digest of their list. So lists are shuffled, not features. Lists of a key that are equal have one digest:
    their loans have the same labels.
    """
    digest = F.sha2(F.to_json("loans", {"ignoreNullFields": "false"}), 256)
    keyed, keys = groups.withColumn("_list", digest), [*s.CUSTOMER_MONTH, "_list"]
    loans = keyed.select(*keys, "loans").dropDuplicates(keys).select(*keys, F.inline("loans"))
    labelled = gold.training_set(loans, labels, policy).join(keyed.drop("loans"), keys)
    own = [name for name in schema.names if name != s.LOAN]
    return _inlined(labelled, PARTS[1:]).select(s.LOAN, *own, *s.LABELS)


def _combinations(parts: list[str]) -> Column:
    return reduce(Column.__mul__, [F.size(part).cast("long") for part in parts])


def row_counts(groups: DataFrame) -> DataFrame:
    """``snapshot_date, n_stored, n``: groups, and features that they stand for, from the lengths of their lists."""
    n = F.sum(_combinations(PARTS)).alias("n")
    return groups.groupBy(s.SNAPSHOT).agg(F.count("*").alias("n_stored"), n)


def fingerprints(groups: DataFrame) -> DataFrame:
    """``snapshot_date, fingerprint``: the number of features and a sum of hashes, however their rows are grouped.

    The hash of a feature is the sum of a hash of the key and the columns of each table. A group has every combination, so a
    hash of an element counts as often as the other lists have combinations. Hashes have 48 bits and sums 128.
    """
    parts = []
    for part in PARTS:
        times = _combinations([other for other in PARTS if other != part]).alias("_times")
        rows = groups.select(*s.CUSTOMER_MONTH, times, F.inline(part))
        own = [name for name in rows.columns if name not in (s.SNAPSHOT, "_times")]
        hashed = F.xxhash64(F.lit(part), *own, *[F.col(name).isNull() for name in own])
        value = F.pmod(hashed, F.lit(1 << 48)).cast("decimal(15,0)") * F.col("_times").cast("decimal(19,0)")
        n = F.col("_times") if part == "loans" else F.lit(0).cast("long")
        parts.append(rows.select(s.SNAPSHOT, n.alias("n"), value.alias("value")))
    found = reduce(DataFrame.unionAll, parts).groupBy(s.SNAPSHOT).agg(F.sum("n").alias("n"), F.sum("value").alias("total"))
    return found.select(s.SNAPSHOT, F.concat_ws(":", "n", F.col("total").cast("string")).alias("fingerprint"))
