"""Row counts by stage and month, table profiles and the label distribution."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake import schemas as s
from loanlake.functions.calendar import data_calendar
from loanlake.operators import gold, silver

STAGE = ["layer", "table_name", "stage"]


def label_distribution(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count("*").alias("n"))


def month_counts(df: DataFrame, stages: dict[tuple[str, str, str], Column]) -> DataFrame:
    """Rows per month that satisfy each stage's condition, in a single pass over ``df``.

    ``stages`` maps (layer, table, stage) to a condition.
    """
    names = [f"n{i}" for i in range(len(stages))]
    counted = [F.count_if(condition).alias(name) for name, condition in zip(names, stages.values())]
    wide = df.groupBy(s.SNAPSHOT).agg(*counted)
    rows = F.array(
        *[
            F.struct(*[F.lit(part).alias(column) for part, column in zip(stage, STAGE)], F.col(name).alias("n"))
            for stage, name in zip(stages, names)
        ]
    )
    return wide.select(s.SNAPSHOT, F.inline(rows))


def _all_present(*names: str) -> Column:
    return reduce(Column.__and__, [F.col(name).isNotNull() for name in names])


def layer_row_audit(bronze: dict[str, DataFrame], mob: int = 6) -> DataFrame:
    """Rows that should go in and out of every stage by month, 0 where a month has none; from bronze alone.

    What has been written is counted by :func:`written_row_audit`.

    Counts that come from the same table share one scan. Only the final features need a join, of the counts of each key.
    """
    everything = F.lit(True)
    clean = {
        "clickstream": _all_present(*s.CUSTOMER_MONTH),
        "attributes": _all_present(*s.CUSTOMER_MONTH),
        "financials": _all_present(*s.CUSTOMER_MONTH),
        "loans": _all_present(s.CUSTOMER, s.LOAN, s.SNAPSHOT),
    }
    counts, listed = [], [("gold", "feature_store", "output")]
    for table, condition in clean.items():
        stages = {("bronze", table, "slice"): everything, ("silver", table, "input"): everything}
        stages[("silver", table, "output")] = condition
        stages[("gold", "feature_store", f"{table}_input")] = condition
        source = bronze[table]
        if table == "loans":
            source = silver.add_months_on_book(source)
            at_application = condition & (F.coalesce("installment_num", F.lit(0)) == 0)
            at_mob = condition & (F.col("mob") == mob)
            stages[("gold", "feature_store", "at_application")] = at_application
            stages[("gold", "feature_store", "base")] = at_application
            stages[("gold", "label_store", "input")] = condition
            stages[("gold", "label_store", "at_mob")] = at_mob
            stages[("gold", "label_store", "output")] = at_mob
        counts.append(month_counts(source, stages))
        listed.extend(stages)
    tables = {name: clean_table(bronze[name]) for name, clean_table in silver.CLEANERS.items()}
    final = gold.feature_counts(**tables)
    counts.append(final.select(s.SNAPSHOT, *[F.lit(part).alias(c) for part, c in zip(listed[0], STAGE)], "n"))
    found = reduce(DataFrame.unionByName, counts)

    labels = F.array(*[F.struct(*[F.lit(part).alias(c) for part, c in zip(stage, STAGE)]) for stage in listed])
    # Months times stages, a few thousand rows.
    expected = data_calendar(bronze["loans"]).select(s.SNAPSHOT, F.inline(labels))
    return expected.join(found, [s.SNAPSHOT, *STAGE], "left").select(
        s.SNAPSHOT, *STAGE, F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def _counted(df: DataFrame, layer: str, table: str, name: str) -> DataFrame:
    n = F.count("*").alias(name)
    return df.groupBy(s.SNAPSHOT).agg(n).select(
        s.SNAPSHOT, F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), name
    )


def _sized(counts: DataFrame, layer: str, table: str, name: str) -> DataFrame:
    return counts.select(
        s.SNAPSHOT, F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.col("n").alias(name)
    )


def written_row_audit(
    sources: dict[str, DataFrame],
    written: dict[str, dict[str, DataFrame]],
    months: DataFrame,
    mob: int = 6,
    sizes: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows that each written table has and should have, by month, and rows of the sources outside all months.

    This is the check of :func:`stage_counts`, which the writes leave: it counts sources and tables again, each in one
    pass. What a table should have follows from the written tables below it: bronze from the sources, silver from the keys
    in bronze, features from the applications and the customer rows that each of them meets, labels from the age of
    loans. ``n_missing`` is the difference. Source rows whose date is unreadable or in none of ``months`` are counted
    as layer ``rejected`` without a month; nothing of them should be written. ``sizes`` has ``snapshot_date, n`` of gold
    tables that can be counted without their rows, see ``Lake.row_counts``; the others are counted.
    """
    clean = {name: _all_present(*s.CUSTOMER_MONTH) for name in sources}
    clean["loans"] = _all_present(s.CUSTOMER, s.LOAN, s.SNAPSHOT)
    expected, counted, found = [], [], []
    listed = F.broadcast(months.withColumn("_listed", F.lit(True)))
    for name, rows in sources.items():
        # A row per month and one for the rest: the dates are joined before they are counted, in one pass.
        place = F.when(F.col("_listed"), F.col(s.SNAPSHOT)).alias(s.SNAPSHOT)
        placed = rows.select(s.SNAPSHOT).join(listed, s.SNAPSHOT, "left").select(place)
        of_source = placed.groupBy(s.SNAPSHOT).agg(F.count("*").alias("n_expected"))
        found.append(of_source.select(
            s.SNAPSHOT, F.when(F.col(s.SNAPSHOT).isNull(), "rejected").otherwise("bronze").alias("layer"),
            F.lit(name).alias("table_name"), "n_expected",
        ))
        expected.append(_counted(written["bronze"][name].where(clean[name]), "silver", name, "n_expected"))
        counted.append(_counted(written["bronze"][name], "bronze", name, "n_counted"))
        counted.append(_counted(written["silver"][name], "silver", name, "n_counted"))
    loans = written["silver"]["loans"]
    features = gold.feature_counts(**written["silver"])
    expected.append(_sized(features, "gold", "feature_store", "n_expected"))
    expected.append(_counted(loans.where(F.col("mob") == mob), "gold", "label_store", "n_expected"))
    for name in s.GOLD:
        if sizes and name in sizes:
            counted.append(_sized(sizes[name], "gold", name, "n_counted"))
        else:
            counted.append(_counted(written["gold"][name], "gold", name, "n_counted"))
    key = [s.SNAPSHOT, "layer", "table_name"]
    # Every source has a row for the rejected, also if there are none. Months times tables, a few thousand rows.
    none = sources[next(iter(sources))].sparkSession.createDataFrame(
        [(None, "rejected", name) for name in sources], "snapshot_date date, layer string, table_name string"
    )
    expected = reduce(DataFrame.unionAll, [*found, *expected]).unionByName(none, allowMissingColumns=True)
    expected = expected.groupBy(*key).agg(F.sum("n_expected").alias("n_expected"))
    counted = reduce(DataFrame.unionAll, counted)
    same = reduce(Column.__and__, [F.col(f"e.{c}").eqNullSafe(F.col(f"c.{c}")) for c in key])
    everything = expected.alias("e").join(counted.alias("c"), same, "full_outer").select(
        *[F.coalesce(f"e.{c}", f"c.{c}").alias(c) for c in key], "n_expected", "n_counted"
    )
    n = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_expected", "n_counted")}
    return everything.select(*key, *[x.alias(c) for c, x in n.items()]).withColumn(
        "n_missing", F.when(F.col("layer") == "rejected", F.lit(0)).otherwise(F.col("n_expected") - F.col("n_counted"))
    )


#: What a write's own counts are called in the audit, by layer and stage.
_STAGES = {
    ("bronze", "output"): "slice", ("silver", "input"): "input", ("silver", "output"): "output",
    ("gold", "at_application"): "at_application", ("gold", "output"): "output",
}


def stage_counts(log: DataFrame) -> DataFrame:
    """Rows that went in and out of every stage by month, as counted by the jobs that wrote them; no table is read.

    ``log`` is :meth:`Lake.latest`. What goes into a gold table is what came out of the silver ones. ``n`` is NULL where
    a write could not be sure of its counts. Source rows of no processed month are counted as layer ``rejected``,
    without a month.
    """
    noted = log.select(s.SNAPSHOT, "layer", "table_name", F.explode("counts").alias("stage", "n"))
    here = noted.where(F.col(s.SNAPSHOT).isNotNull())

    def renamed(rows: DataFrame, layer: Column, table: Column, stage: Column) -> DataFrame:
        return rows.select(s.SNAPSHOT, layer.alias("layer"), table.alias("table_name"), stage.alias("stage"), "n")

    names = F.create_map(*[F.lit(x) for (layer, stage), name in _STAGES.items() for x in (f"{layer}.{stage}", name)])
    name = names[F.concat_ws(".", "layer", "stage")]
    own = renamed(here.where(name.isNotNull()), F.col("layer"), F.col("table_name"), name)
    silver_out = here.where("layer = 'silver' AND stage = 'output'")
    gold_out = here.where("layer = 'gold'")
    gold_name, fs, ls = F.lit("gold"), F.lit("feature_store"), F.lit("label_store")
    parts = [
        own,
        renamed(silver_out, gold_name, fs, F.concat(F.col("table_name"), F.lit("_input"))),
        renamed(silver_out.where("table_name = 'loans'"), gold_name, ls, F.lit("input")),
        renamed(gold_out.where("stage = 'at_application'"), gold_name, fs, F.lit("base")),
        renamed(gold_out.where("table_name = 'label_store' AND stage = 'output'"), gold_name, ls, F.lit("at_mob")),
        renamed(
            noted.where(F.col(s.SNAPSHOT).isNull() & (F.col("stage") == "source")),
            F.lit("rejected"), F.col("table_name"), F.lit("source"),
        ),
    ]
    return reduce(DataFrame.unionAll, parts)


def logged_label_distribution(log: DataFrame) -> DataFrame:
    """:func:`label_distribution` of all published months, from what the writes have counted."""
    of = log.where("layer = 'gold' AND table_name = 'label_store'").select(F.explode("counts").alias("tag", "n"))
    labels = of.where("tag LIKE 'label=%' AND n > 0").withColumn("label", F.substring("tag", 7, 20).try_cast("int"))
    return labels.groupBy("label").agg(F.sum("n").alias("n"))


def logged_profile(log: DataFrame, columns: dict[str, int]) -> DataFrame:
    """:func:`dataset_profile` of gold tables with so many ``columns``, from the rows noted for each month."""
    rows = log.where("layer = 'gold'").groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"))
    known = F.create_map(*[F.lit(x) for item in columns.items() for x in item])
    return rows.select("table_name", "n_rows", known[F.col("table_name")].alias("n_columns"))


def _n_rows(name: str, df: DataFrame, sizes: dict[str, DataFrame] | None) -> DataFrame:
    if sizes and name in sizes:
        return sizes[name].agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    return df.agg(F.count("*").alias("n_rows"))


def dataset_profile(tables: dict[str, DataFrame], sizes: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows and columns of each table. ``sizes`` has ``snapshot_date, n`` of tables that needn't be counted row by row."""
    parts = [
        _n_rows(name, df, sizes).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def schema_report(tables: dict[str, DataFrame], sizes: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per column with its place, its type and the rows of its table; for ``sizes`` see :func:`dataset_profile`."""
    parts = []
    for name, df in tables.items():
        columns = [
            F.struct(
                F.lit(place).alias("ordinal"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
            )
            for place, field in enumerate(df.schema, start=1)
        ]
        counted = _n_rows(name, df, sizes)
        parts.append(counted.select(F.lit(name).alias("table_name"), F.inline(F.array(*columns)), "n_rows"))
    return reduce(DataFrame.unionAll, parts)
