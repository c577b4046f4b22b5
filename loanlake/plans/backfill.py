"""The whole run from source files to gold tables over a range of months.

Every step handles all its months in one job per table, counts rows on the way, and publishes them together, so a lost
executor or a stopped run costs no more than the step at hand and no reader sees half of it. A range of one month re-runs
that month and leaves the others alone; ``plans.refresh`` finds the months that need it.
"""

import argparse
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake import schemas as s
from loanlake.functions.calendar import month_starts
from loanlake.operators import audit, feature_groups, gold
from loanlake.operators.joins import DEFAULT_POLICY, SkewPolicy, hot_keys, matching_rows
from loanlake.operators.silver import CLEANERS
from loanlake.sources.csv import read_sources
from loanlake.sources.lake import Lake, Staged, of_months
from loanlake.sources.tally import Tally

# The default range and label definition.
FIRST_MONTH = "2023-01-01"
LAST_MONTH = "2024-12-01"
LABEL_DPD = 30
LABEL_MOB = 6

# Rows from which on it pays to look up which customers have an application, before their rows are shuffled.
THIN_FROM = 5_000_000
CUSTOMER_TABLES = ["clickstream", "attributes", "financials"]
# Loans at application and at a given age are read from the ledger later: sorted by installment, both reads skip most
# of each file.
SILVER_ORDER = {"loans": ["installment_num"]}


def together[T](steps: list[Callable[[], T]]) -> list[T]:
    """Run independent writes at the same time, so that the last tasks of one leave no executor idle."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]


def stage_bronze(lake: Lake, table: str, rows: DataFrame, months: list[date], in_month_order: bool = False) -> Staged:
    """Source rows as received, by month; all rows of the source are counted on the way, whatever their date."""
    source = Tally()
    return lake.stage(
        source.watch(rows), "bronze", table, months, rebalance=not in_month_order, tallies={"source": source}
    )


def stage_silver(lake: Lake, table: str, months: list[date]) -> Staged:
    """Clean rows. Bronze files hold one month each, so a task writes few months and nothing is shuffled."""
    bronze = Tally()
    rows = CLEANERS[table](bronze.watch(lake.read("bronze", table, months)))
    return lake.stage(rows, "silver", table, months, sort_by=SILVER_ORDER.get(table), tallies={"input": bronze})


def _silver_rows(lake: Lake, months: list[date]) -> dict[str, int]:
    """Rows of the given months by table, from the log."""
    wanted = (F.col("layer") == "silver") & of_months(months)
    sizes = lake.processed().where(wanted).groupBy("table_name").agg(F.sum("n_rows").alias("n"))
    return {row["table_name"]: row["n"] for row in sizes.collect()}


def _hot_keys(
    applications: DataFrame, customers: dict[str, DataFrame], policy: SkewPolicy, n: dict[str, int]
) -> dict[str, DataFrame]:
    """The hot keys of the join of features. A table with no more rows ``n`` than a hot key has isn't searched, and the
    others are searched at the same time."""
    tables = {"left": applications, **customers}
    large = [name for name in tables if n.get("loans" if name == "left" else name, 0) > policy.min_rows]
    found = together([lambda name=name: hot_keys({name: tables[name]}, s.CUSTOMER_MONTH, policy) for name in large])
    return {name: keys for of in found for name, keys in of.items()}


def stage_features(
    lake: Lake, months: list[date], policy: SkewPolicy = DEFAULT_POLICY, thin_from: int = THIN_FROM
) -> Staged:
    """The feature store of the given months, as groups. Customer tables of ``thin_from`` rows and more lose rows without
    an application before they are shuffled."""
    tables = {table: lake.read("silver", table, months) for table in ["loans", *CUSTOMER_TABLES]}
    applications, n = gold.loans_at_application(tables.pop("loans")), _silver_rows(lake, months)
    # Most customers take out no loan in most months: rows of others needn't be shuffled.
    large = {name: df for name, df in tables.items() if n.get(name, 0) >= thin_from}
    if large:
        tables |= matching_rows(large, applications, s.CUSTOMER_MONTH)
    most = replace(policy, min_rows=min(policy.min_rows, feature_groups.LIST_ROWS))
    hot = _hot_keys(applications, gold.customer_features(**tables), most, n)
    base, schema = Tally(), lake.schemas["gold"]["feature_store"]
    groups = feature_groups.feature_groups(base.watch(applications), **tables, schema=schema, hot=hot)
    return lake.stage(
        groups, "gold", "feature_store", months, rebalance=True, tallies={"at_application": base}, grouped=True
    )


def definition(dpd: int, mob: int) -> str:
    return f"{dpd}dpd_{mob}mob"


def stage_labels(lake: Lake, months: list[date], dpd: int = LABEL_DPD, mob: int = LABEL_MOB) -> Staged:
    """The label store of the given months; rows are counted by label."""
    rows = gold.label_store(lake.read("silver", "loans", months), dpd, mob)
    by_label = Tally(F.concat(F.lit("label="), F.coalesce(F.col("label").cast("string"), F.lit("null"))))
    return lake.stage(
        rows, "gold", "label_store", months, rebalance=True, tags=by_label, definition=definition(dpd, mob)
    )


def load_bronze(
    lake: Lake,
    sources: dict[str, DataFrame],
    months: list[date],
    in_month_order: bool = False,
    loaded: Callable[[str], None] | None = None,
) -> None:
    """Source rows as received, by month. Rows of other dates are left out.

    Sources whose files are ``in_month_order`` need no shuffle: each task reads few months. Tables are loaded one after
    the other, so that shuffle files of one at a time take up room. ``loaded`` is called with the name of each table
    whose source is read for the last time.
    """
    staged = []
    for table, rows in sources.items() if months else ():
        staged.append(stage_bronze(lake, table, rows, months, in_month_order))
        if loaded:
            loaded(table)
    lake.publish(*staged)


def build_silver(lake: Lake, months: list[date]) -> None:
    """Clean rows of the months whose bronze rows were loaded."""
    ready = lake.processed_months("bronze", list(CLEANERS), months)
    tables = [table for table in CLEANERS if ready[table]]
    lake.publish(*together([lambda t=t: stage_silver(lake, t, ready[t]) for t in tables]))


def feature_months(lake: Lake, months: list[date]) -> list[date]:
    """Those of the given months for which all customer tables were processed."""
    done = lake.processed_months("silver", CUSTOMER_TABLES, months)
    return sorted(set.intersection(*[set(given) for given in done.values()]))


def build_features(lake: Lake, months: list[date], policy: SkewPolicy = DEFAULT_POLICY) -> list[date]:
    """Feature store of the months for which all customer tables were processed; returns those months."""
    ready = feature_months(lake, months)
    if ready:
        lake.publish(stage_features(lake, ready, policy))
    return ready


def build_labels(lake: Lake, months: list[date], dpd: int = LABEL_DPD, mob: int = LABEL_MOB) -> list[date]:
    """Label store of the months whose loans were processed; returns those months."""
    ready = lake.processed_months("silver", ["loans"], months)["loans"]
    if ready:
        lake.publish(stage_labels(lake, ready, dpd, mob))
    return ready


def run_backfill(
    lake: Lake,
    sources: dict[str, DataFrame],
    start: str | date = FIRST_MONTH,
    end: str | date = LAST_MONTH,
    dpd: int = LABEL_DPD,
    mob: int = LABEL_MOB,
    policy: SkewPolicy = DEFAULT_POLICY,
    in_month_order: bool = False,
    loaded: Callable[[str], None] | None = None,
) -> DataFrame:
    """All layers for the months from ``start`` to ``end``; returns what was left out, see :func:`left_out`.

    For ``loaded`` see :func:`load_bronze`.
    """
    months = month_starts(start, end)
    load_bronze(lake, sources, months, in_month_order, loaded)
    build_silver(lake, months)
    build_features(lake, months, policy)
    build_labels(lake, months, dpd, mob)
    return left_out(lake, months)


LEFT_OUT = "layer string, table_name string, snapshot_date date, missing string"


def left_out(lake: Lake, months: list[date]) -> DataFrame:
    """Months that a silver or gold table was not built for, and which of its inputs was never processed.

    A month that was processed and has no rows is not left out. Loans that were never processed leave no labels, but
    features: a feature store needs its customer tables only.
    """
    needs = {("silver", table): [("bronze", table)] for table in CLEANERS}
    needs["gold", "feature_store"] = [("silver", table) for table in CUSTOMER_TABLES]
    needs["gold", "label_store"] = [("silver", "loans")]
    done = {
        layer: lake.processed_months(layer, list(CLEANERS), months) for layer in ["bronze", "silver"]
    }
    rows = [
        (layer, table, month, f"{below}.{source}")
        for (layer, table), sources in needs.items()
        for below, source in sources
        for month in months
        if month not in done[below][source]
    ]
    return lake.spark.createDataFrame(rows, LEFT_OUT)


def report(lake: Lake) -> dict[str, DataFrame]:
    """Rows, columns and months of the gold tables, their schemas, the label distribution and the rows of every step.

    A lake that was never written to is an error.
    """
    if not lake.exists():
        raise ValueError(f"no lake at {lake.root}")
    stores = {name: lake.read("gold", name) for name in ["feature_store", "label_store"]}
    sizes = {name: lake.row_counts("gold", name) for name in stores}
    return {
        "profile": audit.dataset_profile(stores, sizes),
        "schema": audit.schema_report(stores, sizes),
        "labels": audit.label_distribution(stores["label_store"]),
        "months": lake.processed().where("layer = 'gold'").groupBy("table_name").agg(F.count("*").alias("n_months")),
        "processed": lake.processed(),
    }


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="loanlake", description="Build the loan feature and label store.")
    parser.add_argument("--source", required=True, help="folder of the four CSV sources")
    parser.add_argument("--lake", required=True, help="folder of the tables to build")
    parser.add_argument("--start", default=FIRST_MONTH)
    parser.add_argument("--end", default=LAST_MONTH)
    parser.add_argument("--dpd", type=int, default=LABEL_DPD)
    parser.add_argument("--mob", type=int, default=LABEL_MOB)
    parser.add_argument("--in-month-order", action="store_true", help="source files are sorted by month")
    options = parser.parse_args(args)

    spark = SparkSession.builder.appName("loanlake").getOrCreate()
    lake = Lake(spark, options.lake)
    missing = run_backfill(
        lake,
        read_sources(spark, options.source),
        options.start,
        options.end,
        options.dpd,
        options.mob,
        in_month_order=options.in_month_order,
    )
    for name, df in {**report(lake), "left out": missing}.items():
        print(name)
        df.show(df.count(), truncate=False)  # columns, months and tables: bounded by the calendar
