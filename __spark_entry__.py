"""Registered queries.

``queries()`` runs every operator: those of the loan pipeline on tables derived from the given ``orders`` table, those
for training data on the given tables. ``oracle_sql()`` holds the same question as SQL for another engine.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loanlake import schemas as s
from loanlake.functions.calendar import month_starts, snapshot_calendar
from loanlake.operators import audit, feature_groups, gold, schema_check, silver
from loanlake.operators.joins import SkewPolicy
from loanlake.plans import backfill, refresh
from loanlake.sources import csv, orders_feed
from loanlake.sources.lake import Lake, read_table, write_partitioned
from loanlake.sources.scratch import delete_folder, release_shuffles, scratch_root
from oracle_queries import ORACLE_SQL

try:
    import corpus_pipeline
    from loanlake.llm import queries as llm_queries
except ImportError as missing:
    # The subpackage may be absent, and so may the tokenizers' files that only it needs.
    if missing.name not in ("corpus_pipeline", "loanlake.llm", "public_tokenizers"):
        raise
    llm_queries = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

ONE_MONTH = date(1996, 3, 1)
# Rows of a compressed source file: at most some 80 MB of text, which one task reads.
_ROWS_A_FILE = 1_000_000


def _bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return orders_feed.source_table(spark, sf_dir, table)


def _silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver.CLEANERS[table](_bronze(spark, sf_dir, table))


def _applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.loans_at_application(_silver(spark, sf_dir, "loans"))


def _customers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return gold.customer_features(*[_silver(spark, sf_dir, table) for table in backfill.CUSTOMER_TABLES])


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.feature_store(**{table: _silver(spark, sf_dir, table) for table in s.SILVER})


def _labels(spark: SparkSession, sf_dir: str, **definition: int) -> DataFrame:
    return gold.label_store(_silver(spark, sf_dir, "loans"), **definition)


def _stores(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"feature_store": _features(spark, sf_dir), "label_store": _labels(spark, sf_dir)}


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = {"feature_store": gold.feature_counts(**{table: _silver(spark, sf_dir, table) for table in s.SILVER})}
    return audit.dataset_profile(_stores(spark, sf_dir), sizes)


def _bronze_written(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The table written by month and read back."""
        path = f"{scratch_root(spark)}/{table}"
        write_partitioned(_bronze(spark, sf_dir, table), path, rebalance=True)
        return read_table(spark, path, s.BRONZE[table])

    return run


def _csv_scan(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The table written as CSV and read as a source."""
        path = f"{scratch_root(spark)}/{csv.SOURCE_FILES[table]}"
        csv.write_csv(_bronze(spark, sf_dir, table), path)
        return csv.read_source(spark, path, s.BRONZE[table])

    return run


def _csv_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream written as one CSV folder per month and read again, all months together."""
    path = f"{scratch_root(spark)}/clickstream"
    csv.write_csv(_bronze(spark, sf_dir, "clickstream"), path, by_month=True)
    return csv.read_source(spark, path, s.BRONZE["clickstream"])


def _csv_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes with line breaks, quotes and commas in their names, written as CSV and read by many tasks a file."""
    path = f"{scratch_root(spark)}/attributes"
    rows = _bronze(spark, sf_dir, "attributes").withColumn("Name", F.concat("Name", F.lit('\n"x", y')))
    csv.write_csv(rows, path, multi_line=True)
    return csv.read_source(spark, path, s.BRONZE["attributes"], multi_line=True)


def _schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The financial source as CSV text, held against the types of its clean values."""
    path = f"{scratch_root(spark)}/financials"
    csv.write_csv(_bronze(spark, sf_dir, "financials"), path)
    clean = [field for field in s.SILVER["financials"] if field.name in s.BRONZE["financials"].names]
    return schema_check.schema_drift(csv.read_text(spark, path), StructType(clean))


def _silver_table(table: str) -> Query:
    return lambda spark, sf_dir: _silver(spark, sf_dir, table)


def _one_join(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        columns = {"attributes": s.ATTRIBUTE_FEATURES, "financials": s.FINANCIAL_FEATURES}
        rows = _silver(spark, sf_dir, table)
        wanted = rows.select(*s.CUSTOMER_MONTH, *columns[table]) if table in columns else rows
        return gold.join_customer_features(_applications(spark, sf_dir), {table: wanted})

    return run


def _bronze_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir, "loans").where(F.col(s.SNAPSHOT) == F.lit(ONE_MONTH))


def _bounds(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """The first and the last month of the loans."""
    return _bronze(spark, sf_dir, "loans").agg(F.min(s.SNAPSHOT), F.max(s.SNAPSHOT)).first()


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_calendar(spark, *_bounds(spark, sf_dir))


def _credit_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "financials").select(
        *s.CUSTOMER_MONTH, "Credit_History_Age", "Credit_History_Age_Years"
    )


def _mob(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = silver.add_months_on_book(silver.clean_loan_rows(_bronze(spark, sf_dir, "loans")))
    return loans.select(s.LOAN, s.SNAPSHOT, "loan_start_date", "mob")


def _dpd(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = silver.add_days_past_due(silver.clean_loan_rows(_bronze(spark, sf_dir, "loans")))
    return loans.select(
        s.LOAN, s.SNAPSHOT, "overdue_amt", "due_amt", "installments_missed", "first_missed_date", "dpd"
    )


def _null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = gold.join_customer_features(_applications(spark, sf_dir), _customers(spark, sf_dir))
    return gold.fill_features(joined)


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*s.CUSTOMER_MONTH, "Annual_Income", "Total_EMI_per_month", "Outstanding_Debt"]
    return gold.add_ratios(_silver(spark, sf_dir, "financials").select(*columns))


def _risk_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [*s.CUSTOMER_MONTH, "Credit_Utilization_Ratio"]
    return gold.add_risk_band(_silver(spark, sf_dir, "financials").select(*columns))


def _written(spark: SparkSession, df: DataFrame, schema) -> DataFrame:
    path = f"{scratch_root(spark)}/table"
    write_partitioned(df, path)
    return read_table(spark, path, schema)


def _pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = _written(spark, _silver(spark, sf_dir, "loans"), s.SILVER["loans"])
    return loans.where(F.col(s.SNAPSHOT) == F.lit(ONE_MONTH))


def _multi_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, _labels(spark, sf_dir), s.GOLD["label_store"])


def _overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months written, then one month written again with other values."""
    path = f"{scratch_root(spark)}/attributes"
    rows = _bronze(spark, sf_dir, "attributes")
    write_partitioned(rows, path, rebalance=True)
    again = rows.where(F.col(s.SNAPSHOT) == F.lit(ONE_MONTH)).withColumn("Name", F.upper("Name"))
    write_partitioned(again, path)
    return read_table(spark, path, s.BRONZE["attributes"])


def _required_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans, *others = [_silver(spark, sf_dir, table) for table in ["loans", *backfill.CUSTOMER_TABLES]]
    return gold.required_months(gold.present_months(loans), *others)


@lru_cache(maxsize=4)
def _lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake built from CSV sources over all months of the data."""
    root = scratch_root(spark)
    for table, rows in orders_feed.source_tables(spark, sf_dir).items():
        csv.write_csv(rows, f"{root}/source/{csv.SOURCE_FILES[table]}", packed=_ROWS_A_FILE)
        release_shuffles(spark)
    lake = Lake(spark, f"{root}/lake")
    sources = csv.read_sources(spark, f"{root}/source")
    backfill.run_backfill(
        lake, sources, *_bounds(spark, sf_dir),
        loaded=lambda table: delete_folder(spark, f"{root}/source/{csv.SOURCE_FILES[table]}"),
    )
    return lake


def _lake_table(table: str) -> Query:
    return lambda spark, sf_dir: _lake(spark, sf_dir).read("gold", table)


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {table: _silver(spark, sf_dir, table) for table in s.SILVER}
    return gold.training_features(**tables, labels=_labels(spark, sf_dir))


def _lake_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    labels, schema = lake.read("gold", "label_store"), s.GOLD["feature_store"]
    return feature_groups.training_set(lake.read_groups(), labels, schema)


# With so low a threshold, customers with a few loans in a month and loans with a few rows count as hot.
_EAGER = SkewPolicy(max_keys=10_000, min_rows=1)


def _salted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans and clickstream joined with the rows of hot keys spread, on either side."""
    wanted = {"clickstream": _silver(spark, sf_dir, "clickstream")}
    return gold.join_customer_features(_applications(spark, sf_dir), wanted, _EAGER)


def _salted_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {table: _silver(spark, sf_dir, table) for table in s.SILVER}
    return gold.training_features(**tables, labels=_labels(spark, sf_dir), policy=_EAGER)


def _month_without_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months written, then written again from sources that have lost one month."""
    lake = Lake(spark, f"{scratch_root(spark)}/lake")
    months = month_starts(*_bounds(spark, sf_dir))
    rows = _bronze(spark, sf_dir, "attributes")
    lake.write(rows, "bronze", "attributes", months, rebalance=True)
    lake.write(rows.where(F.col(s.SNAPSHOT) != F.lit(ONE_MONTH)), "bronze", "attributes", months, rebalance=True)
    return lake.read("bronze", "attributes")


def _row_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    written = {layer: {table: lake.read(layer, table) for table in s.TABLES[layer]} for layer in s.TABLES}
    sources = orders_feed.source_tables(spark, sf_dir)
    return audit.written_row_audit(sources, written, _calendar(spark, sf_dir), sizes=_lake_sizes(spark, sf_dir))


def _left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left out where financials miss a month, loans another, and a third has no attributes but is processed."""
    lake = Lake(spark, f"{scratch_root(spark)}/lake")
    months = month_starts(*_bounds(spark, sf_dir))
    sources = orders_feed.source_tables(spark, sf_dir)
    sources["attributes"] = sources["attributes"].where(F.col(s.SNAPSHOT) != F.lit(months[3]))
    without = {"financials": months[1], "loans": months[2]}
    for table, rows in sources.items():
        backfill.load_bronze(lake, {table: rows}, [month for month in months if month != without.get(table)])
    backfill.build_silver(lake, months)
    backfill.build_features(lake, months)
    backfill.build_labels(lake, months)
    return backfill.left_out(lake, months)


def _refresh_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second run rebuilds if the financials of one month have changed."""
    lake = Lake(spark, f"{scratch_root(spark)}/lake")
    sources, bounds = orders_feed.source_tables(spark, sf_dir), _bounds(spark, sf_dir)
    backfill.run_backfill(lake, sources, *bounds)
    changed = F.when(F.col(s.SNAPSHOT) == F.lit(ONE_MONTH), F.lit("Good")).otherwise(F.col("Credit_Mix"))
    sources["financials"] = sources["financials"].withColumn("Credit_Mix", changed)
    return refresh.refresh(lake, sources, *bounds)


def _logged_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {name: len(df.columns) for name, df in _lake_stores(spark, sf_dir).items()}
    return audit.logged_profile(_lake(spark, sf_dir).latest(), columns)


def _lake_stores(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {table: _lake(spark, sf_dir).read("gold", table) for table in s.GOLD}


def _lake_sizes(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {table: _lake(spark, sf_dir).row_counts("gold", table) for table in s.GOLD}


def entry(spark: SparkSession) -> DataFrame:
    """The feature store of all months."""
    return _features(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return pipeline_queries() | prepared_queries()


def oracle_sql() -> dict[str, str]:
    known = dict(ORACLE_SQL)
    if llm_queries:
        known |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            known["pipeline"] = corpus_pipeline.ORACLE_SQL
    return known


def prepared_queries() -> dict[str, Query]:
    """Operators for training data and the pipeline of them, if that subpackage is there."""
    return llm_queries.queries() | {"pipeline": corpus_pipeline.run} if llm_queries else {}


def pipeline_queries() -> dict[str, Query]:
    return {
        "snapshot_calendar": _calendar,
        "bronze_snapshot_slice": _bronze_slice,
        **{f"bronze_{table}": _bronze_written(table) for table in s.BRONZE},
        **{f"silver_{table}": _silver_table(table) for table in s.SILVER},
        "credit_age_years": _credit_age,
        "loan_mob": _mob,
        "loan_dpd": _dpd,
        "loans_at_application": _applications,
        **{f"join_loans_{table}": _one_join(table) for table in backfill.CUSTOMER_TABLES},
        "feature_null_fill": _null_fill,
        "ratio_features": _ratios,
        "risk_band": _risk_band,
        "gold_feature_store": _features,
        "gold_label_store": _labels,
        "gold_label_store_60dpd_9mob": lambda spark, sf_dir: _labels(spark, sf_dir, dpd=60, mob=9),
        "label_distribution": lambda spark, sf_dir: audit.label_distribution(_labels(spark, sf_dir)),
        "dataset_profile": _profile,
        "layer_row_audit": lambda spark, sf_dir: audit.layer_row_audit(orders_feed.source_tables(spark, sf_dir)),
        "schema_report": lambda spark, sf_dir: audit.schema_report(
            _lake_stores(spark, sf_dir), _lake_sizes(spark, sf_dir)
        ),
        "csv_scan_clickstream": _csv_scan("clickstream"),
        "csv_scan_attributes": _csv_scan("attributes"),
        "csv_scan_loans": _csv_scan("loans"),
        "csv_by_month": _csv_by_month,
        "csv_schema_drift": _schema_drift,
        "csv_multi_line_scan": _csv_multi_line,
        "csv_roundtrip_scan": _csv_scan("financials"),
        "partition_pruned_scan": _pruned_scan,
        "multi_partition_scan": _multi_scan,
        "partition_overwrite_roundtrip": _overwrite,
        "required_months": _required_months,
        "join_loans_clickstream_salted": _salted_join,
        "training_set": _training,
        "training_set_salted": _salted_training,
        "month_rerun_without_rows": _month_without_rows,
        "lake_training_set": _lake_training,
        "lake_row_audit": _row_audit,
        "lake_stage_counts": lambda spark, sf_dir: audit.stage_counts(_lake(spark, sf_dir).latest()),
        "lake_logged_label_distribution": lambda spark, sf_dir: audit.logged_label_distribution(
            _lake(spark, sf_dir).latest()
        ),
        "lake_logged_profile": _logged_profile,
        "lake_refresh_actions": _refresh_actions,
        "lake_left_out_months": _left_out,
        "lake_feature_store": _lake_table("feature_store"),
        "lake_label_store": _lake_table("label_store"),
        "lake_processed_rows": lambda spark, sf_dir: _lake(spark, sf_dir).processed(),
        "lake_label_distribution": lambda spark, sf_dir: audit.label_distribution(
            _lake(spark, sf_dir).read("gold", "label_store")
        ),
    }
