"""Shapes of the physical plans on written tables."""

import io
import re
from contextlib import redirect_stdout
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from loanlake import schemas as s
from loanlake.operators import gold
from loanlake.operators.silver import CLEANERS
from loanlake.sources import orders_feed
from loanlake.sources.lake import Lake, newest_files, write_partitioned


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("plans")))
    for table, df in orders_feed.source_tables(spark, sf_dir).items():
        few = df.where(F.col(s.SNAPSHOT).between("1996-01-01", "1996-02-01"))
        write_partitioned(few, lake.path("bronze", table))
        write_partitioned(CLEANERS[table](few), lake.path("silver", table))
    return lake


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def operators(df, name):
    tree = plan(df).split("\n\n")[0]
    return len(re.findall(rf"\b{name}\b", tree))


def test_feature_store_shuffles_each_table_once(lake, no_broadcast):
    df = gold.feature_store(**{table: lake.read("silver", table) for table in s.SILVER})
    assert operators(df, "SortMergeJoin") == 3
    assert operators(df, "Exchange") == 4


def test_filters_and_columns_reach_the_scan(lake):
    features = plan(gold.loans_at_application(lake.read("silver", "loans")))
    assert "EqualTo(installment_num,0)" in features and "overdue_amt" not in features
    labels = plan(gold.label_store(lake.read("silver", "loans")))
    assert "EqualTo(mob,6)" in labels
    assert re.search(r"ReadSchema: struct<loan_id:string,Customer_ID:string,mob:int,dpd:int>", labels)


def test_months_are_partition_filters(lake):
    one = plan(lake.read("silver", "loans", [date(1996, 1, 1)]))
    assert re.search(r"PartitionFilters: \[.*snapshot_date", one)


@pytest.mark.parametrize("table", s.SILVER)
def test_cleaning_is_one_pass_in_the_engine(lake, table):
    text = plan(CLEANERS[table](lake.read("bronze", table)))
    for unwanted in ["Exchange", "Python", "Pandas", "Arrow", "Join"]:
        assert unwanted not in text


LARGEST_COMPILED_METHOD = 8000


@pytest.mark.parametrize("table", s.SILVER)
def test_generated_code_is_compiled(spark, lake, table):
    """The JVM interprets larger methods, at several times the cost per row."""
    CLEANERS[table](lake.read("bronze", table)).createOrReplaceTempView("cleaned")
    text = spark.sql("EXPLAIN CODEGEN SELECT * FROM cleaned").first()[0]
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < LARGEST_COMPILED_METHOD - 400


@pytest.mark.parametrize("name", ["gold_feature_store", "layer_row_audit", "required_months", "gold_label_store"])
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    text = plan(registered.queries()[name](spark, sf_dir))
    for unwanted in ["CartesianProduct", "NestedLoopJoin", "PythonUDF", "MapInPandas", "FlatMapGroups"]:
        assert unwanted not in text


def test_month_replacement_sorts_nothing(lake):
    """Neither reads a column nor sorts rows to learn which months were written."""
    text = plan(newest_files(lake.read("silver", "loans")))
    assert "HashAggregate" in text and "Sort" not in text.replace("SortOrder", "")
    assert re.search(r"ReadSchema: struct<>", text)


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy"))


def test_building_the_feature_store_runs_no_job(spark, sf_dir, lake):
    tables = {table: lake.read("silver", table) for table in s.SILVER}
    spark.sparkContext.setJobGroup("lazy", "lazy")
    gold.feature_store(**tables).explain()
    gold.training_set(lake.read("silver", "loans"), lake.read("silver", "loans").selectExpr("loan_id", "1 label", "1 label_def"))
    found = jobs(spark)
    spark.sparkContext.setJobGroup("others", "others")
    assert found == 0
