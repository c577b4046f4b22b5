"""Every registered query against its SQL on the given tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as registered
from frames import rows

QUERIES = registered.pipeline_queries()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_each_query_has_sql():
    assert set(QUERIES) == set(registered.ORACLE_SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf_dir, database, name):
    found = QUERIES[name](spark, sf_dir)
    answer = database.execute(registered.oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(found.columns) == sorted(names)
    order = sorted(range(len(names)), key=lambda i: names[i])
    expected = [tuple(row[i] for i in order) for row in answer.fetchall()]
    expected.sort(key=lambda row: tuple((v is None, str(v)) for v in row))
    got = rows(found)
    assert got and got == expected


def test_same_features_without_ansi(spark, sf_dir):
    before = spark.conf.get("spark.sql.ansi.enabled")
    found = {}
    for mode in ["true", "false"]:
        spark.conf.set("spark.sql.ansi.enabled", mode)
        found[mode] = rows(QUERIES["gold_feature_store"](spark, sf_dir))
    spark.conf.set("spark.sql.ansi.enabled", before)
    assert found["true"] == found["false"]


def test_entry(spark):
    df = registered.entry(spark)
    assert len(df.columns) == 50 and df.count() > 0
