"""CSV sources."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import rows
from loanlake import schemas as s
from loanlake.sources import csv, orders_feed
from loanlake.sources.scratch import scratch_root


def write(folder, text):
    path = os.path.join(folder, "source.csv")
    with open(path, "w") as file:
        file.write(text)
    return path


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path, 'Occupation,Age,extra,SSN,Name,snapshot_date,Customer_ID\n"A, b",24.0,x,,"",2023-01-01,c1\n')
    row = csv.read_source(spark, path, s.BRONZE["attributes"]).first()
    assert row.asDict() == {
        "Customer_ID": "c1", "snapshot_date": date(2023, 1, 1), "Name": None, "Age": "24.0",
        "SSN": None, "Occupation": "A, b",
    }


def test_missing_columns_are_named(spark, tmp_path):
    path = write(tmp_path, "Customer_ID,snapshot_date,Name\nc1,2023-01-01,x\n")
    with pytest.raises(ValueError, match="Age, SSN, Occupation"):
        csv.read_source(spark, path, s.BRONZE["attributes"])


def test_numbers_and_dates(spark, tmp_path, any_ansi):
    path = write(
        tmp_path,
        ",".join(s.BRONZE["loans"].names) + "\n"
        + "L1,c1,2023-01-01,2023-02-01,10,1.0,1000.5,x,,1e3,-5\n"
        + "L2,c2,bad,,1x,2,1,2,3,4,5\n",
    )
    found = [tuple(row)[2:] for row in csv.read_source(spark, path, s.BRONZE["loans"]).sort("loan_id").collect()]
    assert [str(v) for v in found[0]] == [
        "2023-01-01", "2023-02-01", "10", "1", "1000.5", "None", "None", "1000.0", "-5.0",
    ]
    assert found[1][:4] == (None, None, None, 2)


def clickstream_text(*rows):
    return ",".join(s.BRONZE["clickstream"].names) + "\n" + "".join(f"c,2023-01-01,{row}" + ",1" * 18 + "\n" for row in rows)


def test_features_are_never_cut(spark, tmp_path, any_ansi):
    path = write(tmp_path, clickstream_text("3.7,3000000000", "-2.9,x"))
    found = csv.read_source(spark, path, s.BRONZE["clickstream"]).sort("fe_1").collect()
    assert [(r["fe_1"], r["fe_2"]) for r in found] == [(-2.9, None), (3.7, 3e9)]


@pytest.mark.parametrize("value", ["3.7", "3000000000", "NaN"])
def test_number_that_is_not_whole_fails(spark, tmp_path, value, any_ansi):
    path = write(tmp_path, ",".join(s.BRONZE["loans"].names) + f"\nL1,c1,2023-01-01,2023-02-01,{value},1,1,1,1,1,1\n")
    with pytest.raises(Exception, match="no 32-bit whole number in tenure"):
        csv.read_source(spark, path, s.BRONZE["loans"]).collect()


def test_parts_in_another_column_order_fail(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "a.csv").write_text("Customer_ID,snapshot_date,Name,Age,SSN,Occupation\nc1,2023-01-01,Ann,40,111,Nurse\n")
    (folder / "b.csv").write_text("Customer_ID,snapshot_date,Age,Name,Occupation,SSN\nc2,2023-01-01,41,Bob,Doctor,222\n")
    source = csv.read_source(spark, str(folder), s.BRONZE["attributes"])
    with pytest.raises(Exception, match="CSV header does not conform"):
        source.collect()


def test_doubled_quotes_and_line_breaks(spark, tmp_path):
    text = 'Customer_ID,snapshot_date,Name,Age,SSN,Occupation\nc1,2023-01-01,"O""Neil,\n J",41,222,"a ""b"""\n'
    row = csv.read_source(spark, write(tmp_path, text), s.BRONZE["attributes"], multi_line=True).first()
    assert (row["Name"], row["Age"], row["SSN"], row["Occupation"]) == ('O"Neil,\n J', "41", "222", 'a "b"')


def test_line_breaks_are_not_written(spark, tmp_path):
    df = spark.createDataFrame([("a\nb",)], "Name string")
    with pytest.raises(Exception, match="line break in Name"):
        csv.write_csv(df, str(tmp_path / "out"))


def test_header_without_rows(spark, tmp_path):
    path = write(tmp_path, ",".join(s.BRONZE["clickstream"].names) + "\n")
    df = csv.read_source(spark, path, s.BRONZE["clickstream"])
    assert df.count() == 0 and df.schema["fe_3"].dataType == s.BRONZE["clickstream"]["fe_3"].dataType


def test_round_trip_keeps_blanks_quotes_and_commas(spark, tmp_path):
    values = [("c1", ' a "b", c '), ("c2", None), (" c3 ", "x\\y"), ("c4", "'")]
    schema = s.BRONZE["attributes"]
    df = spark.createDataFrame(values, "Customer_ID string, Name string").select(
        *[F.col(n) if n in ("Customer_ID", "Name") else F.lit(None).cast(schema[n].dataType).alias(n) for n in schema.names]
    )
    path = str(tmp_path / "out")
    csv.write_csv(df, path)
    assert rows(csv.read_source(spark, path, schema)) == rows(df)


def test_months_of_csv_are_replaced_alone(spark, tmp_path):
    schema = s.BRONZE["attributes"]
    path = str(tmp_path / "out")

    def months(name, *numbers):
        rows = [("c1", date(2023, n, 1), name, "30", None, None) for n in numbers]
        return spark.createDataFrame(rows, schema)

    csv.write_csv(months("a", 1, 2, 3), path, by_month=True)
    csv.write_csv(months("b", 2), path, by_month=True)
    found = csv.read_source(spark, path, schema).select(s.SNAPSHOT, "Name").collect()
    assert sorted((row[0].month, row[1]) for row in found) == [(1, "a"), (2, "b"), (3, "a")]


def test_feed_has_every_source(spark, sf_dir):
    tables = orders_feed.source_tables(spark, sf_dir)
    assert {name: df.columns for name, df in tables.items()} == {n: v.names for n, v in s.BRONZE.items()}


def test_scratch_folder_follows_the_session(spark):
    root = scratch_root(spark)
    assert root.startswith(spark.conf.get("spark.checkpoint.dir")) and root != scratch_root(spark)
