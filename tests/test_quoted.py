"""Line breaks in quoted text, in files that many tasks read."""

import random

import pytest
from pyspark.sql import functions as F

from frames import rows
from loanlake import schemas as s
from loanlake.sources import csv
from loanlake.sources.quoted import quoted_records

NAMES = s.BRONZE["attributes"].names


def cell(rng):
    text = "".join(rng.choice(["a", "b ", ",", '"', '""', "\n", "\r\n", "é", "", "\n\n"]) for _ in range(rng.randrange(9)))
    if rng.random() < 0.02:
        text += "long line\n" * rng.randrange(400)
    return '"' + text.replace('"', '""') + '"' if rng.random() < 0.7 else text.translate({ord(c): None for c in '",\n\r'})


def write(path, rng, n, end="\n"):
    path.write_bytes((end.join([",".join(NAMES), *[",".join(f'"{i}"' if k == 0 else cell(rng) for k in range(len(NAMES))) for i in range(n)]])
                      + rng.choice(["", end, end + end])).encode())


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def whole(spark, path):
    """Read by one task per file."""
    options = {"header": True, "multiLine": True, "escape": '"'}
    return spark.read.schema(", ".join(f"`{n}` string" for n in NAMES)).options(**options).csv(path)


def test_files_of_many_ranges(spark, tmp_path, small_ranges):
    rng = random.Random(8)
    folder = tmp_path / "source"
    folder.mkdir()
    for i, n in enumerate([700, 300, 1, 0]):
        write(folder / f"{i}.csv", rng, n)
    schema = s.BRONZE["attributes"]
    found = csv.read_source(spark, str(folder), schema, multi_line=True)
    want = whole(spark, str(folder)).withColumn(s.SNAPSHOT, F.col(s.SNAPSHOT).try_cast("date"))
    assert rows(found) == rows(want.select(*schema.names)) and found.count() == 1001
    lines = spark.read.text(str(folder / "0.csv"))
    assert lines.rdd.getNumPartitions() > 20


def test_line_ends_of_two_characters(spark, tmp_path, small_ranges):
    path = tmp_path / "source.csv"
    write(path, random.Random(9), 400, "\r\n")
    found = csv.read_source(spark, str(path), s.BRONZE["attributes"], multi_line=True).drop(s.SNAPSHOT)
    assert rows(found) == rows(whole(spark, str(path)).drop(s.SNAPSHOT))


def test_what_is_written_is_read(spark, tmp_path, small_ranges):
    text = [("c", None, 'He said "x",\nthen\r\nleft\n', "1", "\n", '"'), ("d", None, "\ty", None, "a\n\nb", ",")]
    df = spark.createDataFrame(text * 200, s.BRONZE["attributes"])
    csv.write_csv(df, str(tmp_path / "out"), multi_line=True)
    assert rows(csv.read_source(spark, str(tmp_path / "out"), s.BRONZE["attributes"], multi_line=True)) == rows(df)


def test_errors_name_the_file(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text("a,b\n1,\"never closed\n" + "2,3\n" * 50)
    with pytest.raises(Exception, match="more than 20 lines in .*open.csv"):
        quoted_records(spark, str(path), 20).collect()
    folder = tmp_path / "two"
    folder.mkdir()
    for name, header in [("x", NAMES), ("y", NAMES[::-1])]:
        (folder / f"{name}.csv").write_text(",".join(header) + "\n" + ",".join("1" * len(NAMES)) + "\n")
    with pytest.raises(Exception, match="another header in"):
        csv.read_source(spark, str(folder), s.BRONZE["attributes"], multi_line=True).collect()
