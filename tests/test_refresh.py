"""Counts taken by writes, atomic publication, and rebuilding only what has changed."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from frames import rows
from loanlake import schemas as s
from loanlake.functions.calendar import month_starts
from loanlake.operators import audit
from loanlake.plans import backfill, refresh
from loanlake.sources import orders_feed
from loanlake.sources.lake import PROCESSED, Lake, fingerprints, month_fingerprints
from loanlake.sources.tally import Tally

MONTHS = month_starts("1996-01-01", "1996-02-01")


@pytest.fixture(scope="module")
def sources(spark, sf_dir, tmp_path_factory):
    """Source tables of a few months, one more than is processed, and rows without a date."""
    folder, out = str(tmp_path_factory.mktemp("source")), {}
    for table, df in orders_feed.source_tables(spark, sf_dir).items():
        few = df.where(F.col(s.SNAPSHOT).between("1996-01-01", "1996-03-01"))
        none = few.limit(3).withColumn(s.SNAPSHOT, F.lit(None).cast("date"))
        few.unionByName(none).coalesce(2).write.parquet(f"{folder}/{table}")
        out[table] = spark.read.parquet(f"{folder}/{table}")
    return out


@pytest.fixture(scope="module")
def built(spark, sources, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("built")))
    backfill.run_backfill(lake, sources, MONTHS[0], MONTHS[-1])
    return lake


def contents(lake):
    return {(layer, table): rows(lake.read(layer, table)) for layer in s.TABLES for table in s.TABLES[layer]}


def versions(lake):
    log = lake.latest().where(F.col(s.SNAPSHOT).isNotNull()).collect()
    return {(r["layer"], r["table_name"], r[s.SNAPSHOT]): r["version"] for r in log}


def actions(df):
    return {(r["layer"], r["table_name"], r[s.SNAPSHOT]) for r in df.collect() if r["action"] == "rebuilt"}


def test_tally(spark):
    def months(*given):
        return spark.createDataFrame([(m, i % 2) for i, m in enumerate(given)], "snapshot_date date, n int")

    tally = Tally(F.col("n"))
    assert tally.watch(months(MONTHS[0], MONTHS[0], None, MONTHS[1])).repartition(3).count() == 4
    assert tally.counts() == {(MONTHS[0], "0"): 1, (MONTHS[0], "1"): 1, (None, "0"): 1, (MONTHS[1], "1"): 1}
    none = Tally()
    none.watch(months(MONTHS[0]).where("n > 5")).count()
    assert none.counts() == {}


def test_months_are_counted_as_dates(spark):
    late, schema = datetime(9999, 12, 31).date(), "snapshot_date date, x int"
    for given, found in [
        ([MONTHS[0], MONTHS[0], MONTHS[1], None, late], {MONTHS[0]: 2, MONTHS[1]: 1, None: 1, late: 1}),
        ([None, None], {None: 2}),
    ]:
        tally = Tally()
        watched = tally.watch(spark.createDataFrame([(month, n) for n, month in enumerate(given)], schema).repartition(3))
        assert "concat_ws" not in watched._jdf.queryExecution().analyzed().toString()
        assert watched.columns == [s.SNAPSHOT, "x"] and len(watched.collect()) == len(given)
        assert tally.counts() == {(month, ""): n for month, n in found.items()}


def test_counts_of_writes_equal_predicted_and_counted_ones(built, sources, spark):
    noted = audit.stage_counts(built.latest())
    of_months = {name: df.where(F.col(s.SNAPSHOT).isin(MONTHS)) for name, df in sources.items()}
    columns = [s.SNAPSHOT, "layer", "table_name", "stage", "n"]
    assert rows(noted.where("layer <> 'rejected'"), *columns) == rows(audit.layer_row_audit(of_months), *columns)
    rejected = {r["table_name"]: r["n"] for r in noted.where("layer = 'rejected'").collect()}
    assert rejected == {
        name: df.where(~F.coalesce(F.col(s.SNAPSHOT).isin(MONTHS), F.lit(False))).count() for name, df in sources.items()
    }
    labels = built.read("gold", "label_store")
    assert rows(audit.logged_label_distribution(built.latest())) == rows(audit.label_distribution(labels))
    stores = {name: built.read("gold", name) for name in s.GOLD}
    sizes = {name: len(df.columns) for name, df in stores.items()}
    assert rows(audit.logged_profile(built.latest(), sizes)) == rows(audit.dataset_profile(stores))


def test_counts_of_repeated_tasks_are_not_trusted(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    label = spark.createDataFrame([("L", "C", 1, "x", m) for m in MONTHS], s.GOLD["label_store"])
    source = Tally()
    staged = lake.stage(source.watch(label), "gold", "label_store", MONTHS, tallies={"source": source})
    staged.counts["output"][MONTHS[0]] += 1
    lake.publish(staged)
    assert {r["n_rows"] for r in lake.processed().collect()} == {1}
    assert all(r["counts"] == {"output": 1} for r in lake.latest().collect())


def test_nothing_is_seen_before_it_is_published(spark, sources, tmp_path):
    """A run killed between two writes, or before it publishes, leaves all months readable as they were."""
    lake = Lake(spark, str(tmp_path))
    backfill.run_backfill(lake, sources, MONTHS[0], MONTHS[-1])
    before = contents(lake)
    changed = sources["attributes"].withColumn("Name", F.lit("new"))
    staged = backfill.stage_bronze(lake, "attributes", changed, MONTHS)
    other = backfill.stage_silver(lake, "clickstream", MONTHS)
    assert contents(lake) == before
    os.makedirs(f"{lake.root}/processed/_temporary/0")  # what a killed write of the log leaves
    assert contents(lake) == before
    lake.publish(staged, other)
    assert {r[0] for r in lake.read("bronze", "attributes").select("Name").collect()} == {"new"}
    after = contents(lake)
    assert {k for k in after if after[k] != before[k]} == {("bronze", "attributes")}


def test_vacuum_deletes_what_is_not_used(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    label = spark.createDataFrame([("L", "C", n, "x", m) for m in MONTHS for n in (0, 1)], s.GOLD["label_store"])
    lake.write(label, "gold", "label_store", MONTHS)
    lake.write(label.where("label = 0"), "gold", "label_store", [MONTHS[0]])
    lake.stage(label, "gold", "label_store", MONTHS)
    before = rows(lake.read("gold", "label_store"))
    assert lake.vacuum(1.0) == []
    assert len(lake.vacuum(-1.0)) == 2 and rows(lake.read("gold", "label_store")) == before
    assert lake.vacuum(-1.0) == []


def test_a_lake_without_versions_is_read_and_replaced(spark, tmp_path):
    from loanlake.sources.lake import write_partitioned

    lake = Lake(spark, str(tmp_path))
    label = spark.createDataFrame([("L", "C", 1, "old", m) for m in MONTHS], s.GOLD["label_store"])
    write_partitioned(label, lake.path("gold", "label_store"))
    assert rows(lake.read("gold", "label_store")) == rows(label)
    log = [("gold", "label_store", m, 1, datetime(2020, 1, 1), None, None, None, None, None) for m in MONTHS]
    spark.createDataFrame(log, PROCESSED).write.parquet(f"{lake.root}/processed")
    lake.write(label.withColumn("label_def", F.lit("new")), "gold", "label_store", [MONTHS[1]])
    assert rows(lake.read("gold", "label_store").select("label_def", s.SNAPSHOT)) == [("new", MONTHS[1]), ("old", MONTHS[0])]


def test_fingerprints(spark):
    def of(*given):
        df = spark.createDataFrame([(MONTHS[0], a, b) for a, b in given], "snapshot_date date, a string, b string")
        return fingerprints(df.repartition(3)).first()["fingerprint"]

    assert of(("x", "y"), ("z", None)) == of(("z", None), ("x", "y"))
    different = [of(("x", None)), of((None, "x")), of(("x", "x")), of(("x", None), ("x", None)), of(("", "x")), of(("xx", None))]
    assert len(set(different)) == len(different)
    empty = spark.createDataFrame([], "snapshot_date date, a string")
    assert month_fingerprints(empty, MONTHS) == dict.fromkeys(MONTHS, "0")


def test_refresh(spark, sources, built, tmp_path):
    lake = Lake(spark, str(tmp_path))
    first = refresh.refresh(lake, sources, MONTHS[0], MONTHS[-1])
    assert first.count() == 20 and len(actions(first)) == 20
    assert contents(lake) == contents(built)
    assert actions(refresh.refresh(lake, sources, MONTHS[0], MONTHS[-1])) == set()
    assert actions(refresh.refresh(built, sources, MONTHS[0], MONTHS[-1])) == set()  # built without fingerprints
    before = versions(lake)
    # One month of one source: a month of each table on the way is written, no other file is touched.
    other = F.when(F.col(s.SNAPSHOT) == MONTHS[1], F.lit("Retired")).otherwise(F.col("Occupation"))
    changed = {**sources, "attributes": sources["attributes"].withColumn("Occupation", other)}
    found = actions(refresh.refresh(lake, changed, MONTHS[0], MONTHS[-1]))
    assert found == {("bronze", "attributes", MONTHS[1]), ("silver", "attributes", MONTHS[1]), ("gold", "feature_store", MONTHS[1])}
    after = versions(lake)
    assert {k for k in after if after[k] != before[k]} == found
    # The lake is the same as one that is built anew.
    anew = Lake(spark, str(tmp_path / "anew"))
    backfill.run_backfill(anew, changed, MONTHS[0], MONTHS[-1])
    assert contents(lake) == contents(anew)
    # A change that silver drops ends there: rows without a customer, an SSN.
    masked = {**changed, "attributes": changed["attributes"].withColumn("SSN", F.lit("new"))}
    assert actions(refresh.refresh(lake, masked, MONTHS[0], MONTHS[0])) == {
        ("bronze", "attributes", MONTHS[0]), ("silver", "attributes", MONTHS[0])
    }
    # Another definition of the label concerns the label store only.
    assert actions(refresh.refresh(lake, masked, MONTHS[0], MONTHS[0], dpd=60)) == {("gold", "label_store", MONTHS[0])}
    assert {r[0] for r in lake.read("gold", "label_store", [MONTHS[0]]).select("label_def").distinct().collect()} == {"60dpd_6mob"}
    # A month that loses all its rows is emptied everywhere.
    gone = {n: df.where(F.col(s.SNAPSHOT) != date(1996, 2, 1)) for n, df in masked.items()}
    assert len(actions(refresh.refresh(lake, gone, MONTHS[0], MONTHS[1]))) == 10 + 1  # and the labels of the first, by their old definition
    assert all(lake.read(layer, t, [MONTHS[1]]).count() == 0 for layer in s.TABLES for t in s.TABLES[layer])
