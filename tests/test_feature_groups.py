"""Features kept as groups: the same rows as the join, stored and counted without multiplying them."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import rows
from loanlake import schemas as s
from loanlake.operators import audit, feature_groups, gold
from loanlake.operators.joins import SkewPolicy, hot_keys
from loanlake.operators.silver import CLEANERS
from loanlake.plans import backfill, refresh
from loanlake.sources import csv
from loanlake.sources.lake import Lake

MONTHS = [date(2023, 5, 1), date(2023, 6, 1)]


def bronze(spark, blank, month=MONTHS[0]):
    """``blank`` rows of blank ids in every table, a customer with rows everywhere and one with a loan only."""
    ids = ["  "] * blank + ["c1"]
    given = {
        "clickstream": [{"fe_1": float(n)} for n in range(blank + 1)],
        "attributes": [{"Age": str(20 + n % 50)} for n in range(blank + 1)],
        "financials": [{"Annual_Income": "10", "Outstanding_Debt": str(n)} for n in range(blank + 1)],
        "loans": [{"loan_id": f"L{n}", "loan_start_date": month, "installment_num": 0} for n in range(blank + 1)],
    }
    tables = {}
    for name, table in given.items():
        table = [{s.CUSTOMER: key, s.SNAPSHOT: month, **row} for key, row in zip(ids, table, strict=True)]
        if name == "loans":
            table.append({**table[-1], s.CUSTOMER: "c2", "loan_id": "alone"})
        schema = s.BRONZE[name]
        tables[name] = spark.createDataFrame([tuple(row.get(c) for c in schema.names) for row in table], schema)
    return tables


def silver(tables):
    return {name: clean(tables[name]) for name, clean in CLEANERS.items()}


def groups_of(tables, policy=None):
    customers = {name: tables[name] for name in backfill.CUSTOMER_TABLES}
    applications = gold.loans_at_application(tables["loans"])
    hot = hot_keys({"left": applications, **customers}, s.CUSTOMER_MONTH, policy) if policy else None
    return feature_groups.feature_groups(applications, **customers, hot=hot)


def prints(groups):
    return [row["fingerprint"] for row in feature_groups.fingerprints(groups).collect()]


@pytest.mark.parametrize("policy", [None, SkewPolicy(min_rows=2), SkewPolicy(min_rows=1)], ids=["plain", "two", "one"])
def test_groups_stand_for_the_features(spark, any_ansi, policy):
    tables = silver(bronze(spark, 5))
    groups, features = groups_of(tables, policy), gold.feature_store(**tables)
    assert rows(feature_groups.expand(groups, s.GOLD["feature_store"])) == rows(features)
    assert feature_groups.row_counts(groups).first()["n"] == 5**4 + 2
    assert groups.count() == 3 if policy is None else groups.count() > 3
    assert prints(groups) == prints(feature_groups.of_rows(features))


def test_fingerprints_see_values_nulls_and_copies(spark):
    tables = silver(bronze(spark, 3))
    before = prints(groups_of(tables))

    def of(name, change):
        return prints(groups_of({**tables, name: change(tables[name])}))

    different = [
        before,
        of("attributes", lambda df: df.withColumn("Age", F.col("Age") + 1)),
        of("clickstream", lambda df: df.withColumn("fe_2", F.col("fe_1"))),
        of("clickstream", lambda df: df.withColumn("fe_1", F.lit(None).cast("double"))),
        of("loans", lambda df: df.withColumn("loan_id", F.upper(F.concat("loan_id", F.lit("x"))))),
        of("financials", lambda df: df.unionAll(df)),
    ]
    assert len({tuple(found) for found in different}) == len(different)


def test_a_lake_stores_and_counts_groups(spark, tmp_path):
    """A hundred blank ids give a hundred million features of a month, which nobody has to make."""
    lake, many = Lake(spark, str(tmp_path)), 100
    sources = bronze(spark, many)
    backfill.run_backfill(lake, sources, MONTHS[0], MONTHS[-1])
    n = many**4 + 2
    assert {r["n_rows"] for r in lake.processed().where("table_name = 'feature_store'").collect()} == {n, 0}
    assert [r["n"] for r in lake.row_counts("gold", "feature_store").collect()] == [n]
    noted = audit.stage_counts(lake.latest()).where("table_name = 'feature_store' AND stage = 'output' AND n > 0")
    assert [r["n"] for r in noted.collect()] == [n]
    sizes = {name: lake.row_counts("gold", name) for name in s.GOLD}
    written = {layer: {table: lake.read(layer, table) for table in s.TABLES[layer]} for layer in s.TABLES}
    assert {r["n_rows"] for r in audit.schema_report(written["gold"], sizes).collect()} == {n, 0}
    months = spark.createDataFrame([(month,) for month in MONTHS], "snapshot_date date")
    found = audit.written_row_audit(sources, written, months, sizes=sizes)
    assert found.where("n_missing <> 0").count() == 0
    assert n in {r["n_counted"] for r in found.where("table_name = 'feature_store'").collect()}
    predicted = audit.layer_row_audit(sources).where("table_name = 'feature_store' AND stage = 'output'")
    assert [r["n"] for r in predicted.collect()] == [n]
    again = {**sources, "attributes": sources["attributes"].withColumn("Age", F.lit("33"))}
    done = refresh.refresh(lake, again, MONTHS[0], MONTHS[-1]).where("action = 'rebuilt' AND layer = 'gold'")
    assert [(r["table_name"], r[s.SNAPSHOT]) for r in done.collect()] == [("feature_store", MONTHS[0])]


def test_versions_of_rows_and_of_groups_are_read_together(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    early, late = silver(bronze(spark, 2)), silver(bronze(spark, 3, MONTHS[1]))
    as_rows = gold.feature_store(**early)
    lake.write(as_rows, "gold", "feature_store", [MONTHS[0]])
    lake.publish(lake.stage(groups_of(late), "gold", "feature_store", [MONTHS[1]], grouped=True))
    both = as_rows.unionAll(gold.feature_store(**late))
    assert rows(lake.read("gold", "feature_store")) == rows(both)
    counts = {r[s.SNAPSHOT]: r["n"] for r in lake.row_counts("gold", "feature_store").collect()}
    assert counts == {MONTHS[0]: 18, MONTHS[1]: 83}
    lake.publish(lake.stage(groups_of(early), "gold", "feature_store", [MONTHS[0]], grouped=True))
    assert rows(lake.read("gold", "feature_store")) == rows(both)


@pytest.mark.parametrize("policy", [None, SkewPolicy(min_rows=2), SkewPolicy(min_rows=1)], ids=["plain", "two", "one"])
def test_labels_are_joined_to_lists(spark, tmp_path, policy):
    """Of groups and of rows together, with loans that occur twice, have two labels or none, or no id."""
    lake = Lake(spark, str(tmp_path))
    early, late = silver(bronze(spark, 2)), silver(bronze(spark, 4, MONTHS[1]))
    late["loans"] = late["loans"].unionAll(late["loans"].where("loan_id IN ('L1', 'alone')"))
    found = [("L0", 1), ("L1", 0), ("L1", 1), ("alone", 1), (None, 1), ("other", 0)]
    labels = spark.createDataFrame([(*row, "x") for row in found], "loan_id string, label int, label_def string")
    lake.write(gold.feature_store(**early), "gold", "feature_store", [MONTHS[0]])
    lake.publish(lake.stage(groups_of(late, policy), "gold", "feature_store", [MONTHS[1]], grouped=True))
    schema = s.GOLD["feature_store"]
    whole = gold.training_set(lake.read("gold", "feature_store"), labels)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = feature_groups.training_set(lake.read_groups(), labels, schema)
        assert joined.columns == whole.columns and rows(joined) == rows(whole)
        assert joined.count() == 3 * 2**3 + 1 + 5 * 4**3 + 2
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    generated = [line for line in plan.split("== Initial Plan ==")[0].splitlines() if "Generate inline(" in line or "Exchange" in line]
    last = max(i for i, line in enumerate(generated) if "Generate inline(financials" in line)
    first_exchange = min(i for i, line in enumerate(generated) if "Exchange" in line)
    assert last < first_exchange  # plans are printed from the result down: no exchange of features
    assert rows(feature_groups.training_set(lake.read_groups([MONTHS[0]]), labels, schema)) == rows(
        whole.where(F.col(s.SNAPSHOT) == F.lit(MONTHS[0]))
    )


def test_compressed_sources_read_the_same(spark, tmp_path):
    table = bronze(spark, 4)["financials"]
    csv.write_csv(table, str(tmp_path / "plain"))
    csv.write_csv(table.coalesce(1), str(tmp_path / "packed"), packed=2)
    packed = csv.read_source(spark, str(tmp_path / "packed"), s.BRONZE["financials"])
    assert rows(packed) == rows(csv.read_source(spark, str(tmp_path / "plain"), s.BRONZE["financials"]))
    assert len(list((tmp_path / "packed").glob("*.csv.gz"))) == 3  # five rows, two a file


def test_combinations_are_not_kept(spark):
    """Generated code keeps the rows that it makes of an input row, so it takes one list of a group apart at most."""
    tables = silver(bronze(spark, 2))
    labels = spark.createDataFrame([("L0", 1, "30dpd_6mob")], [s.LOAN, *s.LABELS])
    groups, schema = groups_of(tables), s.GOLD["feature_store"]
    training = feature_groups.training_set(groups, labels, schema)
    for made, least in [(feature_groups.expand(groups, schema), 4), (training, 3)]:
        made.collect()
        plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        lists = [line for line in plan.splitlines() if " Generate inline(" in line]
        # The labels' join keeps the loans of a list apart from its other lists.
        assert len([line for line in lists if "*(" in line and "inline(loans" not in line]) <= 1, plan
        assert len(lists) >= least and (made is training or "*(" not in lists[-1]), plan
