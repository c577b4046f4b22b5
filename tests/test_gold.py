"""Rows of the feature and label store on small literal tables."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from loanlake import schemas as s
from loanlake.operators import audit, gold, silver
from loanlake.operators.joins import SkewPolicy

DAY = date(2023, 5, 1)


def frame(spark, schema, *given):
    return spark.createDataFrame([tuple(row.get(name) for name in schema.names) for row in given], schema)


def bronze(spark, loans, clickstream=(), attributes=(), financials=()):
    tables = {"clickstream": clickstream, "attributes": attributes, "financials": financials, "loans": loans}
    keyed = {name: [{s.CUSTOMER: "c1", s.SNAPSHOT: DAY, **row} for row in given] for name, given in tables.items()}
    return {name: frame(spark, s.BRONZE[name], *given) for name, given in keyed.items()}


def features(tables):
    return gold.feature_store(**{name: clean(tables[name]) for name, clean in silver.CLEANERS.items()})


def loan(**values):
    return {"loan_id": " L1 ", "loan_start_date": DAY, "tenure": 10, "installment_num": 0, "loan_amt": 5.0, **values}


def test_loan_without_customer_rows(spark, any_ansi):
    row = features(bronze(spark, [loan()])).first()
    assert (row["Customer_ID"], row["loan_id"], row["fe_1"], row["Age"]) == ("C1", "L1", None, 0)
    assert (row["Occupation"], row["Credit_Mix"], row["Annual_Income"]) == ("Unknown", "Unknown", 0.0)
    assert (row["income_to_loan_ratio"], row["credit_utilization_risk"]) == (0.0, "Low")


def test_unreadable_counts_become_zero_in_gold_only(spark, any_ansi):
    given = [{"Num_of_Loan": "3_", "Annual_Income": "abc"}]
    tables = bronze(spark, [loan()], financials=given)
    clean = silver.clean_financials(tables["financials"]).first()
    assert (clean["Num_of_Loan"], clean["Annual_Income"], clean["Num_of_Delayed_Payment"]) == (None, None, 0)
    row = features(tables).first()
    assert (row["Num_of_Loan"], row["Annual_Income"]) == (0, 0.0)


def test_duplicates_of_a_customer_row_multiply(spark):
    tables = bronze(spark, [loan()], attributes=[{"Age": "30"}, {"Age": "31"}], clickstream=[{"fe_1": 1.0}] * 3)
    assert sorted(row["Age"] for row in features(tables).collect()) == [30] * 3 + [31] * 3


def test_only_the_month_of_application_counts(spark):
    rows = [loan(), loan(loan_id="L2", installment_num=1), loan(loan_id="L3", installment_num=None)]
    other_month = [{"Age": "30", s.SNAPSHOT: date(2023, 6, 1)}]
    found = features(bronze(spark, rows, attributes=other_month)).collect()
    assert sorted((row["loan_id"], row["Age"]) for row in found) == [("L1", 0), ("L3", 0)]


def test_keys(spark):
    ids = [loan(Customer_ID="  "), loan(Customer_ID=None), loan(loan_id=None), loan(snapshot_date=None)]
    clean = silver.clean_loans(bronze(spark, ids)["loans"])
    assert [row["Customer_ID"] for row in clean.collect()] == [""]


def test_ssn_is_masked(spark):
    clean = silver.clean_attributes(bronze(spark, [], attributes=[{"SSN": "1"}, {}])["attributes"])
    assert {row["SSN"] for row in clean.collect()} == {"MASKED"}


def test_other_columns_pass_through(spark):
    tables = bronze(spark, [loan()], clickstream=[{"fe_1": 1.0}])
    tables["clickstream"] = tables["clickstream"].withColumn("fe_21", F.lit(9))
    assert features(tables).first()["fe_21"] == 9


@pytest.mark.parametrize("dpd, expected", [(30, 1), (31, 0)])
def test_label_threshold(spark, dpd, expected):
    row = loan(loan_start_date=date(2022, 11, 1), due_amt=100.0, overdue_amt=100.0)
    labels = gold.label_store(silver.clean_loans(bronze(spark, [row])["loans"]), dpd=dpd, mob=6)
    assert [(r["label"], r["label_def"]) for r in labels.collect()] == [(expected, f"{dpd}dpd_6mob")]


def test_training_set(spark):
    started = loan(snapshot_date=date(2022, 11, 1), loan_start_date=date(2022, 11, 1))
    later = loan(loan_start_date=date(2022, 11, 1), installment_num=6, due_amt=100.0, overdue_amt=100.0)
    unlabelled = loan(loan_id="L2")
    tables = bronze(spark, [started, later, unlabelled])
    labels = gold.label_store(silver.clean_loans(tables["loans"]))
    rows = gold.training_set(features(tables), labels).collect()
    assert [(r["loan_id"], r["label"], r["snapshot_date"]) for r in rows] == [("L1", 1, date(2022, 11, 1))]


def test_features_are_counted_without_being_made(spark):
    """Three hundred rows of a key in every table are eight billion features."""
    many = 300
    tables = bronze(spark, [loan()] * many, [{"fe_1": 1.0}] * many, [{"Age": "30"}] * many, [{"Credit_Mix": "Good"}] * many)
    found = audit.layer_row_audit(tables).where("table_name = 'feature_store' AND stage = 'output'")
    assert [row["n"] for row in found.collect()] == [many**4]
    few = {name: clean(df.limit(3)) for (name, df), clean in zip(tables.items(), [silver.CLEANERS[n] for n in tables])}
    assert gold.feature_counts(**few).first()["n"] == gold.feature_store(**few).count() == 81


def test_labels_are_joined_before_rows_multiply(spark):
    started = loan(snapshot_date=date(2022, 11, 1), loan_start_date=date(2022, 11, 1))
    later = loan(loan_start_date=date(2022, 11, 1), installment_num=6, due_amt=100.0, overdue_amt=100.0)
    blank = [{**row, "Customer_ID": " ", "loan_id": "L3"} for row in (started, later, later)]
    month = {"snapshot_date": date(2022, 11, 1)}
    tables = bronze(
        spark, [started, later, later, *blank, {**started, "loan_id": "L2"}, {**started, "Customer_ID": "other"}],
        [{"fe_1": x, **month} for x in (1.0, 2.0, None)], [{"Age": "30", **month}] * 2,
        [{"Credit_Mix": "Good", **month, "Customer_ID": c} for c in (" ", " ", "c1")],
    )
    clean = {name: silver.CLEANERS[name](df) for name, df in tables.items()}
    labels = gold.label_store(clean["loans"])
    found, whole = gold.training_features(**clean, labels=labels), gold.training_set(gold.feature_store(**clean), labels)
    assert found.columns == whole.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect())) and found.count() >= 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold.training_features(**clean, labels=labels)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_loan = [part for part in plan.split("\n\n") if "Exchange" in part and "hashpartitioning(loan_id" in part]
    assert len(by_loan) == 2 and not any("Credit_Mix" in part or "fe_1" in part for part in by_loan)


def test_hot_loans_are_spread_before_rows_multiply(spark):
    """Labels of a loan with many rows are joined by slices; the features aren't in any exchange."""
    month = {"snapshot_date": date(2022, 11, 1)}
    started = loan(**month, loan_start_date=date(2022, 11, 1))
    later = loan(loan_start_date=date(2022, 11, 1), installment_num=6, due_amt=100.0, overdue_amt=100.0)
    given = [started, started, {**started, "Customer_ID": " "}, later, later, {**started, "loan_id": "L2"}]
    tables = bronze(
        spark, given, [{"fe_1": x, **month} for x in (1.0, 2.0)], [{"Age": "30", **month}] * 2, [{"Credit_Mix": "Good", **month}]
    )
    clean = {name: silver.CLEANERS[name](df) for name, df in tables.items()}
    labels, policy = gold.label_store(clean["loans"]), SkewPolicy(min_rows=1)
    whole = gold.training_set(gold.feature_store(**clean), labels, policy)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = gold.training_features(**clean, labels=labels, policy=policy)
        plan = found._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert found.columns == whole.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect())) and found.count() == 2 * (2 * 4 + 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_loan = [part for part in plan.split("\n\n") if "Exchange" in part and "hashpartitioning(loan_id" in part]
    assert by_loan and "_left_slot" in "".join(by_loan) and not any("fe_1" in part for part in by_loan)
