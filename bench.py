"""Times the whole run and the headline queries on its tables, and prints one JSON line.

The run goes from CSV sources, written beforehand, to the gold tables of all months. Each query is then run once to
warm the session up and timed on the next run; all its rows and columns are produced and dropped.
"""

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake import schemas as s
from loanlake.operators import audit, gold
from loanlake.operators.silver import CLEANERS
from loanlake.plans import backfill
from loanlake.sources import csv, orders_feed
from loanlake.sources.lake import Lake
from loanlake.sources.scratch import scratch_root


def _seconds(run) -> float:
    began = time.perf_counter()
    run()
    return round(time.perf_counter() - began, 3)


def _produce(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def _whole_run(lake: Lake, sources: dict[str, DataFrame]) -> dict[str, float]:
    first, last = sources["loans"].agg(F.min(s.SNAPSHOT), F.max(s.SNAPSHOT)).first()
    months = backfill.month_starts(first, last)
    return {
        "run_bronze": _seconds(lambda: backfill.load_bronze(lake, sources, months)),
        "run_silver": _seconds(lambda: backfill.build_silver(lake, months)),
        "run_features": _seconds(lambda: backfill.build_features(lake, months)),
        "run_labels": _seconds(lambda: backfill.build_labels(lake, months)),
    }


def _headline(lake: Lake) -> dict:
    def layer(name: str) -> dict[str, DataFrame]:
        return {table: lake.read(name, table) for table in s.TABLES[name]}

    def cleaned(table: str):
        return lambda: CLEANERS[table](lake.read("bronze", table))

    return {
        **{f"silver_{table}": cleaned(table) for table in CLEANERS},
        "loans_at_application": lambda: gold.loans_at_application(lake.read("silver", "loans")),
        "gold_feature_store": lambda: gold.feature_store(**layer("silver")),
        "gold_label_store": lambda: gold.label_store(lake.read("silver", "loans")),
        "label_distribution": lambda: audit.label_distribution(lake.read("gold", "label_store")),
        "layer_row_audit": lambda: audit.layer_row_audit(layer("bronze")),
        "dataset_profile": lambda: audit.dataset_profile(layer("gold")),
        "training_set": lambda: gold.training_set(*layer("gold").values()),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loanlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_root(spark)
    for table, rows in orders_feed.source_tables(spark, folder).items():
        csv.write_csv(rows, f"{root}/source/{csv.SOURCE_FILES[table]}")
    lake = Lake(spark, f"{root}/lake")
    times = _whole_run(lake, csv.read_sources(spark, f"{root}/source"))
    for name, build in _headline(lake).items():
        _produce(build())
        times[name] = _seconds(lambda: _produce(build()))
    spark.stop()
    result = {
        "metric": "total time of the run over all months and of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    sys.stdout.flush()


if __name__ == "__main__":
    main()
