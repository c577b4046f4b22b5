"""Intermediate tables in the folder that all executors share."""

import os

from pyspark.sql import DataFrame, SparkSession

from loanlake.sources.scratch import scratch_root


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if that place exists on their machine.

    A cluster has the package installed or in ``--py-files``; a local session may have it on the driver's path only.
    """
    here = os.path.abspath(__file__)
    for _ in range(3):
        here = os.path.dirname(here)
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, here])


class Stash:
    """Tables of one run below ``spark.checkpoint.dir``.

    A stashed table cuts the lineage: what reads it repeats no earlier step, and a lost executor costs the tasks of
    one step only. Nothing is kept in executors' memory or on their own disks.
    """

    def __init__(self, spark: SparkSession):
        share_package(spark)
        self._spark = spark
        self._root = scratch_root(spark)
        self._count = 0
        self._paths: dict[int, str] = {}
        self._tables: list[DataFrame] = []  # alive, so that their ids stay theirs

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self._root}/{self._count:03d}-{name}"

    def keep(self, df: DataFrame, name: str, **options) -> DataFrame:
        """Write ``df``, with the writer's ``options``, and read it back."""
        path = self.path(name)
        df.write.options(**options).parquet(path)
        kept = self._spark.read.schema(df.schema).parquet(path)
        self._paths[id(kept)] = path
        self._tables.append(kept)
        return kept

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all tables of this run but the given ones, which are all that is read from now on."""
        wanted = {self._paths[id(table)] for table in tables}
        jvm, conf = self._spark._jvm, self._spark._jsc.hadoopConfiguration()
        for path in set(self._paths.values()) - wanted:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        self._tables = list(tables)
        self._paths = {id(table): self._paths[id(table)] for table in tables}
