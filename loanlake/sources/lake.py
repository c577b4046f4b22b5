"""Tables of the three layers as parquet, partitioned by snapshot month.

A write goes to a folder of its own, its version, which no reader knows. One record in the log of processed months then
publishes all months of a step: readers find the version of each month in the log, so they see all of a step or nothing
of it, and a run that is killed between two writes leaves the months as they were. ``Lake.vacuum`` deletes what no month
uses any more.

The feature store is staged as groups (``operators.feature_groups``), in versions whose name tells, and read as rows;
versions of rows are read as they are.
"""

import uuid
import warnings
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, MapType, StringType, StructField, StructType, TimestampType

from loanlake.operators import feature_groups
from loanlake.schemas import SNAPSHOT, TABLES
from loanlake.sources.scratch import release_shuffles
from loanlake.sources.tally import Tally

# Log of processed months: one row per run, table and month, months without rows included. A row without a month holds
# the counts of rows that belong to none.
PROCESSED = StructType(
    [
        StructField("layer", StringType()),
        StructField("table_name", StringType()),
        StructField(SNAPSHOT, DateType()),
        StructField("n_rows", LongType()),
        StructField("noted_at", TimestampType()),
        StructField("version", StringType()),  # the folder of the month; NULL below the table's own
        StructField("definition", StringType()),  # what the rows depend on besides the tables below
        StructField("fingerprint", StringType()),  # of the rows, if it is known
        StructField("changed_at", TimestampType()),  # when the rows became what they are
        StructField("counts", MapType(StringType(), LongType())),  # rows by stage, as counted by the write
    ]
)
OUTPUT = "output"
#: What the name of a version of groups begins with.
GROUPS = "groups-"
FEATURES = ("gold", "feature_store")


def of_months(months: list[date]) -> Column:
    """True for rows of the given months; as a partition filter it keeps other files from being opened."""
    return F.col(SNAPSHOT).isin(months)


@dataclass(frozen=True)
class Staged:
    """Months of a table that are written and that no reader sees yet."""

    layer: str
    table: str
    months: list[date]
    version: str
    counts: dict[str, dict[date | None, int] | None]
    definition: str = ""
    fingerprints: dict[date, str] = field(default_factory=dict)
    replaced: dict[date, str] = field(default_factory=dict)  # fingerprints of the months as they are published

    @property
    def grouped(self) -> bool:
        return self.version.startswith(GROUPS)


@dataclass(frozen=True)
class Lake:
    """A folder of tables ``<root>/<layer>/<table>/_versions/version=<id>/snapshot_date=yyyy-MM-dd/``."""

    spark: SparkSession
    root: str
    schemas: dict[str, dict[str, StructType]] = field(default_factory=lambda: TABLES)
    # The log as of its files when it was last read.
    _seen: dict[frozenset, dict[tuple[str, str], list[Row]]] = field(default_factory=dict, repr=False, compare=False)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def _versions(self, layer: str, table: str) -> str:
        return f"{self.path(layer, table)}/_versions"

    def read(self, layer: str, table: str, months: list[date] | None = None) -> DataFrame:
        """A table with its declared schema, of all or of some months, as published. One never written reads as empty.

        A table that the log doesn't know is read from its own folder, as are months logged without a version.
        """
        known = [row for row in self._published(layer, table) if row[SNAPSHOT] is not None]
        schema, own = self.schemas[layer][table], self.path(layer, table)
        if not known:
            df = read_table(self.spark, own, schema)
            return df if months is None else df.where(of_months(months))
        wanted = [row for row in known if row["n_rows"] and (months is None or row[SNAPSHOT] in months)]
        parts = self._rows(layer, table, wanted)
        groups = self._groups(layer, table, wanted)
        if groups is not None:
            parts.append(feature_groups.expand(groups, schema))
        return reduce(DataFrame.unionAll, parts) if parts else self.spark.createDataFrame([], schema)

    def _rows(self, layer: str, table: str, records: list[Row]) -> list[DataFrame]:
        """The months of the given records that are stored as rows."""
        schema, own = self.schemas[layer][table], self.path(layer, table)
        plain = [row[SNAPSHOT] for row in records if row["version"] is None]
        parts = [read_table(self.spark, own, schema).where(of_months(plain))] if plain else []
        of_rows = [row for row in records if row["version"] is not None and not row["version"].startswith(GROUPS)]
        versioned = self._read_versions(layer, table, of_rows, schema)
        return parts if versioned is None else [*parts, versioned]

    def _groups(self, layer: str, table: str, records: list[Row]) -> DataFrame | None:
        """The months of the given records that are stored as groups, as groups."""
        of_groups = [row for row in records if row["version"] is not None and row["version"].startswith(GROUPS)]
        if not of_groups:
            return None
        return self._read_versions(layer, table, of_groups, feature_groups.group_schema(self.schemas[layer][table]))

    def read_groups(self, months: list[date] | None = None) -> DataFrame:
        """The feature store as groups, of all or of some months, as published; what is stored as rows has one each."""
        layer, table = FEATURES
        records = [row for row in self._published(layer, table) if row[SNAPSHOT] is not None]
        if not records:
            return feature_groups.of_rows(self.read(layer, table, months))
        records = [row for row in records if row["n_rows"] and (months is None or row[SNAPSHOT] in months)]
        groups = self._groups(layer, table, records)
        parts = [feature_groups.of_rows(df) for df in self._rows(layer, table, records)]
        if groups is not None:
            parts.append(groups)
        empty = self.spark.createDataFrame([], feature_groups.group_schema(self.schemas[layer][table]))
        return reduce(DataFrame.unionAll, parts) if parts else empty

    def row_counts(self, layer: str, table: str) -> DataFrame:
        """``snapshot_date, n`` of a table as it is read, from its files; groups are counted without their rows."""
        known = self._published(layer, table)
        records = [row for row in known if row[SNAPSHOT] is not None and row["n_rows"]]
        groups, rows = self._groups(layer, table, records), self._rows(layer, table, records)
        if groups is None:
            return self.read(layer, table).groupBy(SNAPSHOT).agg(F.count("*").alias("n"))
        counts = [df.groupBy(SNAPSHOT).agg(F.count("*").alias("n")) for df in rows]
        return reduce(DataFrame.unionAll, [*counts, feature_groups.row_counts(groups).select(SNAPSHOT, "n")])

    def fingerprints(self, layer: str, table: str, months: list[date]) -> dict[date, str]:
        """Of the given months of a table as published."""
        if (layer, table) != FEATURES:
            return month_fingerprints(self.read(layer, table, months), months)
        records = [row for row in self.months_of(layer, table).values() if row["n_rows"] and row[SNAPSHOT] in months]
        groups = self._groups(layer, table, records)
        parts = [feature_groups.of_rows(df) for df in self._rows(layer, table, records)]
        if groups is not None:
            parts.append(groups)
        return _of_groups(reduce(DataFrame.unionAll, parts), months) if parts else dict.fromkeys(months, "0")

    def staged_fingerprints(self, staged: Staged) -> dict[date, str]:
        """Of what was staged, comparable with :meth:`fingerprints`."""
        if (staged.layer, staged.table) != FEATURES:
            return month_fingerprints(self.read_staged(staged), staged.months)
        stored = self._read_stored(staged)
        return _of_groups(stored if staged.grouped else feature_groups.of_rows(stored), staged.months)

    def _read_versions(self, layer: str, table: str, rows: list[Row], schema: StructType) -> DataFrame | None:
        by_version: dict[str, list[date]] = {}
        for row in rows:
            by_version.setdefault(row["version"], []).append(row[SNAPSHOT])
        if not by_version:
            return None
        folder = self._versions(layer, table)
        files = self.spark.read.schema(StructType([*schema.fields, StructField("version", StringType())]))
        df = files.option("basePath", folder).parquet(*[f"{folder}/version={v}" for v in by_version])
        only = [(F.col("version") == v) & of_months(months) for v, months in by_version.items()]
        return df.where(reduce(Column.__or__, only)).select(*schema.names)

    def stage(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        months: list[date],
        rebalance: bool = False,
        sort_by: list[str] | None = None,
        tallies: dict[str, Tally] | None = None,
        tags: Tally | None = None,
        definition: str = "",
        grouped: bool = False,
    ) -> Staged:
        """Write the rows that ``df`` has of the given months where no reader looks; see :meth:`publish`.

        ``rebalance`` shuffles by month first, for rows that come in no month order: without it each task would leave
        a small file in every month. Adaptive execution splits a large month over many tasks and merges small ones.
        ``sort_by`` sorts rows within each file, so that scans that filter on these columns skip most of it.
        ``tallies`` count rows on their way through ``df``, by stage; ``tags`` counts the output by its tags.
        ``grouped`` tells that ``df`` has groups of features.
        """
        schema, version, output = self.schemas[layer][table], uuid.uuid4().hex, Tally()
        if grouped:
            schema, version = feature_groups.group_schema(schema), f"{GROUPS}{version}"
        rows = output.watch(df.where(of_months(months)).select(*schema.names))
        rows = tags.watch(rows) if tags else rows
        write_partitioned(rows, f"{self._versions(layer, table)}/version={version}", rebalance, sort_by)
        release_shuffles(self.spark)
        counts: dict[str, dict[date | None, int] | None] = {}
        for stage, tally in {**(tallies or {}), OUTPUT: output}.items():
            found = tally.counts()
            counts[stage] = None if found is None else {month: n for (month, _), n in found.items()}
        for (month, tag), n in ((tags.counts() if tags else None) or {}).items():
            counts.setdefault(tag, {})[month] = n
        return Staged(layer, table, list(months), version, counts, definition)

    def read_staged(self, staged: Staged) -> DataFrame:
        """What was staged, before it is published."""
        stored, schema = self._read_stored(staged), self.schemas[staged.layer][staged.table]
        return feature_groups.expand(stored, schema) if staged.grouped else stored

    def _read_stored(self, staged: Staged) -> DataFrame:
        path = f"{self._versions(staged.layer, staged.table)}/version={staged.version}"
        schema = self.schemas[staged.layer][staged.table]
        return read_table(self.spark, path, feature_groups.group_schema(schema) if staged.grouped else schema)

    def publish(self, *staged: Staged) -> None:
        """Replace the staged months, in all tables at once, by what was staged; other months stay.

        The rows of each month are compared with the footers of the files. Where they differ, tasks were repeated: the
        files are right, and what else the write has counted is unknown.
        """
        staged = tuple(s for s in staged if s.months)
        if not staged:
            return
        found = self._written(staged)
        before = {(s.layer, s.table): {r[SNAPSHOT]: r for r in self._published(s.layer, s.table)} for s in staged}
        rows = []
        for s in staged:
            of_files = {month: found.get((s.layer, s.table, month), (0, 0)) for month in s.months}
            written, output = {month: n for month, (_, n) in of_files.items()}, s.counts[OUTPUT]
            sure = output is not None and all(output.get(month, 0) == stored for month, (stored, _) in of_files.items())
            counts = {stage: of for stage, of in s.counts.items() if sure and of is not None}
            outside = {stage: sum(n for month, n in of.items() if month not in written) for stage, of in counts.items()}
            for month, n in written.items():
                old = before[s.layer, s.table].get(month)
                print_ = s.fingerprints.get(month)
                same = old is not None and print_ is not None and s.replaced.get(month, old["fingerprint"]) == print_
                rows.append(
                    (s.layer, s.table, month, n, s.version, s.definition, print_,
                     old["changed_micros"] if same else None,
                     {**{stage: of.get(month, 0) for stage, of in counts.items()}, OUTPUT: n})
                )
            if any(outside.values()):
                rows.append((s.layer, s.table, None, 0, s.version, s.definition, None, None, outside))
        kinds = "layer string, table_name string, snapshot_date date, n_rows long, version string, definition string, "
        record = self.spark.createDataFrame(
            rows, f"{kinds}fingerprint string, changed_micros long, counts map<string, long>"
        )
        now = F.current_timestamp()
        record = record.withColumns(
            {"noted_at": now, "changed_at": F.coalesce(F.timestamp_micros("changed_micros"), now)}
        )
        # One file, which appears when it is complete: this is the moment of publication.
        record.select(*PROCESSED.names).coalesce(1).write.mode("append").parquet(self._log)

    def _written(self, staged: tuple[Staged, ...]) -> dict[tuple[str, str, date], tuple[int, int]]:
        """Rows in the files of each staged month, from their footers, and rows that are read of them: more, of groups."""
        parts = []
        for s in staged:
            if s.grouped:
                counts = feature_groups.row_counts(self._read_stored(s))
            else:
                n = F.count("*")
                counts = self._read_stored(s).groupBy(SNAPSHOT).agg(n.alias("n_stored"), n.alias("n"))
            parts.append(counts.select(F.lit(s.layer).alias("layer"), F.lit(s.table).alias("table_name"), "*"))
        # Tables times months, at most a few thousand rows.
        return {
            (row["layer"], row["table_name"], row[SNAPSHOT]): (row["n_stored"], row["n"])
            for row in reduce(DataFrame.unionAll, parts).collect()
        }

    def write(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        months: list[date],
        rebalance: bool = False,
        sort_by: list[str] | None = None,
    ) -> None:
        """Replace the given months by the rows ``df`` has of them; other months stay."""
        if months:
            self.publish(self.stage(df, layer, table, months, rebalance, sort_by))

    def exists(self) -> bool:
        """Has anything been processed here?"""
        return find_table(self.spark, self._log, PROCESSED) is not None

    @property
    def _log(self) -> str:
        return f"{self.root.rstrip('/')}/processed"

    def latest(self) -> DataFrame:
        """The last record of each layer, table and month."""
        log = read_table(self.spark, self._log, PROCESSED).coalesce(1)  # few rows: one task, no shuffle
        rest = [name for name in PROCESSED.names if name not in ("layer", "table_name", SNAPSHOT)]
        last = log.groupBy("layer", "table_name", SNAPSHOT).agg(F.max_by(F.struct(*rest), "noted_at").alias("last"))
        return last.select("layer", "table_name", SNAPSHOT, "last.*")

    def _published(self, layer: str, table: str) -> list[Row]:
        """The last record of each month of a table; times as microseconds. Without a log, no job runs.

        The log is read again when a file was added to it.
        """
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(self._log)
        fs = folder.getFileSystem(conf)
        if not fs.exists(folder):
            return []
        files = frozenset(file.getPath().getName() for file in fs.listStatus(folder))
        seen = self._seen.get(files)
        if seen is None:
            times = {f"{c}_micros": F.unix_micros(F.coalesce(f"{c}_at", "noted_at")) for c in ("noted", "changed")}
            rows = self.latest().withColumns(times).drop("counts", "noted_at", "changed_at").coalesce(1)
            found: dict[tuple[str, str], list[Row]] = {}
            for row in rows.collect():  # tables times months, bounded by the calendar
                found.setdefault((row["layer"], row["table_name"]), []).append(row)
            self._seen.clear()
            self._seen[files] = found
            return found.get((layer, table), [])
        return seen.get((layer, table), [])

    def months_of(self, layer: str, table: str) -> dict[date, Row]:
        """The last record of each processed month: ``n_rows``, ``definition``, ``fingerprint``, ``noted_micros`` and
        ``changed_micros``."""
        return {row[SNAPSHOT]: row for row in self._published(layer, table) if row[SNAPSHOT] is not None}

    def processed(self) -> DataFrame:
        """Rows by layer, table and month of everything processed so far, as of the last run of each month."""
        return self.latest().where(F.col(SNAPSHOT).isNotNull()).select("layer", "table_name", SNAPSHOT, "n_rows")

    def processed_months(self, layer: str, tables: list[str], months: list[date]) -> dict[str, list[date]]:
        """Those of the given months that have been processed, empty or not, for each table."""
        wanted = (F.col("layer") == layer) & F.col("table_name").isin(tables) & of_months(months)
        done = self.processed().where(wanted).select("table_name", SNAPSHOT).collect()  # at most tables times months
        return {table: sorted(row[SNAPSHOT] for row in done if row["table_name"] == table) for table in tables}

    def vacuum(self, keep_hours: float = 24.0) -> list[str]:
        """Delete the versions of months that no month uses any more; returns the deleted folders.

        Versions younger than ``keep_hours`` stay: a reader may still read them, or a run be about to publish them.
        """
        used = {(r["layer"], r["table_name"], r["version"], r[SNAPSHOT]) for r in self.latest().drop("counts").collect()}
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        place = jvm.org.apache.hadoop.fs.Path
        fs = place(self.root).getFileSystem(conf)
        oldest = jvm.java.lang.System.currentTimeMillis() - int(keep_hours * 3_600_000)
        deleted = []
        for layer, tables in self.schemas.items():
            for table in tables:
                folder = place(self._versions(layer, table))
                for version in fs.listStatus(folder) if fs.exists(folder) else []:
                    name = version.getPath().getName().removeprefix("version=")
                    if version.getModificationTime() > oldest:
                        continue
                    own = {m for lay, t, v, m in used if (lay, t, v) == (layer, table, name) and m is not None}
                    gone = [
                        month.getPath() for month in fs.listStatus(version.getPath())
                        if month.getPath().getName().removeprefix(f"{SNAPSHOT}=") not in {str(m) for m in own}
                    ] if own else [version.getPath()]
                    for path in gone:
                        if own and not path.getName().startswith(f"{SNAPSHOT}="):
                            continue
                        fs.delete(path, True)
                        deleted.append(path.toString())
        return deleted


def newest_files(written: DataFrame) -> DataFrame:
    """``snapshot_date, file`` of a table that is read from files: the largest hash of a file name of each month."""
    files = written.select(SNAPSHOT, F.xxhash64("_metadata.file_path").alias("file"))
    return files.groupBy(SNAPSHOT).agg(F.max("file").alias("file"))


def fingerprints(df: DataFrame) -> DataFrame:
    """``snapshot_date, fingerprint``: the number of rows and the sum of their hashes, whatever their order.

    A hash leaves NULL out, so it is told which columns are NULL. Sums are of 128 bits and add up before the shuffle.
    """
    own = [name for name in df.columns if name != SNAPSHOT]
    hashed = F.xxhash64(*own, *[F.col(name).isNull() for name in own]).cast("decimal(20,0)")
    found = df.groupBy(SNAPSHOT).agg(F.count("*").alias("n"), F.sum(hashed).alias("total"))
    return found.select(SNAPSHOT, F.concat_ws(":", "n", F.col("total").cast("string")).alias("fingerprint"))


def month_fingerprints(df: DataFrame, months: list[date]) -> dict[date, str]:
    """Of each of the given months; those without rows have one as well."""
    found = fingerprints(df.where(of_months(months))).collect()  # months, bounded by the calendar
    return {**dict.fromkeys(months, "0"), **{row[SNAPSHOT]: row["fingerprint"] for row in found}}


def _of_groups(groups: DataFrame, months: list[date]) -> dict[date, str]:
    found = feature_groups.fingerprints(groups.where(of_months(months))).collect()  # months, bounded by the calendar
    return {**dict.fromkeys(months, "0"), **{row[SNAPSHOT]: row["fingerprint"] for row in found}}


def find_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """A parquet table with a declared schema; None if nothing was written there yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A parquet table with a declared schema; an empty one if nothing was written there yet."""
    found = find_table(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found.select(*schema.names)


def write_partitioned(
    df: DataFrame, path: str, rebalance: bool = False, sort_by: list[str] | None = None
) -> None:
    """Write by snapshot month and replace only the months that ``df`` has rows of.

    Without adaptive execution, which splits a month over tasks, there is no ``rebalance``: a month must not go
    through one task. A warning says so, as each task then writes a small file into every month.
    """
    if rebalance:
        if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            df = df.hint("rebalance", SNAPSHOT)
        else:
            warnings.warn(f"adaptive execution is off: {path} gets a file per task and month", stacklevel=2)
    if sort_by:
        df = df.sortWithinPartitions(SNAPSHOT, *sort_by)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(SNAPSHOT).parquet(path)
