"""Equi-joins that stay balanced when a few keys hold a large share of the rows.

A plain sort-merge join sends all rows of a key to one task. Here keys above a share of their table are found first
and only their rows are spread over several slices, while the matching rows of the other side are copied to each
slice. Results are the same as those of the plain join; without such keys the plan is the plain join too.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewPolicy:
    """A key is hot if it has more than ``min_rows`` rows and more than ``1 / max_keys`` of its table.

    So a table has fewer than ``max_keys`` hot keys whatever its size, which bounds what is collected and broadcast
    to about a megabyte. Each slice of a hot key holds about ``min_rows`` rows, also in the largest table. ``tracked``
    is several times ``max_keys``: the sketch that finds candidates is off by a few rows in so many.
    """

    max_keys: int = 10_000
    min_rows: int = 2_000_000
    tracked: int = 1 << 16

    def least_rows(self, total: Column) -> Column:
        return F.greatest(F.lit(self.min_rows), F.ceil(total / F.lit(self.max_keys)))


DEFAULT_POLICY = SkewPolicy()
_MERGED_TOGETHER = 64


def hot_keys(
    tables: dict[str, DataFrame], keys: list[str], policy: SkewPolicy = DEFAULT_POLICY
) -> dict[str, DataFrame]:
    """The hot keys of each table that has any, as small tables of the keys and their ``slices``.

    One pass over the key columns of each table fills a sketch of frequent items per task; sketches are merged in two
    steps. Only what the sketch names is counted in full, so ordinary data needs no second pass. This runs jobs;
    operators that are given no hot keys run none.
    """
    found = {}
    for name, df in tables.items():
        hashed = df.select(F.xxhash64(*keys).alias("h"), F.pmod(F.spark_partition_id(), F.lit(_MERGED_TOGETHER)).alias("p"))
        sketch = F.expr(f"approx_top_k_accumulate(h, {policy.tracked})").alias("sketch")
        parts = hashed.groupBy("p").agg(sketch, F.count("*").alias("n"))
        top = F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {policy.tracked}), {policy.max_keys})")
        # By a constant, as sketches cannot be merged in tasks without any.
        row = parts.groupBy(F.lit("all")).agg(top.alias("top"), F.sum("n").alias("total")).first()
        if row is None:
            continue
        least = max(policy.min_rows, -(-row["total"] // policy.max_keys))
        candidates = [item["item"] for item in row["top"] or [] if item["count"] > least // 2]
        if not candidates:
            continue
        hot = (
            df.where(F.xxhash64(*keys).isin(candidates))
            .groupBy(*keys)
            .agg(F.count("*").alias("n"))
            .where(F.col("n") > policy.least_rows(F.lit(row["total"])))
            .select(*keys, F.ceil(F.col("n") / policy.min_rows).cast("int").alias("slices"))
        )
        rows = hot.collect()  # fewer than max_keys rows
        if rows:
            found[name] = df.sparkSession.createDataFrame(rows, hot.schema)
    return found


def _slices(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Add the slice count ``_n`` of the row's key, NULL for ordinary keys."""
    return df.join(F.broadcast(hot.withColumnRenamed("slices", "_n")), keys, "left")


def spread(df: DataFrame, keys: list[str], hot: DataFrame, slot: str) -> DataFrame:
    """Give each row of a hot key one slot.

    The slot follows from the row's values and the task that reads it: rows of one task are spread, and so are exact
    copies in several tasks. A task that is run again after a lost executor gives the same slots.
    """
    spot = F.xxhash64(*df.columns, F.spark_partition_id())
    own = F.when(F.col("_n").isNotNull(), F.pmod(spot, F.col("_n")).cast("int")).otherwise(F.lit(0))
    return _slices(df, keys, hot).withColumn(slot, own).drop("_n")


def _copy(df: DataFrame, keys: list[str], hot: DataFrame, slot: str) -> DataFrame:
    """Copy each row of a hot key to every slot of that key; ``_n`` tells these rows apart."""
    slots = F.sequence(F.lit(0), F.coalesce(F.col("_n"), F.lit(1)) - 1)
    return _slices(df, keys, hot).withColumn(slot, F.explode(slots))


#: Hashes of keys that are broadcast to thin out a table before its shuffle, at 8 bytes and a hash table entry each.
MOST_HASHES = 2_000_000


def matching_rows(
    rights: dict[str, DataFrame], left: DataFrame, keys: list[str], most_hashes: int = MOST_HASHES
) -> dict[str, DataFrame]:
    """The rows of each table whose keys have the hash of some key of ``left``: all that a join can match, and hardly
    a row more.

    The different hashes are counted first and broadcast if there are no more than ``most_hashes``; otherwise the
    tables stay whole. Hashes of different keys may be equal, so the join goes by the keys all the same.
    """
    hashes = left.select(F.xxhash64(*keys).alias("_hash")).distinct()
    if hashes.limit(most_hashes + 1).count() > most_hashes:
        return dict(rights)
    return {
        name: df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(hashes), "_hash", "left_semi").drop("_hash")
        for name, df in rights.items()
    }


def left_joins(
    left: DataFrame,
    rights: dict[str, DataFrame],
    keys: list[str],
    policy: SkewPolicy | None = None,
    hot: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Left-join each table of ``rights`` to ``left`` on the same keys, one after the other.

    All joins share the keys, so the left side is shuffled once. ``hot`` maps table names (``"left"`` for the left
    side) to their hot keys. Without it, they are looked up if a ``policy`` is given; with neither, no job runs and
    the joins are plain ones. Keys must not be NULL.
    """
    if hot is None:
        hot = hot_keys({"left": left, **rights}, keys, policy) if policy else {}
    on = list(keys)
    if "left" in hot:
        left = spread(left, keys, hot["left"], "_left_slot")
        on.append("_left_slot")
    # Tables with hot keys of their own come last: their join needs a partitioning of its own.
    for name in sorted(rights, key=lambda n: n in hot):
        right = rights[name]
        if "left" in hot:
            right = _copy(right, keys, hot["left"], "_left_slot").drop("_n")
        if name not in hot:
            left = left.join(right, on, "left")
            continue
        # A left row of a hot key is copied to every slot of the right side. The key exists there, so copies that
        # meet an empty slot are no missing match and are dropped.
        right = spread(right, keys, hot[name], "_slot").withColumn("_match", F.lit(True))
        left = (
            _copy(left, keys, hot[name], "_slot")
            .join(right, [*on, "_slot"], "left")
            .where(F.col("_n").isNull() | F.col("_match"))
            .drop("_n", "_slot", "_match")
        )
    return left.drop("_left_slot")


def inner_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    policy: SkewPolicy | None = None,
    hot: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Inner join with the rows of hot keys spread over slices on the side that has them; see :func:`left_joins`."""
    if hot is None:
        hot = hot_keys({"left": left, "right": right}, keys, policy) if policy else {}
    on = list(keys)
    if "left" in hot:
        left = spread(left, keys, hot["left"], "_left_slot")
        right = _copy(right, keys, hot["left"], "_left_slot").drop("_n")
        on.append("_left_slot")
    if "right" in hot:
        left = _copy(left, keys, hot["right"], "_slot").drop("_n")
        right = spread(right, keys, hot["right"], "_slot")
        on.append("_slot")
    return left.join(right, on, "inner").drop("_left_slot", "_slot")
