"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many arcs of a ring. A key goes to the arc its hash falls on; keys that find their shard full
continue clockwise to the next shard with room. How many keys each arc keeps and passes on follows from the counts of
the arcs alone, a table whose size is a parameter; keys are then placed by their rank within the arc.

Defined cases: NULL keys are one key; a NULL text is empty; repeated rows each get a slot. An empty table gives no
rows. Extra columns are ignored.
"""

import hashlib
from bisect import bisect_left
from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1 << 14
SALTS = 16


def ring(n_shards: int, nodes: int = 64) -> list[tuple[int, int]]:
    """``(cell, shard)`` of all virtual nodes clockwise. A further shard adds nodes and moves none."""
    places = []
    for shard in range(n_shards):
        for node in range(nodes):
            digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
            places.append((int.from_bytes(digest, "big") % CELLS, digest, shard))
    return [(cell, shard) for cell, _, shard in sorted(places)]


def capacities(total: int, n_shards: int, slack: float) -> list[int]:
    """Most keys of each shard. Without slack they add up to the total, and differ by one at most."""
    if slack <= 0:
        return [total // n_shards + (shard < total % n_shards) for shard in range(n_shards)]
    return [-int(-(1 + slack) * total // n_shards)] * n_shards


def place(counts: list[int], shards: list[int], most: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(arc, from_rank, to_rank, shard, first_slot)`` of keys, given the keys of each arc and its shard.

    One walk clockwise, and a second for keys still on their way. An arc's own keys go before those passed on.
    """
    used, runs, passed = [0] * len(most), [], deque()
    for turn in range(2):
        for arc, shard in enumerate(shards):
            if turn == 0 and counts[arc]:
                passed.appendleft((arc, 0, counts[arc]))
            while passed and used[shard] < most[shard]:
                source, begin, end = passed.popleft()
                taken = min(end - begin, most[shard] - used[shard])
                runs.append((source, begin, begin + taken, shard, used[shard]))
                used[shard] += taken
                if begin + taken < end:
                    passed.appendleft((source, begin + taken, end))
    return runs


def assign_shards(
    docs: DataFrame, n_shards: int = 8, slack: float = 0.0, nodes: int = 64, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` of every row; ``size`` is the text's bytes plus one.

    No shard gets more than ``(1 + slack)`` times its share of the rows; with no slack the counts differ by one at
    most. Slots of a shard count from 0 without gaps. Rows are ranked within ``SALTS`` parts of each arc, by hash, so a
    task ranks a small share of the rows whatever their source; what the driver sees are counts of ``n_shards *
    nodes * SALTS`` parts. Only ids, sizes and checksums are shuffled.
    """
    spark = docs.sparkSession
    arcs = ring(n_shards, nodes)
    cells = [cell for cell, _ in arcs]
    by_cell = [(cell, bisect_left(cells, cell) % len(arcs)) for cell in range(CELLS)]
    lookup = spark.createDataFrame(by_cell, "cell int, arc int")
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("_key"),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
    ).select(
        "*",
        F.xxhash64(F.lit("ring"), "_key").alias("_place"),
        F.pmod(F.xxhash64("_key", "text_crc32"), F.lit(SALTS)).cast("int").alias("_salt"),
    )
    rows = rows.withColumn("cell", F.pmod("_place", F.lit(CELLS)).cast("int"))
    rows = rows.join(F.broadcast(lookup), "cell").drop("cell")  # CELLS rows
    parts = rows.groupBy("arc", "_salt").agg(F.count("*").alias("n")).collect()  # a row per part of an arc
    counts, before = [0] * len(arcs), []
    for part in sorted(parts, key=lambda p: (p["arc"], p["_salt"])):
        before.append((part["arc"], part["_salt"], counts[part["arc"]]))
        counts[part["arc"]] += part["n"]
    runs = place(counts, [shard for _, shard in arcs], capacities(sum(counts), n_shards, slack))
    offsets = spark.createDataFrame(before, "arc int, _salt int, _before long")
    placed = spark.createDataFrame(runs, "arc int, _from long, _to long, shard int, _slot long")
    order = Window.partitionBy("arc", "_salt").orderBy("_place", "_key", "text_crc32", "size")
    ranked = (
        rows.withColumn("_n", F.row_number().over(order) - 1)
        .join(F.broadcast(offsets), ["arc", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_n"))
    )
    inside = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    return (
        ranked.alias("r")
        .join(F.broadcast(placed.withColumnRenamed("arc", "_arc")), (F.col("arc") == F.col("_arc")) & inside)
        .select(
            F.col("_key").alias(key), "size", "text_crc32", "shard",
            (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"),
        )
    )
