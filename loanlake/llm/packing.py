"""Packing of token sequences by minimum bin slack.

Texts longer than a window are cut into whole windows and a rest. All rests go into a histogram by length, whose size
is the window, not the corpus. Windows are planned on it: each takes the longest rest there is, and a subset-sum
dynamic program over a bitset finds the multiset of other rests that comes closest to the room left; walking back
through the program gives how many of each length. A plan is used for as many windows as the histogram has rests
for, so there are about as many plans as lengths. Rests are then dealt to the plans by their rank within a length.

Defined cases: a NULL or empty text has the end id only. NULL and repeated ids are rows like others. An empty table
gives no rows. Extra columns are ignored.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlake.llm.stash import Stash
from loanlake.llm.tokens import BATCH_BYTES, encoder, release_memory, with_end
from loanlake.llm.words import slices

SALTS = 64
PIECE = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def closest_filling(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length fill ``room`` best; among the best, one that uses long ones."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        steps.append((length, reach))
        left, part = min(counts[length], room // length), 1
        while left:
            part = min(part, left)
            reach |= (reach << (part * length)) & mask
            left -= part
            part *= 2
        if reach >> room & 1:
            break
    target, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> target & 1:
            target -= length
            n += 1
        if n:
            used[length] = n
    return used


def plan(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, from_rank, to_rank, per_window, first_sequence, offset)`` that place every rest."""
    left, placed = dict(histogram), dict.fromkeys(histogram, 0)
    runs, sequence = [], 0
    while left:
        longest = max(left)
        others = left | {longest: left[longest] - 1}
        used = closest_filling(others, window - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[length] // n for length, n in used.items())
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            runs.append((length, placed[length], placed[length] + n * times, n, sequence, offset))
            offset += n * length
            placed[length] += n * times
            left[length] -= n * times
            if not left[length]:
                del left[length]
        sequence += times
    return runs


def cut(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """A row per piece: whole windows from the start of each text, then the rest."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()  # what earlier steps have freed, before the tokenizer takes its own
        words = encoder(tokenizer)
        for batch in slices(batches, "text", BATCH_BYTES):
            ids, first = with_end(*words.encode(batch.column("text")), end_id)
            sizes = np.diff(first)
            n = -(-sizes // window)
            doc = np.repeat(np.arange(len(sizes)), n)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * window
            length = np.minimum(sizes[doc] - start, window)
            raw = ids.astype("<u4").tobytes()
            begin = ((first[doc] + start) * 4).tolist()
            end = ((first[doc] + start + length) * 4).tolist()
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(begin, end, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()).take(pa.array(doc)),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int32()),
                    pa.array(sums, pa.int64()),
                    pa.array(sizes[doc], pa.int64()),
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(pieces, PIECE)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece.

    Pieces are ranked within ``SALTS`` parts of each length, so a length that a third of all texts share is spread
    over tasks. The plan and the offsets of the parts have ``window * SALTS`` rows at most, and are broadcast. Only
    rows of pieces are shuffled, no ids.
    """
    spark = docs.sparkSession
    stash = Stash(spark)
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS)).cast("int")
    pieces = stash.keep(cut(docs, tokenizer, window, end_id).withColumn("_salt", salt), "pieces")
    parts = pieces.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")
    parts = stash.keep(parts.select("length", "_salt", "_n", before.alias("_before")), "parts")
    histogram = {row["length"]: row["n"] for row in parts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = spark.createDataFrame(
        plan(histogram, window), "_length int, _from long, _to long, _per long, _sequence long, _offset long"
    )
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        pieces.withColumn("_at", F.row_number().over(order) - 1)
        .join(F.broadcast(parts.drop("_n")), ["length", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_at"))
    )
    here = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    nth = F.col("_rank") - F.col("_from")
    return ranked.join(F.broadcast(runs), here).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("_sequence") + F.expr("(_rank - _from) div _per")).alias("sequence_id"),
        (F.col("_offset") + F.pmod(nth, F.col("_per")) * F.col("length")).alias("offset"),
    )
