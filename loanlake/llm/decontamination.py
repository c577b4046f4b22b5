"""Benchmark decontamination by greedy string tiling.

Texts that share word 5-grams with a benchmark item are the candidates. For each, running Karp-Rabin finds the
longest matches of unmarked words, marks them as tiles, and repeats with shorter ones, so that passages in another
order are covered as well. A text is contaminated by an item if its tiles cover enough of the item's words.

Defined cases: a NULL or empty text, or one with fewer words than a seed, matches nothing; an item with fewer words
than a seed is compared as one seed of all its words. Repeated texts and items each get rows. NULL ids are kept as
they are. Extra columns are ignored. Empty tables give no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.llm.stash import Stash
from loanlake.llm.words import SHINGLE, shingles, slices, split_words

#: Items are read in blocks of at most so many bytes of text; each block is sent to all executors and meets all texts.
BLOCK_BYTES = 8_000_000
#: Contaminated texts are broadcast up to this count; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER = 1 << 20
FOUND = "doc_id long, item_id long, item_words long, covered_words long, n_tiles long, longest_tile long"


def _powers(n: int) -> np.ndarray:
    steps = np.full(n + 1, _BASE)
    steps[0] = 1
    return np.cumprod(steps)


def _prefix(words: np.ndarray) -> np.ndarray:
    """Karp-Rabin prefix sums: the hash of a run is a difference of two entries, scaled to a common power."""
    return np.concatenate([[np.uint64(0)], np.cumsum(words * _powers(len(words))[:-1])])


def _run_hashes(prefix: np.ndarray, starts: np.ndarray, size: int, powers: np.ndarray) -> np.ndarray:
    return (prefix[starts + size] - prefix[starts]) * powers[len(powers) - 1 - starts]


def _open_starts(marked: np.ndarray, size: int) -> np.ndarray:
    """Where runs of so many unmarked words start."""
    if len(marked) < size:
        return np.zeros(0, np.int64)
    ahead = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(ahead[size:] == ahead[: len(marked) - size + 1])


def _matches(
    item: np.ndarray, text: np.ndarray, in_item: np.ndarray, in_text: np.ndarray, size: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Each start of unmarked words of the item, with all starts of unmarked words of the text that hash alike."""
    powers = _powers(max(len(item), len(text)))
    own, other = _open_starts(in_item, size), _open_starts(in_text, size)
    left = _run_hashes(_prefix(item), own, size, powers)
    right = _run_hashes(_prefix(text), other, size, powers)
    order = np.argsort(right, kind="stable")
    begin = np.searchsorted(right[order], left, side="left")
    end = np.searchsorted(right[order], left, side="right")
    for i in np.flatnonzero(end > begin):
        yield int(own[i]), other[order[begin[i] : end[i]]]


def _first_equal(item: np.ndarray, text: np.ndarray, i: int, starts: np.ndarray, size: int) -> int | None:
    """The first of the starts whose words are those of the item; hashes alone are not trusted."""
    return next((int(j) for j in starts if np.array_equal(item[i : i + size], text[j : j + size])), None)


def tiles(item: np.ndarray, text: np.ndarray, least: int = SHINGLE) -> list[tuple[int, int, int]]:
    """Greedy string tiling: ``(item_start, text_start, words)`` of tiles, the longest first.

    Both are word hashes. Halving finds the longest size at which unmarked words still match; matches of that size
    are marked in order of position, and the search goes on below. A start of the item takes the first place in the
    text that is still free.
    """
    in_item, in_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    found, most = [], min(len(item), len(text))

    def any_match(size: int) -> bool:
        matches = _matches(item, text, in_item, in_text, size)
        return any(_first_equal(item, text, i, starts, size) is not None for i, starts in matches)

    while most >= least:
        low, high = least - 1, most
        while low < high:
            middle = (low + high + 1) // 2
            if any_match(middle):
                low = middle
            else:
                high = middle - 1
        if low < least:
            break
        for i, starts in _matches(item, text, in_item, in_text, low):
            if in_item[i : i + low].any():
                continue
            ahead = np.concatenate([[0], np.cumsum(in_text)])
            j = _first_equal(item, text, i, starts[ahead[starts + low] == ahead[starts]], low)
            if j is not None:
                in_item[i : i + low] = in_text[j : j + low] = True
                found.append((i, j, low))
        most = low if any_match(low) else low - 1
    return found


@dataclass
class Items:
    """A block of benchmark items with the index of their seeds."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    bitmap: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list) -> "Items":
        found = split_words(pa.array(texts, pa.large_string()))
        words = [found.hashes[a:b] for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
        own = [np.unique(shingles(w, min(SHINGLE, len(w)))) if len(w) else np.zeros(0, np.uint64) for w in words]
        seeds = np.concatenate([*own, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(own)), [len(x) for x in own])
        order = np.argsort(seeds, kind="stable")
        bitmap = np.zeros(_FILTER, bool)
        bitmap[seeds % np.uint64(_FILTER)] = True
        return cls(ids, words, seeds[order], item[order], bitmap)

    def short_sizes(self) -> list[int]:
        return sorted({len(w) for w in self.words if 0 < len(w) < SHINGLE})

    def met(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of ``hashes`` that are seeds, with the item, a row for each item that has the seed."""
        maybe = np.flatnonzero(self.bitmap[hashes % np.uint64(_FILTER)])
        begin = np.searchsorted(self.seeds, hashes[maybe], side="left")
        n = np.searchsorted(self.seeds, hashes[maybe], side="right") - begin
        at = np.repeat(maybe, n)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        return at, self.item[np.repeat(begin, n) + nth]


def _tiled(batch: pa.RecordBatch, items: Items, least_cover: float) -> Iterator[tuple]:
    words = split_words(batch.column("text"))
    sizes = np.diff(words.first)
    pairs = set()
    for size in [SHINGLE, *items.short_sizes()]:
        at, item = items.met(shingles(words.hashes, size))
        doc = np.searchsorted(words.first, at, side="right") - 1
        inside = at + size <= words.first[doc + 1]
        pairs |= set(zip(doc[inside].tolist(), item[inside].tolist(), strict=True))
    ids = batch.column("doc_id").to_pylist()
    for doc, i in sorted(pairs):
        item, begin = items.words[i], words.first[doc]
        text = words.hashes[begin : begin + sizes[doc]]
        least = min(SHINGLE, len(item))
        # No tile covers a word that no shared seed covers, which spares texts that share a phrase by chance.
        shared = np.flatnonzero(np.isin(shingles(item, least), shingles(text, least)))
        if len(np.unique(shared[:, None] + np.arange(least))) < least_cover * len(item):
            continue
        found = tiles(item, text, least)
        covered = sum(n for _, _, n in found)
        if covered >= least_cover * len(item):
            yield ids[doc], items.ids[i], len(item), covered, len(found), max(n for _, _, n in found)


def _blocks(benchmark: DataFrame, most_bytes: int) -> list[DataFrame]:
    """The items, of different texts, in blocks of about so many bytes, by a hash of their key."""
    size = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = -(-size // most_bytes)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(1, n)))
    return [benchmark.where(block == i) for i in range(n)]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, min_cover: float = 0.5, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """A row per text and item whose tiles of five words or more cover at least ``min_cover`` of the item's words.

    Texts are not shuffled. The items travel to the executors in blocks of a bounded size, one pass over the texts
    per block; however large the benchmark, all items meet all texts. Items with the same text travel once, as their
    key, and get their rows by a join with what was found.
    """
    spark = docs.sparkSession
    stash = Stash(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    wanted = wanted.withColumn("key", F.xxhash64("text"))
    different = wanted.groupBy("key").agg(F.min("text").alias("text")).withColumnRenamed("key", "item_id")
    different = stash.keep(different, "items")
    found = None
    for block in _blocks(different, block_bytes):
        rows = block.collect()  # at most about block_bytes
        items = spark.sparkContext.broadcast(Items.of([r["item_id"] for r in rows], [r["text"] for r in rows]))

        def tile(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                rows = list(_tiled(batch, items.value, min_cover))
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                names = ["doc_id", "item_id", "item_words", "covered_words", "n_tiles", "longest_tile"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        part = stash.keep(texts.mapInArrow(tile, FOUND), "tiled")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    names = found.columns
    found = found.withColumnRenamed("item_id", "key").join(wanted.select("key", "item_id"), "key").select(*names)
    return found.withColumn("coverage", F.col("covered_words") / F.col("item_words"))


def without_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that an item of the benchmark contaminates, found again by a hash of the text."""
    marked = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    out = find_contamination(marked, benchmark).select(F.col("doc_id").alias("_hash")).distinct()
    few = out.count() <= BROADCAST_ROWS
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("text_hash"))
    same = F.col("text_hash") == F.col("_hash")
    return rows.join(F.broadcast(out) if few else out, same, "left_anti").select("row.*")
