"""N-gram Jaccard join with Bayesian pruning of candidates.

Texts are sets of word 5-grams. MinHash bands that agree make texts candidates; the values of candidate pairs are then
compared some at a time, and a pair is dropped as soon as the probability, given the agreement so far, that its
similarity reaches the threshold falls below a tolerance. The pairs that are left are verified on the whole sets.

How groups stay bounded: texts with equal sets are one class from the start. Candidate buckets give a link from each
class to the bucket's least class, never all pairs, and the connected components of these links hold every candidate
pair. A component's classes are dealt into blocks of about ``BLOCK``, and a task compares two blocks with each other.
What leaves a task is a count per class and a spanning forest of the links it found, so output grows with the number
of classes, not with the number of pairs.

Two sets with a similarity of 0.8 share no band with a probability of ``(1 - 0.8 ** 4) ** 24``, or 3 in a million.

Defined cases: a text with fewer than five words, but some, is one shingle of all its words. NULL and empty texts, and
texts whose id is NULL, link to nothing and are classes of their own. Repeated rows are copies and link to each other.
Extra columns are ignored. An empty table gives no rows.
"""

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.llm.components import connected_components
from loanlake.llm.groups import whole_groups
from loanlake.llm.stash import Stash
from loanlake.llm.words import mix, slices, split_words, text_shingles

BANDS, ROWS = 24, 4
VALUES = BANDS * ROWS
STEP = 16
BLOCK = 512
#: Ids of candidate texts are broadcast up to this count; beyond it they are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_A = mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_B = mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def minhash(shingles: np.ndarray) -> np.ndarray:
    """``VALUES`` 32-bit values of a set that isn't empty."""
    least = np.full(VALUES, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[None, at : at + 2048] * _A[:, None]
        part += _B[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(values: np.ndarray) -> np.ndarray:
    """A hash of each band's number and values."""
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in values.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys.view(np.int64)


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that tell a sorted set from any other."""
    one = mix(shingles + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
    other = mix(shingles ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    return mix(np.array([one, other ^ np.uint64(len(shingles))], np.uint64)).tobytes()


def fewest_agreeing(threshold: float, tolerance: float) -> dict[int, int]:
    """For each number of compared values, the fewest that must agree.

    With a uniform prior, the probability that the similarity reaches ``threshold`` after ``m`` of ``n`` values agreed
    is that of at most ``m`` successes in ``n + 1`` trials that succeed with ``threshold``.
    """
    least = {}
    for n in range(STEP, VALUES + 1, STEP):
        below = 0.0
        for m in range(n + 1):
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                least[n] = m
                break
    return least


def _sets(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    return map(np.unique, text_shingles(split_words(batch.column("text"))))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, set_key, signature, bands``; the last three are NULL for texts without words or id."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            no_id = batch.column("doc_id").is_null().to_pylist()
            keys, values, bands = [], [], []
            for skip, found in zip(no_id, _sets(batch), strict=True):
                if skip or not len(found):
                    keys.append(None), values.append(None), bands.append(None)
                    continue
                own = minhash(found)
                keys.append(set_key(found)), values.append(own.tobytes()), bands.append(band_keys(own))
            arrays = [pa.array(keys, pa.binary()), pa.array(values, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            own = [batch.column(c) for c in ("doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays([*own, *arrays], ["doc_id", "text_hash", "set_key", "signature", "bands"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(sign, "doc_id long, text_hash long, set_key binary, signature binary, bands array<long>")


def _shingle_sets(docs: DataFrame) -> DataFrame:
    """``set_key, shingles`` of every text with words, the set as sorted 64-bit numbers."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [x for x in _sets(batch) if len(x)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary())],
                ["set_key", "shingles"],
            )

    return docs.select("text").mapInArrow(sets, "set_key binary, shingles binary")


def _shared(a: list[np.ndarray], b: list[np.ndarray], pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How many shingles the sets of each pair share: by products of 0/1 matrices, or pair by pair if that is less."""
    one, other = pairs
    mean = (sum(map(len, a)) + sum(map(len, b))) / (len(a) + len(b))
    codes, at = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    twice = np.bincount(at, minlength=len(codes)) > 1
    column = np.cumsum(twice) - 1
    n = int(twice.sum())
    if len(one) * mean * 6e-8 < len(a) * len(b) * n * 1e-10:
        return np.array([len(np.intersect1d(a[i], b[j], assume_unique=True)) for i, j in zip(one, other, strict=True)])
    row = np.repeat(np.arange(len(a) + len(b)), [len(x) for x in [*a, *b]])
    row, column = row[twice[at]], column[at[twice[at]]]
    shared = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for begin in range(0, n, 4096):
        part = slice(*np.searchsorted(column, [begin, begin + 4096]))
        held = np.zeros((len(a) + len(b), min(4096, n - begin)), np.float32)
        held[row[part], column[part] - begin] = 1
        shared += held[: len(a)] @ held[len(a) :].T
    return shared[one, other].astype(np.int64)


def _similar(
    values: tuple[np.ndarray, np.ndarray],
    sets: tuple[list[np.ndarray], list[np.ndarray]],
    same: bool,
    threshold: float,
    least: dict[int, int],
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of one block's classes with another's, or its own, that reach the threshold."""
    a, b = values
    agree = np.zeros((len(a), len(b)), np.int16)
    for k in range(STEP):
        agree += a[:, k, None] == b[None, :, k]
    may = agree >= least[STEP]
    if same:
        may = np.triu(may, 1)
    one, other = np.nonzero(may)
    counts = agree[one, other]
    for n in range(2 * STEP, VALUES + 1, STEP):
        counts = counts + (a[one, n - STEP : n] == b[other, n - STEP : n]).sum(axis=1, dtype=np.int16)
        stay = counts >= least[n]
        one, other, counts = one[stay], other[stay], counts[stay]
    if not len(one):
        return one, other
    own, theirs = (np.array([len(x) for x in s]) for s in sets)
    shared = _shared(*sets, (one, other))
    union = own[one] + theirs[other] - shared
    stay = shared >= threshold * union - 1e-9
    return one[stay], other[stay]


def _forest(n: int, one: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the same nodes as all of them, without circles."""
    parent, kept = list(range(n)), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(one.tolist(), other.tolist(), strict=True):
        a, b = root(x), root(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append((x, y))
    return kept


def _compare(threshold: float, tolerance: float):
    least = fewest_agreeing(threshold, tolerance)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group is two blocks of a component, or one with itself; gives link counts and a forest."""
        for table, starts in whole_groups(batches, ["component", "x", "y"], at_least=2 * BLOCK):
            out: tuple[list, list, list] = ([], [], [])
            columns = {c: table.column(c).combine_chunks() for c in ("set_key", "block", "x", "y", "copies")}
            key = columns["set_key"].to_pylist()
            block, x, y, copies = (columns[c].to_numpy() for c in ("block", "x", "y", "copies"))
            signature, shingles = table.column("signature").to_pylist(), table.column("shingles").to_pylist()
            for begin, end in zip(starts[:-1], starts[1:], strict=True):
                rows = np.arange(begin, end)
                same = x[begin] == y[begin]
                left = rows[block[rows] == x[begin]]
                right = left if same else rows[block[rows] == y[begin]]
                if not len(left) or not len(right):
                    continue
                own, theirs = ([np.frombuffer(shingles[r], np.uint64) for r in side] for side in (left, right))
                a, b = (
                    np.frombuffer(b"".join(signature[r] for r in side), np.uint32).reshape(-1, VALUES)
                    for side in (left, right)
                )
                one, other = _similar((a, b), (own, theirs), same, threshold, least)
                one, other = left[one] - begin, right[other] - begin
                links = np.zeros(end - begin, np.int64)
                np.add.at(links, one, copies[begin + other])
                np.add.at(links, other, copies[begin + one])
                linked = np.flatnonzero(links)
                out[0].extend(key[begin + i] for i in linked)
                out[1].extend([None] * len(linked))
                out[2].extend(links[linked].tolist())
                for i, j in _forest(end - begin, one, other):
                    out[0].append(key[begin + i]), out[1].append(key[begin + j]), out[2].append(0)
            kinds = [pa.binary(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(o, kind) for o, kind in zip(out, kinds, strict=True)], ["a", "b", "links"]
            )

    return compare


def link_documents(docs: DataFrame, threshold: float = 0.8, tolerance: float = 1e-6) -> DataFrame:
    """``doc_id, text_hash, class_id, copy_id, n_links`` of every row.

    Documents link if the similarity of their sets reaches ``threshold``. ``n_links`` counts the other documents a
    document links to, ``class_id`` is the least id of those connected to it by links, and ``copy_id`` the least id of
    those with an equal set. Links within the classes of equal sets need no comparison; a link between classes counts
    for all documents of both.
    """
    return _linked(docs, threshold, tolerance).drop("component")


def _linked(docs: DataFrame, threshold: float, tolerance: float = 1e-6) -> DataFrame:
    """``link_documents`` with ``component``, which tells classes with the same least id apart; NULL without words or id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    stash = Stash(docs.sparkSession)
    signed = stash.keep(signatures(docs), "signed")
    classes = stash.keep(
        signed.where("set_key IS NOT NULL").groupBy("set_key").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("copy_id"),
            F.first("signature").alias("signature"), F.first("bands").alias("bands"),
        ),
        "classes",
    )
    banded = classes.select("set_key", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), F.min("set_key").alias("b")).where("n > 1")
    buckets = stash.keep(buckets.select("band", "b"), "buckets")
    stars = banded.join(buckets, "band").select(F.col("set_key").alias("a"), "b")
    candidates = connected_components(stars, stash)
    sizes = candidates.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sizes = stash.keep(sizes, "sizes")
    placed = candidates.join(sizes, "component").select(
        F.col("node").alias("set_key"), "component", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
    )
    members = stash.keep(
        placed.join(classes.drop("bands"), "set_key"), "members"
    )
    ids = members.select(F.col("copy_id").alias("_id")).distinct()
    few = members.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("_id"), "left_semi")
    sets = _shingle_sets(texts).groupBy("set_key").agg(F.first("shingles").alias("shingles"))
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    paired = members.join(sets, "set_key").select(
        "component", "set_key", "block", "copies", "signature", "shingles", meets
    ).select("*", F.least("block", "with").alias("x"), F.greatest("block", "with").alias("y")).drop("with")
    group = ["component", "x", "y"]
    compared = stash.keep(
        paired.repartition(*group).sortWithinPartitions(*group)
        .mapInArrow(_compare(threshold, tolerance), "a binary, b binary, links long"),
        "compared",
    )
    found = connected_components(compared.where("b IS NOT NULL").select("a", "b"), stash)
    links = compared.where("b IS NULL").groupBy(F.col("a").alias("set_key")).agg(F.sum("links").alias("links"))
    labelled = classes.select("set_key", "copies", "copy_id").join(
        found.withColumnRenamed("node", "set_key"), "set_key", "left"
    ).withColumn("component", F.coalesce("component", "set_key"))
    names = labelled.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    answers = stash.keep(
        labelled.join(stash.keep(names, "names"), "component").join(links, "set_key", "left").select(
            "set_key", "component", "class_id", "copy_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        "answers",
    )
    stash.keep_only(signed, answers)
    return signed.select("doc_id", "text_hash", "set_key").join(answers, "set_key", "left").select(
        "doc_id", "text_hash", "component", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("copy_id", "doc_id").alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def keep_one_of_each_class(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one row of each class: of the texts with the least id that with the least hash, once.

    Rows without words stay. Rows without an id are classed like all others, as if they had the largest id.
    """
    stash = Stash(docs.sparkSession)
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc_id")
    texts = _linked(docs.select(number, "text"), threshold).where("component IS NOT NULL").groupBy("component", "doc_id", "text_hash")
    texts = stash.keep(texts.agg(F.count("*").alias("n")), "texts")
    one = texts.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
    judged = texts.join(one, "component").withColumn("stays", F.struct("doc_id", "text_hash") == F.col("one"))
    drop = judged.where("NOT stays OR n > 1").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "stays"
    )
    drop = stash.keep(drop, "dropped")
    rows = docs.select(F.struct("*").alias("row"), number, F.xxhash64("text").alias("text_hash"))

    def matched(keys: DataFrame, how: str) -> DataFrame:
        same = (F.col("doc_id") == F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        few = keys.count() <= BROADCAST_IDS
        return rows.join(F.broadcast(keys) if few else keys, same, how)

    kept = matched(drop, "left_anti").select("row.*")
    again = drop.where("stays")
    if again.isEmpty():
        return kept
    # Equal rows are brought to one within each task before they are dealt by key.
    once = matched(again, "left_semi").groupBy("doc_id", "text_hash").agg(F.first("row").alias("row"))
    return kept.unionAll(once.select("row.*"))
