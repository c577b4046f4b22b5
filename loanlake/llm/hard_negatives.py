"""Hard negatives of anchors: rows of another label that score somewhat below a row of the same label.

Components are rounded down to whole 256ths, so scores are whole numbers. Anchors, a fixed share of the rows, are
searched against all rows in tiles of a chunk of anchors and a block of candidates. The anchors of a chunk form a minimum
spanning tree: the root's scores are computed, and along an edge to a child a candidate's score changes by no more than
the length of the edge times the candidate's norm. Bounds are handed down the tree, and only candidates whose bounds
reach into a window that is still open are scored again; for these the bounds of the anchor's own children start afresh.

The first search has one window per anchor, from its fifth best row of the same label so far upwards. The second has one
per anchor and positive, from half of the positive's score (or the third best negative so far) to 95 % of it. Tiles give
their best rows, and Spark ranks those of all tiles, limiting them before the shuffle. Trees and bounds decide what is
scored, never what is found: results are those of scoring everything.

Of equal vectors with the same label only the first ``KEPT`` can be in any result, ties going to the smaller id; the
others are left out before the search, so one vector that a third of all rows share is a few rows. Chunks are sent to
executors if there are no more than ``BROADCAST_ANCHORS`` anchors; beyond that, tiles are made by a join of blocks and
chunks. Labels lie together in chunks, in which neighbours tend to be alike.

Defined cases: rows without id, label or vector, or with a NULL or non-finite component, take no part. Vectors of
different length count as ended by zeros. Repeated rows are rows of their own: each gives results, and each can be in
the results of the other. Scores beyond 63 bits are an error. Extra columns are ignored; an empty table gives no rows.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlake.llm.stash import Stash

POSITIVES = 5
NEGATIVES = 3
#: Of equal vectors of a label: an anchor itself and ``POSITIVES`` others.
KEPT = POSITIVES + 1
#: Anchors of a chunk, about; a task holds bounds of a block for each.
CHUNK = 512
#: Candidates of a block, and of the partitions that blocks are read from.
BLOCK = 8192
PARTITION = 65_536
#: Anchors that are sent to every executor, half a kilobyte each; more are joined.
BROADCAST_ANCHORS = 50_000

_ROW = "key long, vec_id long, label long, v array<long>"
_TREE = "chunk long, keys array<long>, labels array<long>, parents array<int>, edges array<double>, sizes array<int>, values array<long>, wanted array<array<long>>"
_BLOCK = "part long, ids array<long>, keys array<long>, labels array<long>, firsts array<boolean>, sizes array<int>, values array<long>"
_FOUND = "key long, nth int, score long, vec_id long"


def relabelled(every: int = 7, labels: int = 10) -> Column:
    label = F.col("label").cast("long")
    return F.when(F.col("vec_id") % every == 0, (label + 1) % labels).otherwise(label)


def usable_rows(embeddings: DataFrame, label: Column) -> DataFrame:
    """``key, vec_id, label, v`` of the rows that take part; ``key`` is the hash of the other three."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("v"))
    return rows.select(F.xxhash64("vec_id", "label", "v").alias("key"), "*")


def candidates(rows: DataFrame) -> DataFrame:
    """The first ``KEPT`` rows of each label and vector; ``first`` tells the first of repeated rows."""
    same = Window.partitionBy("label", "v").orderBy("vec_id")
    kept = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= KEPT)
    before = F.lag("vec_id").over(same)
    return kept.withColumn("first", before.isNull() | (before != F.col("vec_id"))).drop("nth")


def _matrix(sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Vectors as rows, ended by zeros."""
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)


@dataclass
class Tree:
    """Anchors from the root down, each after its parent, which is 0 and at distance 0 for the root."""

    keys: np.ndarray
    labels: np.ndarray
    parents: np.ndarray
    edges: np.ndarray
    vectors: np.ndarray
    wanted: list[list[int]]


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order in which vectors join the minimum spanning tree of the first one, their parents as places in that
    order, and the lengths of the edges, rounded up."""
    n = len(vectors)
    x = vectors.astype(np.float64)
    square = (x**2).sum(axis=1)
    order, parents, edges = np.zeros(n, int), np.zeros(n, int), np.zeros(n)
    near, link, outside = np.full(n, np.inf), np.zeros(n, int), np.ones(n, bool)
    at = 0
    for place in range(n):
        if place:
            at = int(np.argmin(np.where(outside, near, np.inf)))
            parents[place] = link[at]
            edges[place] = np.sqrt(((x[at] - x[order[link[at]]]) ** 2).sum()) * (1 + 1e-9)
        order[place], outside[at] = at, False
        far = square + square[at] - 2 * (x @ x[at])
        closer = outside & (far < near)
        near[closer], link[closer] = far[closer], place
    return order, parents, edges


def _as_lists(arrays: list[np.ndarray]) -> list[pa.Array]:
    """Each array as a list that is the only row of its column."""
    return [pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), pa.array(a)) for a in arrays]


def trees(anchors: DataFrame, n: int) -> DataFrame:
    """Anchors with their ``wanted`` scores, a row per chunk."""

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if not own:
            return
        table = pa.Table.from_batches(own).combine_chunks()
        lists = table["v"].combine_chunks()
        vectors = _matrix(lists.value_lengths().to_numpy(), lists.flatten().to_numpy())
        order, parents, edges = spanning_tree(vectors)
        placed = table.take(pa.array(order))
        flat = vectors[order].ravel()
        wanted = pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), placed["wanted"].combine_chunks())
        yield pa.RecordBatch.from_arrays(
            [
                table["part"].combine_chunks()[:1],
                *_as_lists([placed["key"].to_numpy(), placed["label"].to_numpy(), parents.astype(np.int32), edges,
                            np.full(len(order), vectors.shape[1], np.int32), flat]),
                wanted,
            ],
            [c.split()[0] for c in _TREE.split(", ")],
        )

    parts = anchors.repartitionByRange(-(-n // CHUNK), "label", "key")
    parts = parts.withColumn("part", F.spark_partition_id().cast("long"))
    return parts.select("part", "key", "label", "v", "wanted").mapInArrow(build, _TREE)


def _tree(row: dict) -> Tree:
    vectors = _matrix(np.array(row["sizes"], np.int64), np.array(row["values"], np.int64))
    arrays = [np.array(row[c]) for c in ("keys", "labels", "parents", "edges")]
    return Tree(*arrays, vectors, [list(w) for w in row["wanted"]])


@dataclass
class Block:
    ids: np.ndarray
    keys: np.ndarray
    labels: np.ndarray
    firsts: np.ndarray
    vectors: np.ndarray

    def __post_init__(self):
        self.norms = _norms(self.vectors)
        self.most = int(np.abs(self.vectors).max(initial=0))
        self.quick = self.vectors.astype(np.float64)

    def scores(self, vector: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Whole-number inner products with the candidates at the given places, or all."""
        width = min(len(vector), self.vectors.shape[1])
        most = width * self.most * int(np.abs(vector).max(initial=0))
        if most >= 2**63:
            raise ValueError("scores beyond 63 bits")
        # Sums of products below 2**53 are exact in floats too, which multiply faster.
        x = self.quick if most < 2**53 else self.vectors
        x = x[:, :width] if at is None else x[at, :width]
        return (x @ vector[:width].astype(x.dtype)).astype(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` highest scores, ties by smaller id."""
    if len(scores) > 4 * n:
        enough = scores >= np.partition(scores, -n)[-n]
        scores, ids = scores[enough], ids[enough]
    order = np.lexsort((ids, -scores))[:n]
    return scores[order], ids[order]


class _Window:
    """The best rows with scores from ``low`` to ``high`` so far."""

    def __init__(self, size: int, low: int | None = None, high: int | None = None):
        self.size, self.low, self.high = size, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def opens_at(self) -> float:
        """Scores below this can be in no result any more."""
        worst = self.scores[-1] if len(self.scores) == self.size else None
        return max(float("-inf") if x is None else x for x in (worst, self.low))

    def meets(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        inside = most >= self.opens_at()
        return inside if self.high is None else inside & (least <= self.high)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        inside = self.meets(scores, scores)
        if inside.any():
            both = np.concatenate([self.scores, scores[inside]]), np.concatenate([self.ids, ids[inside]])
            self.scores, self.ids = _first(*both, self.size)


class Search:
    """The windows of a tree's anchors, which blocks are searched for one after the other."""

    def __init__(self, tree: Tree, same_label: bool):
        self._tree, self._same = tree, same_label
        self.scored = 0  # pairs of which the score was computed
        self.windows = [
            [_Window(POSITIVES)] if same_label else [_Window(NEGATIVES, -(-w // 2), 95 * w // 100) for w in wanted]
            for wanted in tree.wanted
        ]

    def look_at(self, block: Block) -> None:
        tree = self._tree
        bounds: list[tuple[np.ndarray, np.ndarray] | None] = []
        last_child = np.arange(len(tree.keys))
        np.maximum.at(last_child, tree.parents, np.arange(len(tree.keys)))
        everything = np.arange(len(block.ids))
        for i, vector in enumerate(tree.vectors):
            if i == 0:
                exact, at = block.scores(vector), everything
                least = most = exact.astype(np.float64)
            else:
                parent, reach = bounds[tree.parents[i]], tree.edges[i] * block.norms
                slack = 1e-9 * (np.abs(parent[0]) + np.abs(parent[1])) + 1e-6
                least, most = parent[0] - reach - slack, parent[1] + reach + slack
                may = np.zeros(len(least), bool)
                for window in self.windows[i]:
                    may |= window.meets(least, most)
                may &= (block.labels == tree.labels[i]) == self._same
                at = np.flatnonzero(may)
                exact = block.scores(vector, at)
                least[at] = most[at] = exact
            self.scored += len(at)
            bounds.append((least, most))
            # Bounds are given up once the last child has them.
            for done in {i, int(tree.parents[i])}:
                if last_child[done] <= i:
                    bounds[done] = None
            own = (block.labels[at] == tree.labels[i]) == self._same
            if self._same:
                own &= ~((block.keys[at] == tree.keys[i]) & block.firsts[at])
            scores, ids = exact[own], block.ids[at[own]]
            for window in self.windows[i]:
                window.add(scores, ids)

    def found(self) -> pa.RecordBatch:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 4]
        for key, windows in zip(self._tree.keys, self.windows, strict=True):
            for nth, w in enumerate(windows, 1):
                n = len(w.ids)
                out.append([np.full(n, key, np.int64), np.full(n, nth, np.int64), w.scores, w.ids])
        key, nth, score, ids = (np.concatenate(x) for x in zip(*out, strict=True))
        names = [c.split()[0] for c in _FOUND.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, nth.astype(np.int32), score, ids)], names)


def _block(batch: pa.RecordBatch) -> Block:
    lists = batch.column("v")
    vectors = _matrix(lists.value_lengths().to_numpy(), lists.flatten().to_numpy())
    arrays = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "key", "label", "first")]
    return Block(*arrays, vectors)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK):
            yield batch.slice(begin, BLOCK)


def _by_broadcast(chunks: DataFrame, rows: DataFrame, same_label: bool) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(chunks.toArrow().to_pylist())

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(_tree(row), same_label) for row in sent.value]
        for batch in _pieces(batches):
            block = _block(batch)
            for one in searches:
                one.look_at(block)
        for one in searches:
            yield one.found()

    return rows.mapInArrow(search, _FOUND)


def _by_tiles(chunks: DataFrame, rows: DataFrame, same_label: bool, stash: Stash) -> DataFrame:
    """Every block next to every chunk. A tile is a partition's blocks and a chunk; both are copied to their tiles."""
    n_parts, n_chunks = rows.rdd.getNumPartitions(), chunks.agg(F.max("chunk")).first()[0] + 1

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            lists = batch.column("v")
            arrays = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "key", "label", "first")]
            columns = _as_lists([*arrays, lists.value_lengths().to_numpy(), lists.flatten().to_numpy()])
            yield pa.RecordBatch.from_arrays([batch.column("part")[:1], *columns], [c.split()[0] for c in _BLOCK.split(", ")])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(batch.num_rows):
                row = batch.slice(begin, 1).to_pylist()[0]
                tree = _tree({k.removeprefix("t_"): x for k, x in row.items() if k.startswith("t_")})
                vectors = _matrix(np.array(row["sizes"], np.int64), np.array(row["values"], np.int64))
                one = Search(tree, same_label)
                one.look_at(Block(*[np.array(row[c]) for c in ("ids", "keys", "labels", "firsts")], vectors))
                yield one.found()

    numbered = rows.withColumn("part", F.spark_partition_id().cast("long"))
    blocks = stash.keep(numbered.mapInArrow(pack, _BLOCK), "blocks")
    blocks = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)).cast("array<long>")))
    chunks = chunks.select(*[F.col(c).alias(c if c == "chunk" else f"t_{c}") for c in chunks.columns])
    chunks = chunks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)).cast("array<long>")))
    return blocks.join(chunks, ["part", "chunk"]).mapInArrow(search, _FOUND)


def mine_hard_negatives(
    embeddings: DataFrame, label: Column | None = None, anchor_every: int = 50, broadcast_anchors: int = BROADCAST_ANCHORS
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    stash = Stash(embeddings.sparkSession)
    rows = usable_rows(embeddings, relabelled() if label is None else label)
    anchors = rows.where(F.col("vec_id") % anchor_every == 0).groupBy("key", "vec_id", "label", "v")
    anchors = stash.keep(anchors.agg(F.count("*").alias("copies")), "anchors")
    n = anchors.count()
    few = stash.keep(candidates(rows), "few")
    few = stash.keep(few.repartition(max(1, -(-few.count() // PARTITION)), F.xxhash64("v")), "candidates")

    def search(wanted: DataFrame, same_label: bool, most: int) -> DataFrame:
        chunks = stash.keep(trees(wanted, max(1, n)), "chunks")
        few_anchors = n <= broadcast_anchors or chunks.isEmpty()
        found = _by_broadcast(chunks, few, same_label) if few_anchors else _by_tiles(chunks, few, same_label, stash)
        best = Window.partitionBy("key", "nth").orderBy(F.desc("score"), "vec_id")
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most)
        return stash.keep(ranked, "found")

    nothing_wanted = anchors.withColumn("wanted", F.array().cast("array<long>"))
    positives = search(nothing_wanted, True, POSITIVES)
    scores = F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"])
    of_anchor = positives.groupBy("key").agg(scores.alias("wanted"))  # at most five scores each
    negatives = search(anchors.join(of_anchor, "key"), False, NEGATIVES)
    positives = positives.select("key", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    negatives = negatives.select("key", "nth", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = negatives.join(positives, ["key", "nth"]).join(anchors.select("key", F.col("vec_id").alias("anchor_id"), "copies"), "key")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
