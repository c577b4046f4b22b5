import math
import random

import numpy as np
import pytest

from loanlake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, v string, key string, n int, wanted string"


def brute(rows):
    """By the definition, every score computed."""
    good = []
    for vec_id, vector, label in rows:
        if None in (vec_id, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in vector]
        good.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, v))
    out = []
    for i, (anchor, label, v) in enumerate(good):
        if anchor % 50:
            continue
        ranked = sorted((-sum(a * b for a, b in zip(v, w)), j, l, k) for k, (j, l, w) in enumerate(good) if k != i)
        positives = [(j, -s) for s, j, l, _ in ranked if l == label][:5]
        for positive, ps in positives:
            fit = [(j, -s) for s, j, l, _ in ranked if l != label and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(anchor, positive, r, j, ps, s) for r, (j, s) in enumerate(fit, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y", 1, "z") for i, v, label in rows], SCHEMA)


def some(rng, n, dims=6, clusters=4):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(clusters)]
    return [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)], rng.randrange(3)) for i in range(n)]


def edge_rows():
    rng = random.Random(2)
    rows = some(rng, 400)
    same = [0.5, 0.25, -0.1, 1.0, 0.0, 0.3]
    rows += [(i, same, i % 3) for i in range(400, 700)]  # a vector that many share
    rows += [(350, same, 1), (350, same, 1), (350, [1.0] * 6, 1), (700, None, 1), (750, same, None), (None, same, 1),
             (800, [None, 1.0], 2), (850, [float("nan")] * 6, 1), (900, [float("inf")] * 6, 1), (950, [], 0),
             (1000, [1.0, 2.0], 1), (1050, [0.0] * 6, 2), (1051, [0.0] * 6, 2), (1052, [-0.001] * 6, 0), (-50, same, 2)]
    return rows


@pytest.mark.parametrize("most", [hn.BROADCAST_ANCHORS, 0])
def test_against_brute_force(spark, monkeypatch, most):
    for name, value in {"CHUNK": 6, "BLOCK": 90, "PARTITION": 200}.items():
        monkeypatch.setattr(hn, name, value)
    rows = edge_rows()
    found = hn.mine_hard_negatives(frame(spark, rows).repartition(5), broadcast_anchors=most)
    want = brute(rows)
    assert len(want) > 100 and sorted(map(tuple, found.collect())) == want
    assert dict(found.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint",
                                  "positive_score": "bigint", "negative_score": "bigint"}


def test_given_embeddings(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert sorted(map(tuple, hn.mine_hard_negatives(table).collect())) == brute(rows)


def test_empty_and_few(spark):
    assert hn.mine_hard_negatives(frame(spark, [])).count() == 0
    for rows in ([(50, [1.0], 1)], [(51, [1.0], 1), (52, [1.0], 2)], [(50, [1.0], 1), (51, [1.0], 2), (53, [2.0], 1)]):
        assert sorted(map(tuple, hn.mine_hard_negatives(frame(spark, rows)).collect())) == brute(rows)


def test_bounds_spare_scores():
    """Anchors that are alike share most of the work; what is found is the same."""
    rng = np.random.default_rng(4)
    x = rng.normal(0, 80, (3000, 16)).astype(np.int64)
    block = hn.Block(np.arange(3000), np.arange(3000), np.arange(3000) % 3, np.ones(3000, bool), x)
    vectors = (rng.normal(0, 80, 16) + rng.normal(0, 1, (40, 16))).astype(np.int64)
    order, parents, edges = hn.spanning_tree(vectors)
    tree = hn.Tree(np.arange(40) + 9000, np.zeros(40, int), parents, edges, vectors[order], [[]] * 40)
    search = hn.Search(tree, True)
    search.look_at(block)
    first = search.scored
    search.look_at(block)
    assert search.scored - first < 3000 + 39 * 100
    exact = x @ vectors[order].T
    for i, (window,) in enumerate(search.windows):
        best = sorted(((-s, j) for j, s in enumerate(exact[:, i].tolist()) if j % 3 == 0 for _ in "ab"))[:5]
        assert list(zip((-window.scores).tolist(), window.ids.tolist())) == best


def test_spanning_tree_is_least():
    rng = np.random.default_rng(6)
    x = rng.integers(-50, 50, (30, 5))
    order, parents, edges = hn.spanning_tree(x)
    assert sorted(order) == list(range(30)) and all(p < i for i, p in enumerate(parents) if i)
    pairs = sorted((float(np.linalg.norm(x[i] - x[j])), i, j) for i in range(30) for j in range(i))
    group, total = list(range(30)), 0.0
    for d, i, j in pairs:
        if group[i] != group[j]:
            total += d
            group = [group[j] if g == group[i] else g for g in group]
    assert edges.sum() == pytest.approx(total)


def test_scores_beyond_63_bits():
    block = hn.Block(*[np.zeros(1, np.int64)] * 4, np.full((1, 4), 2**40))
    assert block.scores(np.full(4, 2**20)).tolist() == [2**62]
    with pytest.raises(ValueError, match="63 bits"):
        block.scores(np.full(4, 2**22))
