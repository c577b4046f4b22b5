import random

import numpy as np
import pytest
from conftest_llm import by_id

from loanlake.llm import decontamination as dc

ITEM = "item_id long, text string, tokens string, doc_id string"


def brute_tiles(item, text, least=5):
    """Greedy string tiling by comparing every pair of places."""
    in_item, in_text, found = [False] * len(item), [False] * len(text), []
    while True:
        best = []
        longest = least - 1
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while (i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]
                       and not in_item[i + n] and not in_text[j + n]):
                    n += 1
                if n > longest:
                    longest, best = n, [(i, j)]
                elif n == longest and n >= least:
                    best.append((i, j))
        if not best:
            return found
        for i, j in best:
            if not any(in_item[i : i + longest]) and not any(in_text[j : j + longest]):
                in_item[i : i + longest] = [True] * longest
                in_text[j : j + longest] = [True] * longest
                found.append((i, j, longest))


@pytest.mark.parametrize("seed", range(25))
def test_tiles(seed):
    rng = random.Random(seed)
    item = [rng.randrange(6) for _ in range(rng.randrange(5, 30))]
    text = [rng.randrange(6) for _ in range(rng.randrange(0, 80))]
    for _ in range(3):
        a = rng.randrange(len(item))
        at = rng.randrange(len(text) + 1)
        text[at:at] = item[a : a + rng.randrange(4, 14)]
    found = dc.tiles(np.array(item, np.uint64), np.array(text, np.uint64))
    assert sorted(found) == sorted(brute_tiles(item, text))


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], ITEM)


def test_reordered_passages_and_edges(spark, make, edges):
    rng = random.Random(5)
    passage = [f"w{rng.randrange(10**6)}" for _ in range(40)]
    swapped = passage[20:] + ["between"] + passage[:20]
    noise = [f"n{rng.randrange(10**6)}" for _ in range(500)]
    docs = make([
        (1, " ".join(noise[:200] + swapped + noise[200:])), (2, " ".join(noise)), (3, " ".join(passage[:12])),
        (4, " ".join(passage).upper()), (4, " ".join(passage)), (None, " ".join(passage)), (5, None), (6, ""),
        (7, "only three words here"), (8, "only three words"),
    ])
    bench = items(spark, [(1, " ".join(passage)), (1, " ".join(passage)), (2, None), (3, ""), (4, "only three words")])
    found = dc.find_contamination(docs, bench)
    got = sorted(((r["doc_id"], r["item_id"], r["n_tiles"], r["coverage"]) for r in found.collect()), key=str)
    want = [(1, 1, 2, 1.0)] * 2 + [(4, 1, 1, 1.0)] * 4 + [(None, 1, 1, 1.0)] * 2 + [(7, 4, 1, 1.0), (8, 4, 1, 1.0)]
    assert got == sorted(want, key=str)
    assert set(by_id(dc.without_contamination(docs, bench))) == {2, 3, 5, 6}
    blocks = dc.find_contamination(docs, bench, block_bytes=100)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, found.collect()))
    assert dc.find_contamination(edges, bench).count() == 0
    assert dc.without_contamination(edges, bench).columns == edges.columns


def test_empty(spark, nothing, edges):
    assert dc.find_contamination(nothing, items(spark, [(1, "a b c d e f")])).count() == 0
    assert dc.find_contamination(edges, items(spark, [])).count() == 0
    assert dc.without_contamination(edges, items(spark, [])).count() == edges.count()


def test_many_equal_items_travel_once(make, spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(i % 50, text) for i in range(200)] + [(None, text)], "item_id long, text string")
    sent = []
    of = dc.Items.of
    monkeypatch.setattr(dc.Items, "of", lambda ids, texts: sent.append(len(ids)) or of(ids, texts))
    found = dc.find_contamination(make([(1, "a b " + text), (2, "other words alone")]), items, block_bytes=100)
    rows = found.collect()
    assert sum(sent) == 1
    assert {r["doc_id"] for r in rows} == {1} and len(rows) == 201
    assert sorted(r["item_id"] for r in rows if r["item_id"] is not None) == sorted(i % 50 for i in range(200))
