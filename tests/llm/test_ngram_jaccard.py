import random

import numpy as np
import pytest
from conftest_llm import by_id, edge_texts, shingle_set

from loanlake.llm import ngram_jaccard as nj


def brute(rows):
    """Links and least connected id per row."""
    own = [shingle_set(t) if i is not None else frozenset() for i, t in rows]
    linked = [
        {j for j in range(len(rows)) if j != i and a and own[j] and 5 * len(a & own[j]) >= 4 * len(a | own[j])}
        for i, a in enumerate(own)
    ]
    out = []
    for i, (doc, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((doc, min((rows[j][0] for j in seen), key=lambda d: (d is None, d)), len(linked[i])))
    return sorted(out, key=str)


def check(make, rows):
    found = nj.link_documents(make(rows)).collect()
    assert sorted([(r["doc_id"], r["class_id"], r["n_links"]) for r in found], key=str) == brute(rows)


def test_edges(make):
    check(make, edge_texts())


def test_empty(nothing):
    assert nj.link_documents(nothing).count() == 0
    assert nj.keep_one_of_each_class(nothing).count() == 0


def test_near_copies_in_several_blocks(make, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 8)
    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    rows = []
    for i in range(60):
        text = base[:]
        for _ in range(rng.randrange(4)):
            text[rng.randrange(80)] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for i in range(40)]
    check(make, rows)


@pytest.mark.parametrize("threshold", [0.8])
def test_fewest_agreeing(threshold):
    least = nj.fewest_agreeing(threshold, 1e-6)
    assert list(least) == list(range(nj.STEP, nj.VALUES + 1, nj.STEP))
    for n, m in least.items():
        grid = np.linspace(0, 1, 20001)
        for k, kept in ((m, True), (m - 1, False)):
            density = grid**k * (1 - grid) ** (n - k)
            assert (density[grid >= threshold].sum() / density.sum() >= 1e-6) == kept


def test_one_of_each_class_stays(edges):
    stay = by_id(nj.keep_one_of_each_class(edges))
    assert set(stay) == {None, 1, 2, 3, 4, 7, 8, 10, 11, 16, 17, 18, 19}
    assert [x["text"] for x in stay[None]] == [None]  # the other row without an id is a copy of one with an id
    assert nj.keep_one_of_each_class(edges).columns == edges.columns


def test_one_row_of_each_class_stays(make):
    some = " ".join(f"s{i}" for i in range(80))
    near, far = some.replace("s40 ", "other "), " ".join(f"f{i}" for i in range(80))
    rows = [(1, some), (1, some), (1, near), (2, some), (1, far), (3, far), (4, "short one"), (4, "short one"), (5, "")]
    rows += [(None, "no id at all " * 9), (None, "no id at all " * 9), (None, near)]
    stay = by_id(nj.keep_one_of_each_class(make(rows).repartition(3)))
    assert {i: len(x) for i, x in stay.items()} == {1: 2, 4: 1, 5: 1, None: 1}
    texts = [x["text"] for x in stay[1]]
    assert far in texts and (some in texts) != (near in texts)
