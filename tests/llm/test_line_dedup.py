import hashlib
import random
from collections import Counter

import pytest
from conftest_llm import by_id, edge_texts

from loanlake.llm import line_dedup
from loanlake.llm.stash import Stash

SPACES = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=40, min_docs=5):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))

    held = {}
    for i, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            held.setdefault(k, []).append(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            docs = held[key(line)]
            named = [d for d in docs if d is not None]
            if len(key(line)) < min_chars or len(docs) < min_docs or (max(named) if named else None) == i:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def check(make, rows, **options):
    found = line_dedup.drop_repeated_lines(make(rows).repartition(3), **options).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_edges(make):
    check(make, edge_texts())


def test_empty(nothing):
    assert line_dedup.drop_repeated_lines(nothing).count() == 0
    assert line_dedup.without_repeated_lines(nothing).count() == 0


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_random_lines_in_batches(make, batches):
    rng = random.Random(batches)
    pool = [f"{x} This Is a Shared line of Forty or more characters É {x}" for x in range(12)] + ["short", "", "\t"]
    rows = [(i, "\n".join(rng.choice(["", " ", "\x0b"]) + rng.choice(pool) for _ in range(rng.randrange(6))))
            for i in range(60)]
    check(make, rows, batches=batches)


def test_runs_hold_each_key_once_and_are_compacted(spark):
    runs = line_dedup.LineRuns(Stash(spark), fanout=2)
    for batch in ([(1, 1, 9), (2, 2, 8)], [(2, 2, 7), (3, 3, 6)], [(1, 1, 2), (4, 4, 1)], [(4, 4, 0)]):
        runs.add(spark.createDataFrame(batch, "hi long, lo long, doc_id long"))
    found = sorted(map(tuple, runs.all().collect()))
    assert found == [(1, 1, 9), (2, 2, 8), (3, 3, 6), (4, 4, 1)]
    assert [len(level) for level in runs.levels] == [0, 0, 1]


def test_columns_and_texts_that_lose_nothing(edges):
    done = line_dedup.without_repeated_lines(edges)
    assert done.columns == edges.columns
    before, after = by_id(edges), by_id(done)
    changed = {i for i in before if Counter(map(str, before[i])) != Counter(map(str, after[i]))}
    assert changed == {11, 12, 13, 14}
    assert after[11][0]["text"] == "" and after[11][0]["n_chars"] == 0 and after[1][0]["text"] is None


def test_no_python_in_the_plan(edges):
    plan = line_dedup.drop_repeated_lines(edges)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
