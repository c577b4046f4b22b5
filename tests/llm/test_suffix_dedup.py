import hashlib
import random

import numpy as np
import pytest
from conftest_llm import edge_texts

from loanlake.llm import key_bitmap
from loanlake.llm import suffix_dedup as sd


def brute(rows):
    seen = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        for k in range(len(b) - sd.LENGTH + 1):
            s = b[k : k + sd.LENGTH]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - sd.LENGTH + 1):
            if seen[b[k : k + sd.LENGTH]] > 1:
                gone[k] += 1
                gone[k + sd.LENGTH] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted():
    rng = random.Random(4)

    def noise(n, letters="abcdefghij é"):
        return "".join(rng.choice(letters) for _ in range(n))

    passage, other = noise(400), noise(230)
    rows = [(i, noise(rng.randrange(300)) + passage[rng.randrange(60) :] + noise(rng.randrange(300))) for i in range(15)]
    rows += [(20 + i, noise(150) + other[: 195 + i] + noise(150)) for i in range(12)]
    rows += [(40, other + noise(10) + other), (41, noise(5) * 90), (42, noise(2000, "ab")), (43, "ab" * 150)]
    rows += [(50 + i, noise(260)) for i in range(5)] + [(None, passage), (60, passage + "x" + passage)]
    return rows


@pytest.mark.parametrize("most_pieces", [1, 2, 2000])
def test_planted(make, most_pieces):
    rows = planted()
    found = sd.remove_repeats(make(rows).repartition(3), most_pieces).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_edges(make):
    rows = [(i, t) for i, t in edge_texts() if i != 10]
    found = sd.remove_repeats(make(rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)


def test_empty(nothing):
    assert sd.remove_repeats(nothing).count() == 0


def test_gram_hashes_depend_on_bytes_alone():
    data = np.frombuffer(b"0123456789" * 30, np.uint8)
    found = sd.gram_hashes(data)
    assert len(found) == 300 - sd.GRAM + 1 and (found[:10] == found[10:20]).all() and len(set(found[:10])) == 10


def test_anchors_by_definition_and_in_steps(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = [0, 199, 200, 1500, 0, 201, 900]
    data = rng.integers(97, 100, sum(sizes)).astype(np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes)])
    want = {}
    for text, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        hashes = sd.gram_hashes(data[a:b]) >> np.uint64(24) if b - a >= sd.LENGTH else []
        for k in range(max(0, b - a - sd.LENGTH + 1)):
            want.setdefault((text, k + int(np.argmin(hashes[k : k + sd.REACH + 1]))), []).append(k)
    want = [(*key, min(k), max(k)) for key, k in want.items()]
    for step in (1 << 18, 1000, 7):
        monkeypatch.setattr(sd, "STEP", step)
        found = sd.anchors(data, first)
        assert list(zip(*(x.tolist() for x in found[:4]), strict=True)) == want


def exchanged_texts(make, monkeypatch):
    """How many tables with whole texts are shuffled or collected before pieces are made."""
    made = []
    own = sd.Stash.keep

    def keep(self, df, name, **options):
        if name == "members":
            made.append(df._jdf.queryExecution().optimizedPlan().toString())
        return own(self, df, name, **options)

    monkeypatch.setattr(sd.Stash, "keep", keep)
    rows = planted()
    found = sd.remove_repeats(make(rows)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
    (plan,) = made
    return sum("Join" in line and "LeftAnti" not in line for line in plan.splitlines())


def test_texts_are_not_joined_to_anchors(make, monkeypatch):
    assert exchanged_texts(make, monkeypatch) == 0


def test_more_anchors_than_a_bitmap_holds_are_joined(make, monkeypatch):
    monkeypatch.setattr("loanlake.llm.key_bitmap.MAPPED_KEYS", 3)
    assert exchanged_texts(make, monkeypatch) > 0


def test_bitmap(spark):
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000)
    frame = spark.createDataFrame([(int(k),) for k in keys[:5000]], "key long").repartition(4)
    bitmap = key_bitmap.key_bitmap(frame, 5000)
    assert bitmap.may_hold(keys[:5000]).all()
    assert bitmap.may_hold(keys[5000:]).mean() < 0.02
    nothing = key_bitmap.key_bitmap(frame.limit(0), 0)
    assert not nothing.may_hold(keys).any()
