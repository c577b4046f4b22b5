import zlib
from itertools import product

import numpy as np
import pytest
from conftest_llm import TOKENIZER, edge_texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loanlake.llm import packing

PLAIN = Tokenizer.from_file(TOKENIZER)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 3), max_size=5), st.integers(0, 30))
def test_closest_filling(counts, room):
    used = packing.closest_filling(counts, room)
    best = max(
        (s for n in product(*[range(c + 1) for c in counts.values()])
         if (s := sum(k * x for k, x in zip(counts, n, strict=True))) <= room),
    )
    assert sum(k * n for k, n in used.items()) == best and all(0 < n <= counts[k] for k, n in used.items())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 400), max_size=20))
def test_plan_places_every_rest_once(histogram):
    ranks, fill = {k: [] for k in histogram}, {}
    for length, begin, end, per, sequence, offset in packing.plan(histogram, 32):
        for r in range(begin, end):
            ranks[length].append(r)
            at = offset + (r - begin) % per * length
            fill.setdefault(sequence + (r - begin) // per, []).append((at, at + length))
    assert {k: sorted(x) for k, x in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    for spans in fill.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 32
        assert all(a[1] == b[0] for a, b in zip(spans[:-1], spans[1:], strict=True))


def check(rows, found, window):
    ids = {}
    for i, text in rows:
        ids.setdefault(i, []).append(np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    pieces = {}
    for r in found:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    want = {}
    for i, texts in ids.items():
        for own in texts:
            for start in range(0, len(own), window):
                part = own[start : start + window]
                want.setdefault(i, []).append((start, len(part), zlib.crc32(part.tobytes()), len(own)))
    assert {i: sorted(x) for i, x in pieces.items()} == {i: sorted(x) for i, x in want.items()}
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        spans.sort()
        assert [a for a, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist()
        assert sum(n for _, n in spans) <= window
    return sequences


@pytest.mark.parametrize("window", [64, 2048])
def test_edges(edges, window):
    check(edge_texts(), packing.pack_documents(edges, TOKENIZER, window).collect(), window)


def test_little_padding(make):
    rows = [(i, "a " * (i * 37 % 700)) for i in range(300)]
    sequences = check(rows, packing.pack_documents(make(rows), TOKENIZER).collect(), 2048)
    total = sum(n for spans in sequences.values() for _, n in spans)
    assert len(sequences) == -(-total // 2048)


def test_empty(nothing):
    assert packing.pack_documents(nothing, TOKENIZER).count() == 0
