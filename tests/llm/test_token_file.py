import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import TOKENIZER, edge_texts
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loanlake.llm import token_file
from loanlake.llm.stash import Stash
from loanlake.llm.tokens import WordEncoder

PLAIN = Tokenizer.from_file(TOKENIZER)
ENCODER = WordEncoder(TOKENIZER, cached_words=20, cached_bases=10)


def plain(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.text(alphabet="A.,#aΣσ'st. \n\x1ćé<|>")), max_size=5))
def test_words_encode_like_whole_texts(texts):
    ids, first = ENCODER.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)] == [plain(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.data())
def test_pack_round_trip(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**bits - 1), max_size=200)), np.uint32)
    words = token_file.pack(ids, bits)
    assert len(words) == -(-len(ids) // 64) * bits
    assert token_file.unpack(words, bits)[: len(ids)].tolist() == ids.tolist()


def test_bits():
    assert [token_file.bits_for(n) for n in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


@pytest.mark.parametrize("bits", [5, 16, 17])
def test_random_access(tmp_path, bits):
    rng = np.random.default_rng(bits)
    sizes = [0, 1, 4095, 4096, 4097, 63, 64, 20000, 1]
    docs = [rng.integers(0, 2**bits, n, dtype=np.uint32) for n in sizes]
    with pa.OSFile(str(tmp_path / "x"), "wb") as out:
        writer = token_file.TokenFileWriter(out, bits, 1)
        for part in (docs[:4], docs[4:]):
            first = np.concatenate([[0], np.cumsum([len(d) for d in part])])
            writer.add(np.concatenate(part), first, pa.array(range(len(part))))
        writer.finish()
    file = token_file.open_token_file(str(tmp_path / "x"))
    assert file.n_docs == 9 and file.n_ids == sum(sizes)
    for i in (8, 0, 3, 7, 1, 5):
        assert file.document(i).tolist() == docs[i].tolist()


def test_edges(edges):
    found = token_file.encode_and_read_back(edges, TOKENIZER).collect()
    want = {}
    for i, text in edge_texts():
        ids = np.array([*plain(text), 1], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    got = {}
    for r in found:
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {i: sorted(x) for i, x in got.items()} == {i: sorted(x) for i, x in want.items()}
    ordered = sorted(found, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1].tolist()
    ids = [r["doc_id"] for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_empty(nothing, spark):
    assert token_file.encode_and_read_back(nothing, TOKENIZER).count() == 0
    stash = Stash(spark)
    assert token_file.write_token_files(nothing, stash.path("x"), TOKENIZER).count() == 0
