from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
from conftest_llm import edge_texts

from loanlake.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_tokens(texts):
    """Per text the ids and bytes of whole texts' tokens, by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    byte = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    byte |= {chr(256 + i): c for i, c in enumerate(c for c in range(256) if chr(c) not in byte)}
    for text in texts:
        whole = b" " + (text or "").encode()
        e = a.encode(" " + (text or ""), add_special_tokens=False)
        first = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in e.ids]
        second = []
        for i in b.encode(text or ""):
            piece = b.id_to_piece(i)
            is_byte = len(piece) == 6 and piece.startswith("<0x")
            second.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
        same = all(b"".join(x for _, x in side) == whole for side in (first, second))
        yield (first, second) if text and same else ([], [])


def spans(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute(rows):
    links, groups = [], []
    for first, second in brute_tokens([t for _, t in rows]):
        a, b = spans(first), spans(second)
        linked, j = [], 0
        for i, s, e in a:
            while j < len(b) and b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                linked.append((i, b[k][0]))
                k += 1
        links.append(linked)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        text, ia, ib = [], 0, 0
        for cut in cuts:
            na, nb = ia, ib
            while na < len(a) and a[na][2] <= cut:
                na += 1
            while nb < len(b) and b[nb][2] <= cut:
                nb += 1
            text.append(",".join(str(x[0]) for x in a[ia:na]) + "|" + ",".join(str(x[0]) for x in b[ib:nb]))
            ia, ib = na, nb
        groups.append((len(a), len(b), text))
    n = Counter(pair for own in links for pair in set(own))
    best = {}
    for (a, _), count in n.items():
        best[a] = max(best.get(a, 0), count)
    out = []
    for (doc, _), own, (na, nb, text) in zip(rows, links, groups, strict=True):
        digest = sha256(";".join(text).encode()).hexdigest() if text else ""
        out.append((doc, na, nb, len(text), len(own), sum(n[p] == best[p[0]] for p in own), sum(n[p] for p in own), digest))
    return sorted(out, key=str)


MORE = [(100, " leading"), (101, "  two  spaces   three \n\n tab\t end  "), (102, "a▁b"), (103, "<s> </s> <unk> <0x41>"),
        (104, "\x00\x01 \x85 \xa0x   　y"), (105, "don't we'll I'M 3.14 €uro naïve 😀👍🏽"), (106, " "), (107, "\n"),
        (108, "x" * 5000 + " y"), (109, "ﬁ Å ½ é ﻿ ​"), (110, "the the the the"), (111, " \x1c a \x1f b"),
        (112, "<|endoftext|>a <|endoftext|>"), (113, " " * 300_000 + "a  b")]


@pytest.mark.parametrize("most", [alignment.BROADCAST_PAIRS, 0])
def test_against_brute_force(spark, make, monkeypatch, most):
    monkeypatch.setattr(alignment, "CACHED_UNITS", 50)
    rows = edge_texts() + MORE
    found = alignment.align_documents(make(rows).repartition(3), A, B, most)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.columns == names
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in alignment.align_documents(docs, A, B).collect()), key=str) == brute(rows)


def test_empty(nothing):
    assert alignment.align_documents(nothing, A, B).count() == 0
    assert alignment.align_documents(nothing, A, B, 0).count() == 0
