"""Token ids of many texts with a public tokenizer file.

The tokenizer drops white space and lets no token reach over it, so a text's ids are the ids of its words one after
the other, where words are split at ``[\\x20\\x09-\\x0D]``. Nor does a token reach from a letter or digit to the marks
after it, and case doesn't matter but in special tokens: a word is its base in lower case and its last marks, which are
units of their own. Units are found for a whole batch at once, each distinct one of a batch is looked up once, and common
ones are encoded once per process; tests compare with encoding whole texts.
"""

import os
import re
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa

from loanlake.llm.words import release_memory, text_bytes

#: Units kept between batches, together (about 50 MB); others are encoded again in the next batch that has them.
CACHED_WORDS = 120_000
CACHED_BASES = 150_000
#: Bytes of text encoded at a time.
BATCH_BYTES = 1_000_000
#: Marks at the end of a word that are gone through one by one, in all words at once.
_STEPS = 16
#: Units that the library gets at a time, plain ones as one text: what it returns takes many times the memory of ids.
_TOGETHER = 500

_LETTERS = [*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Marks that a word may end in; not the apostrophe, which starts endings, and no word with ``<|`` of special tokens.
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_BASE_END = np.zeros(256, bool)  # what marks are split from, in ASCII
_BASE_END[[*_LETTERS, *range(ord("0"), ord("9") + 1)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: U+00C0 to U+00FF are letters but for two; in UTF-8 they are 0xC3 and one of these bytes.
_LATIN_LEAD = 0xC3
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
#: Units that are one piece to the model as they are: letters in lower case, with no other form of the same text.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


class _Numbers(dict):
    """Units numbered in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.units: list[bytes] = []

    def __missing__(self, unit: bytes) -> int:
        self[unit] = number = len(self)
        self.units.append(unit)
        return number

    def forget(self, keep: int) -> None:
        for unit in self.units[keep:]:
            del self[unit]
        del self.units[keep:]


def _last_other(data: np.ndarray, start: np.ndarray, last: np.ndarray) -> np.ndarray:
    """From ``last`` back the byte that is no mark, or one before ``start``."""
    todo = np.arange(len(last))
    for _ in range(_STEPS):
        last[todo] -= 1
        todo = todo[(last[todo] >= start[todo]) & _MARK[data[last[todo]]]]
        if not len(todo):
            return last
    for i in todo:  # what ends in many marks
        others = np.flatnonzero(~_MARK[data[start[i] : last[i]]])
        last[i] = start[i] + others[-1] if len(others) else start[i] - 1
    return last


def _units(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts, and where each text's units start, with the end as last entry."""
    data, first = text_bytes(column)
    space = _SPACE[data]
    inner = first[(first > 0) & (first < len(data))]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)  # is there a space or an edge of a text
    before[1:], after[:-1] = space[:-1], space[1:]
    before[inner] = after[inner - 1] = True
    start = np.flatnonzero(~space & before)
    if not len(start):
        return pa.array([], pa.large_binary()), np.zeros(len(first), np.int64)
    end = np.cumsum(np.flatnonzero(~space & after) + 1 - start)
    first_word = np.searchsorted(start, first)
    data, start = data[~space], np.append(0, end[:-1])
    # Special tokens are matched on the text as it is, so words with ``<|`` stay as they are.
    special = np.zeros(len(start), bool)
    special[np.searchsorted(start, np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|"))), "right") - 1] = True
    marked = np.flatnonzero(_MARK[data[end - 1]] & ~special)
    last = _last_other(data, start[marked], end[marked] - 1)
    last = last[last >= start[marked]]
    split = last[_BASE_END[data[last]] | (_LATIN[data[last]] & (data[last - 1] == _LATIN_LEAD) & (last > 0))] + 1
    # Beyond U+00FF case goes with the forms of a text: such words are left to the library.
    fold = np.repeat(~special & ~np.logical_or.reduceat(data > _LATIN_LEAD, start), end - start)
    at = np.flatnonzero(data[:-1] == _LATIN_LEAD) + 1
    at = at[fold[at] & _LATIN[data[at]] & (data[at] < 0x9F)]
    data = np.where(fold, _LOWER[data], data)
    data[at] += 0x20
    edge = np.zeros(len(data) + 1, bool)
    edge[start] = edge[split] = edge[-1] = True
    edges = np.flatnonzero(edge)
    first_unit = np.searchsorted(edges, np.append(start, len(data))[first_word])
    buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, buffers), first_unit


class WordEncoder:
    def __init__(self, path: str, cached_words: int = CACHED_WORDS, cached_bases: int = CACHED_BASES):
        # A task has one core, and each thread of the library keeps memory of its own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit, Sequence

        self._tokenizer = Tokenizer.from_file(path)
        # The same model without the steps that leave plain units as they are.
        self._plain = Tokenizer(self._tokenizer.model)
        self._plain.pre_tokenizer = Sequence([CharDelimiterSplit(" "), ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix, vocabulary = self._tokenizer.model.end_of_word_suffix, self._tokenizer.get_vocab(with_added_tokens=False)
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self._cached = cached_words + cached_bases
        self._units = _Numbers()
        self._ids = np.zeros(0, np.uint32)
        self._first = np.zeros(1, np.int64)

    @property
    def vocabulary(self) -> int:
        return self._tokenizer.get_vocab_size(with_added_tokens=True)

    def _encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = []
        for i in range(0, len(texts), _TOGETHER):
            batch = self._tokenizer.encode_batch_fast(texts[i : i + _TOGETHER], add_special_tokens=False)
            lists += [found.ids for found in batch]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many units as one text; the last token of each is one that ends words."""
        parts = [np.zeros(0, np.uint32)]
        for i in range(0, len(texts), _TOGETHER):
            (found,) = self._plain.encode_batch_fast([" ".join(texts[i : i + _TOGETHER])], add_special_tokens=False)
            parts.append(np.array(found.ids, np.uint32))
        ids = np.concatenate(parts)
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(texts):  # a file whose units don't end so
            return self._encode_each(texts)
        return ids, np.diff(ends, prepend=0)

    def _learn(self) -> None:
        new = self._units.units[len(self._first) - 1 :]
        if not new:
            return
        texts = [unit.decode() for unit in new]
        plain = np.fromiter((_PLAIN.fullmatch(text) is not None for text in texts), bool, len(texts))
        sizes = np.zeros(len(texts), np.int64)
        parts = []
        for mask, encode in ((plain, self._encode_plain), (~plain, self._encode_each)):
            ids, sizes[mask] = encode([texts[i] for i in np.flatnonzero(mask)])
            parts.append(ids)
        first = np.concatenate([[0], np.cumsum(sizes)])
        flat, of_plain = np.zeros(int(first[-1]), np.uint32), np.repeat(plain, sizes)
        flat[of_plain], flat[~of_plain] = parts
        self._first = np.concatenate([self._first, self._first[-1] + first[1:]])
        self._ids = np.concatenate([self._ids, flat])

    def _forget(self) -> None:
        self._units.forget(self._cached)
        self._first = self._first[: len(self._units) + 1]
        self._ids = self._ids[: self._first[-1]].copy()

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids start, with the end as last entry. NULL is empty."""
        units, first_unit = _units(column)
        units = units.dictionary_encode()
        _, edges, data = units.dictionary.buffers()
        edges = np.frombuffer(edges, np.int64, len(units.dictionary) + 1).tolist() if len(units) else [0]
        data = data.to_pybytes() if data else b""
        different = [data[a:b] for a, b in pairwise(edges)]
        numbers = np.fromiter(map(self._units.__getitem__, different), np.int64, len(different))
        self._learn()
        numbers = numbers[units.indices.to_numpy()]
        begins = self._first[numbers]
        sizes = self._first[numbers + 1] - begins
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self._ids[np.arange(total) + np.repeat(begins - (ends - sizes), sizes)]
        first = np.concatenate([[0], ends])[first_unit]
        self._forget()
        return ids, first


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per process and file."""
    return WordEncoder(path)


def release_encoders() -> None:
    """Give back what earlier steps have cached in this process."""
    encoder.cache_clear()
    release_memory()


def with_end(ids: np.ndarray, first: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after those of each text."""
    n = len(first) - 1
    shifted = first + np.arange(n + 1)
    out = np.full(len(ids) + n, end_id, np.uint32)
    inner = np.ones(len(out), dtype=bool)
    inner[shifted[1:] - 1] = False
    out[inner] = ids
    return out, shifted
