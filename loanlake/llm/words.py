"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]`` in the text's UTF-8 form; A-Z count as a-z. Hashes depend on
the word alone, not on the process, the batch or the machine.
"""

import ctypes
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
#: Bytes of text whose words are found at once; arrays over them take some thirty times as much.
SLICE_BYTES = 1_000_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits. Works in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and where each text starts, with the end as last entry.

    NULL counts as an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    everything = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return everything[first[0] : first[-1]], first - first[0]


@dataclass
class Words:
    """Words of several texts: ``hashes`` of all, ``first`` word of each text, byte positions and the bytes."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def split_words(column: pa.Array, fold: bool = True, breaks: np.ndarray = _SPACE) -> Words:
    """The words of all texts; without ``fold`` A-Z and a-z differ. ``breaks`` marks the bytes between words."""
    data, first_byte = text_bytes(column)
    space = breaks[data]
    inner = first_byte[(first_byte > 0) & (first_byte < len(data))]
    before = np.ones(len(data), dtype=bool)  # is there a space or an end of text before the byte
    before[1:] = space[:-1]
    before[inner] = True
    starts = np.flatnonzero(~space & before)
    after = np.ones(len(data), dtype=bool)
    after[:-1] = space[1:]
    after[inner - 1] = True
    ends = np.flatnonzero(~space & after) + 1
    padded = np.concatenate([_LOWER[data] if fold else data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    sizes = ends - starts
    hashes = mix(sizes.astype(np.uint64) * _STEP + _STEP)
    todo, at = np.arange(len(starts)), 0
    while len(todo):
        block = eight[starts[todo] + at] & _KEEP[np.minimum(sizes[todo] - at, 8)]
        hashes[todo] = mix((hashes[todo] ^ block) * _STEP + _STEP)
        at += 8
        todo = todo[sizes[todo] > at]
    return Words(hashes, np.searchsorted(starts, first_byte), starts, ends, data)


def shingles(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; entry ``i`` starts at word ``i``. Runs may cross texts; see ``ranges``."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for i in range(size):
        found *= _STEP
        found += hashes[i : i + n]
    return mix(found)


def text_shingles(words: Words, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The shingles of each text in order; a text with fewer words, but some, has one shingle of all its words."""
    all_of_them = shingles(words.hashes, size)
    for begin, end in zip(words.first[:-1], words.first[1:], strict=True):
        if end - begin >= size:
            yield all_of_them[begin : end - size + 1]
        elif end > begin:
            yield shingles(words.hashes[begin:end], int(end - begin))
        else:
            yield np.zeros(0, np.uint64)


def release_memory() -> None:
    """Give freed memory back to the system: Spark uses this process again, and arrays of megabytes leave gaps."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], text: str, most_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many bytes of text, or of one row.

    What earlier tasks of this process have freed is given back before the first.
    """
    release_memory()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        begin = 0
        while begin < len(sizes):
            reached = ends[begin] - sizes[begin] + most_bytes
            end = max(begin + 1, int(np.searchsorted(ends, reached, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
