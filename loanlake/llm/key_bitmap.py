"""A bitmap of keys, sent to the executors so that rows whose key it hasn't are dropped before they are shuffled."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.llm.words import mix

#: At least so many bits a key; a key that isn't there is taken for one that is in at most 1.4 % of cases.
BITS_A_KEY = 16
#: Keys up to this count have a bitmap (64 MB at most); more keys are joined by a shuffle.
MAPPED_KEYS = 1 << 25


class KeyBitmap:
    def __init__(self, size: int, words: np.ndarray):
        self._size = size
        self._words = words

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """False for keys that are not among those of the bitmap, True for those that are and for a few others."""
        first, second = _places(keys, self._size)
        return _bits(self._words, first) & _bits(self._words, second)


def _places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two of ``1 << size`` bits for each key."""
    mixed = mix(keys.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return (mixed >> np.uint64(64 - size)).view(np.int64), (mixed & np.uint64((1 << size) - 1)).view(np.int64)


def _bits(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (words[places >> 6] >> (places & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def key_bitmap(keys: DataFrame, n: int) -> KeyBitmap | None:
    """The bitmap of ``n`` different keys, the only column of ``keys`` (longs, not NULL), or None if there are too many.

    Tasks make bits and Spark merges them, so the driver gets the words of the bitmap, not the keys.
    """
    if n > MAPPED_KEYS:
        return None
    size = max(10, (BITS_A_KEY * n - 1).bit_length())

    def bits(batches):
        for batch in batches:
            places = np.unique(np.concatenate(_places(batch.column(0).to_numpy(), size)))
            bit = np.uint64(1) << (places & 63).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(places >> 6), pa.array(bit.view(np.int64))], ["word", "bits"])

    merged = keys.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (size - 6), np.uint64)
    words[merged.column("word").to_numpy()] = merged.column("bits").to_numpy().view(np.uint64)
    return KeyBitmap(size, words)
