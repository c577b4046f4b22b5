"""Token ids in files of fixed-width packed bits.

Layout, all numbers little-endian:

- blocks of ``BLOCK`` ids each, the last one shorter: every 64 ids fill as many 64-bit words as an id has bits, the
  first id in the lowest bits; the last 64 are filled up with zeros
- the byte offset of each block (u64), the first id of each document (u64), the document ids (i64), and a byte per
  document that is 1 if its id is NULL
- footer of 48 bytes: ids, documents, blocks (u64 each), end id (u64), bits, ids per block (u32 each), magic

Any document is found by two reads of the tables and one of its blocks, and unpacked by whole-array shifts.

``write_token_files`` writes one file per partition, documents in ascending order of id, equal ids in order of a hash
of the text; NULL ids come first. Files carry a name of their own for each attempt of a task, and only those of
attempts that succeeded are in the manifest, so lost executors and repeated tasks leave no wrong rows. A NULL text
counts as empty: it has the end id only. An empty table gives no files. Extra columns are ignored. Rows that share an
id and a text lie in one file.
"""

import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlake.llm.stash import Stash
from loanlake.llm.tokens import BATCH_BYTES, encoder, release_memory, with_end
from loanlake.llm.words import slices

BLOCK = 4096
MAGIC = b"IDSPACK1"
_FOOTER = struct.Struct("<QQQQII8s")
_LANES = 64


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Ids as 64-bit words, filled up with zeros to a multiple of 64 ids."""
    groups = -(-len(ids) // _LANES)
    lanes = np.zeros(groups * _LANES, np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(groups, _LANES).T
    words = np.zeros((bits, groups), np.uint64)
    for lane in range(_LANES):
        word, shift = divmod(lane * bits, 64)
        words[word] |= lanes[lane] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= lanes[lane] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).ravel()


def unpack(words: np.ndarray, bits: int) -> np.ndarray:
    """The ids of whole groups of 64."""
    words = words.reshape(-1, bits).T
    lanes = np.empty((_LANES, words.shape[1]), np.uint64)
    for lane in range(_LANES):
        word, shift = divmod(lane * bits, 64)
        lanes[lane] = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            lanes[lane] |= words[word + 1] << np.uint64(64 - shift)
    lanes &= np.uint64((1 << bits) - 1)
    return np.ascontiguousarray(lanes.T).ravel().astype(np.uint32)


class TokenFileWriter:
    """Writes one file front to back; holds one block of ids and the tables of its documents."""

    def __init__(self, out, bits: int, end_id: int):
        self._out, self._bits, self._end_id = out, bits, end_id
        self._waiting, self._n_waiting, self._at = [], 0, 0
        self._offsets: list[np.ndarray] = []
        self._first, self._docs, self._nulls = [], [], []
        self.n_ids = self.n_docs = 0

    def add(self, ids: np.ndarray, first: np.ndarray, docs: pa.Array) -> None:
        self._first.append(first[:-1] + self.n_ids)
        self._nulls.append(docs.is_null().to_numpy(zero_copy_only=False).astype(np.uint8))
        self._docs.append(docs.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.n_docs += len(docs)
        self.n_ids += len(ids)
        self._waiting.append(ids)
        self._n_waiting += len(ids)
        whole = self._n_waiting // BLOCK * BLOCK
        if whole:
            waiting = np.concatenate(self._waiting)
            self._write(waiting[:whole])
            self._waiting, self._n_waiting = [waiting[whole:]], len(waiting) - whole

    def _write(self, ids: np.ndarray) -> None:
        block = BLOCK * self._bits // 8
        self._offsets.append(self._at + block * np.arange(-(-len(ids) // BLOCK), dtype="<u8"))
        packed = pack(ids, self._bits).astype("<u8").tobytes()
        self._out.write(packed)
        self._at += len(packed)

    def finish(self) -> None:
        rest = np.concatenate(self._waiting) if self._waiting else np.zeros(0, np.uint32)
        if len(rest):
            self._write(rest)
        tables = [self._offsets, self._first, self._docs, self._nulls]
        for table, kind in zip(tables, ["<u8", "<u8", "<i8", "u1"], strict=True):
            for part in table:
                self._out.write(part.astype(kind).tobytes())
        blocks = sum(map(len, self._offsets))
        self._out.write(_FOOTER.pack(self.n_ids, self.n_docs, blocks, self._end_id, self._bits, BLOCK, MAGIC))


class TokenFile:
    """Random access to a file. Reads the tables once and blocks as they are asked for."""

    def __init__(self, source):
        self._source = source
        end = source.size()
        footer = _FOOTER.unpack(source.read_at(_FOOTER.size, end - _FOOTER.size))
        self.n_ids, self.n_docs, blocks, self.end_id, self.bits, self._per_block, magic = footer
        if magic != MAGIC:
            raise ValueError("not a file of packed token ids")
        at = end - _FOOTER.size - self.n_docs
        self.null_docs = np.frombuffer(source.read_at(self.n_docs, at), "u1").astype(bool)
        self.doc_ids = self._table(at - 8 * self.n_docs, self.n_docs, "<i8")
        first = self._table(at - 16 * self.n_docs, self.n_docs, "<u8").astype(np.int64)
        self.first = np.append(first, self.n_ids)
        self._end_of_blocks = at - 16 * self.n_docs - 8 * blocks
        self._offsets = self._table(self._end_of_blocks, blocks, "<u8").astype(np.int64)

    def _table(self, at: int, n: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._source.read_at(8 * n, at), kind)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end``, of as many documents as they belong to."""
        if end <= begin:
            return np.zeros(0, np.uint32)
        one, last = begin // self._per_block, (end - 1) // self._per_block
        at = self._offsets[one]
        stop = self._offsets[last + 1] if last + 1 < len(self._offsets) else self._end_of_blocks
        words = np.frombuffer(self._source.read_at(int(stop - at), int(at)), "<u8")
        skip = begin - one * self._per_block
        return unpack(words, self.bits)[skip : skip + end - begin]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.first[i]), int(self.first[i + 1]))

    def close(self) -> None:
        self._source.close()


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + quote(uri))


def open_token_file(uri: str) -> TokenFile:
    where, path = _filesystem(uri)
    return TokenFile(where.open_input_file(path))


MANIFEST = "ordinal int, path string, n_docs long, n_ids long"


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode all texts into files below ``folder``, a place that all executors share; gives the manifest.

    ``ordinal`` numbers the files in the order of their documents. Ids and texts are shuffled once, by ranges of ids.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, out, name = encoder(tokenizer), None, ""
        for batch in slices(batches, "text", BATCH_BYTES):
            if out is None:
                where, path = _filesystem(folder)
                where.create_dir(path, recursive=True)
                name = f"{uuid.uuid4().hex}.ids"
                out = where.open_output_stream(f"{path}/{name}")
                writer = TokenFileWriter(out, bits_for(words.vocabulary), end_id)
            ids, first = with_end(*words.encode(batch.column("text")), end_id)
            writer.add(ids, first, batch.column("doc_id").cast(pa.int64()))
        if out is not None:
            writer.finish()
            out.close()
            row = [[TaskContext.get().partitionId()], [f"{folder}/{name}"], [writer.n_docs], [writer.n_ids]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(x, kind) for x, kind in zip(row, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["ordinal", "path", "n_docs", "n_ids"])
        out = writer = None
        release_memory()

    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    return ordered.mapInArrow(write, MANIFEST)


def read_documents(manifest: DataFrame, most_ids: int = 1_000_000) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, in order.

    ``start`` counts the ids of all documents before it; the checksum is that of its ids as little-endian 32-bit
    numbers. A task reads one file, so many ids at a time, or one document.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = open_token_file(row["path"])
                first, begin = file.first, 0
                while begin < file.n_docs:
                    end = max(begin + 1, int(np.searchsorted(first, first[begin] + most_ids, side="right")) - 1)
                    raw = file.ids(int(first[begin]), int(first[end])).astype("<u4").tobytes()
                    edges = (4 * (first[begin : end + 1] - first[begin])).tolist()
                    sums = [zlib.crc32(raw[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.doc_ids[begin:end], pa.int64(), mask=file.null_docs[begin:end]),
                            pa.array(first[begin:end] + row["before"], pa.int64()),
                            pa.array(np.diff(first[begin : end + 1]), pa.int64()),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    begin = end
                file.close()

    before = F.sum("n_ids").over(Window.orderBy("ordinal")) - F.col("n_ids")  # one row per file
    files = manifest.select("path", before.alias("before")).repartition("path")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read_back(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the files into the shared folder and read them again."""
    stash = Stash(docs.sparkSession)
    manifest = stash.keep(write_token_files(docs, stash.path("token-files"), tokenizer, end_id), "manifest")
    return read_documents(manifest)
