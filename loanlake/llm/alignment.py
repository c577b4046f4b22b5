"""Which tokens of two tokenizers stand for the same bytes of a text, and how often in the corpus.

A text's tokens of either tokenizer cut its bytes, a space and the text, into pieces. Where both end, a group ends. Two
tokens are linked if their bytes overlap. Each piece between two neighbouring ends of either tokenizer lies in exactly
one token of both, and each link has exactly one such piece: links are the full outer join of both token lists by
document and end, with the gaps filled from the next end.

A batch of texts is one set of Arrow tables: lists of ids are flattened with their parents' indices, token sizes are
summed up per segment, ends are joined by Acero on document and end, and id pairs are counted by ``Table.group_by``,
once per document. Spark adds up the counts of all tasks; frequent pairs arrive as one row per task.

Links are made once and written. The counts of all pairs are sent to executors if they are no more than
``BROADCAST_PAIRS``; beyond that, the distinct pairs of each document are joined to them by a shuffle, with the same
result. Pairs of a document that is one page over and over are few, and frequent pairs are spread by adaptive execution.

Defined cases: NULL and empty texts, and texts of which a tokenizer doesn't give back all bytes (one that holds U+2581,
say), have no tokens: counts of 0 and an empty string. A NULL id stays NULL. Repeated rows count as documents each.
Special tokens' strings are plain text. Extra columns are ignored. An empty table gives no rows.
"""

import json
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from hashlib import sha256
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlake.llm.stash import Stash
from loanlake.llm.words import slices

#: Units kept between batches; others are encoded again in the next batch that has them.
CACHED_UNITS = 100_000
#: Bytes of text in a set of tables.
BATCH_BYTES = 1_000_000
#: Rows of counted pairs that a task holds before it adds them up.
HELD_PAIRS = 1_000_000
#: Pairs that are sent to executors, at 13 bytes each; more are joined by a shuffle.
BROADCAST_PAIRS = 4_000_000

# Fixed value: the public pattern that a byte-level tokenizer splits a text by before it merges bytes.
_PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Before a space between two characters that are no white space, tokens of either tokenizer end.
_UNIT = regex.compile(r"(?<=\S)(?= \S)")
#: ASCII texts without these are cut at every space.
_WIDE = [x + y for c in "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f " for x, y in ((" ", c), (c, " "))]
_ENCODED = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<{}>"
_RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
_KINDS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _byte_level() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: visible Latin-1 characters are themselves,
    the other bytes follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ByteTokens:
    """A byte-level BPE file's ids of whole texts.

    If ids are in the order of merges, the merge of two neighbours with the least id is the merge that comes first, and
    a library that goes by ids alone gives the same at a fifth of the time. Texts that are too much for its pattern
    (a million spaces in a row), and files in another order, are left to the file's own library.
    """

    def __init__(self, path: str):
        self._path = path
        byte = {c: b for b, c in _byte_level().items()}
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        vocabulary, added = parts["model"]["vocab"], {t["content"]: t["id"] for t in parts["added_tokens"]}
        ranks = {bytes(byte[c] for c in e): i for e, i in vocabulary.items() if e not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in parts["model"]["merges"]]
        made = [vocabulary[a + b] for a, b in merges]
        self._quick = None
        if made == sorted(made):
            import tiktoken

            self._quick = tiktoken.Encoding(path, pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
        known: list[bytes | None] = [None] * (1 + max([*vocabulary.values(), *added.values()]))
        for token, i in [*ranks.items(), *[(t.encode(), i) for t, i in added.items()]]:
            known[i] = token
        self.bytes = pa.array(known, pa.large_binary())

    @cached_property
    def _whole(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self._path)
        found.encode_special_tokens = True
        return found

    def encode(self, text: str) -> np.ndarray:
        if self._quick:
            try:
                return self._quick.encode_to_numpy(text, disallowed_special=())
            except ValueError:
                pass
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode_all(self, texts: list[str | None]) -> pa.ListArray:
        """Of a space and each text; nothing for an empty one."""
        found = [self.encode(" " + t) if t else np.zeros(0, np.uint32) for t in texts]
        first = np.cumsum([0, *map(len, found)]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.uint32), *found]).astype(np.int32)
        return pa.ListArray.from_arrays(first, pa.array(flat))


class _Numbers(dict):
    """Keys numbered in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class PieceTokens:
    """A piece file's ids of whole texts; it puts a space before each.

    No piece goes on after a space, so what stands between two spaces is encoded once a batch, and once per process if
    it is among the first ``CACHED_UNITS`` met. A file with other pieces encodes whole texts.
    """

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self._by_unit = not any("▁" in p.lstrip("▁") for p in pieces)
        self.bytes = pa.array([self._bytes_of(i, p) for i, p in enumerate(pieces)], pa.large_binary())
        self._numbers, self._ids, self._first = _Numbers(), np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _bytes_of(self, i: int, piece: str) -> bytes:
        return bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

    def _learn(self) -> None:
        new = list(islice(self._numbers, len(self._first) - 1, None))
        lists = self._model.encode(new, num_threads=1) if new else []
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
        self._ids = np.concatenate([self._ids, flat])
        self._first = np.concatenate([self._first, self._first[-1] + np.cumsum(sizes)])

    def _forget(self) -> None:
        for unit in list(islice(self._numbers, CACHED_UNITS, None)):
            del self._numbers[unit]
        self._first = self._first[: len(self._numbers) + 1]
        self._ids = self._ids[: self._first[-1]]

    def _units(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not self._by_unit:
            return [text]
        if text.isascii() and not text[0].isspace() and text[-1] != " " and not any(w in text for w in _WIDE):
            return text.split(" ")
        return [u[1:] for u in _UNIT.split(" " + text)]

    def encode_all(self, texts: list[str | None]) -> pa.ListArray:
        per_text = [self._units(t) for t in texts]
        spoken = np.cumsum([0, *map(len, per_text)])
        units = np.fromiter(map(self._numbers.__getitem__, chain.from_iterable(per_text)), np.int64, int(spoken[-1]))
        self._learn()
        begins = self._first[units]
        sizes = self._first[units + 1] - begins
        ends = np.concatenate([[0], np.cumsum(sizes)])
        flat = self._ids[np.arange(ends[-1]) + np.repeat(begins - ends[:-1], sizes)]
        self._forget()
        return pa.ListArray.from_arrays(ends[spoken].astype(np.int32), pa.array(flat))


class PairEncoder:
    """Both tokenizers of a space and a text, and the bytes of their ids."""

    def __init__(self, path_a: str, path_b: str):
        self._sides = ByteTokens(path_a), PieceTokens(path_b)
        self.bytes_a, self.bytes_b = (side.bytes for side in self._sides)

    def encode(self, column: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        """Lists of ids of both tokenizers; both empty where the bytes of one of them aren't a space and the text."""
        column = column.cast(pa.large_string())
        texts = column.to_pylist()
        lists = [side.encode_all(texts) for side in self._sides]
        space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        wanted = pc.binary_join_element_wise(space, pc.fill_null(column, nothing), nothing).cast(pa.large_binary())
        whole = pc.and_(*[pc.equal(_joined(x, s.bytes), wanted) for x, s in zip(lists, self._sides, strict=True)])
        return tuple(pc.if_else(whole, x, pa.scalar([], pa.list_(pa.int32()))) for x in lists)


@lru_cache(maxsize=1)
def pair_encoder(path_a: str, path_b: str) -> PairEncoder:
    """One per process and pair of files."""
    return PairEncoder(path_a, path_b)


def _offsets(lists: pa.ListArray) -> np.ndarray:
    """Where each list starts among all values, with the end as last entry."""
    return np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)


def _joined(lists: pa.ListArray, of: pa.Array) -> pa.Array:
    """The bytes of each list's ids, joined."""
    tokens = of.take(pc.list_flatten(lists))
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(tokens).to_numpy())]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lists), [None, pa.py_buffer(ends[_offsets(lists)]), tokens.buffers()[2]]
    )


def _ends(ids: pa.ListArray, of: pa.Array, name: str) -> pa.Table:
    """``doc, end`` of every token: the document's index and the byte after the token; the token's id as ``name``."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(pc.binary_length(of).take(flat))
    # Sums run over all documents: take off what was there before each one.
    before = np.concatenate([[0], total.to_numpy()])[_offsets(ids)[:-1]]
    end = pc.subtract(total, pa.array(before, pa.int64()).take(doc))
    return pa.table({"doc": doc.cast(pa.int64()), "end": end, name: flat})


def _links(a: pa.ListArray, b: pa.ListArray, bytes_a: pa.Array, bytes_b: pa.Array) -> pa.Table:
    """``doc, a, b`` of every link in order, and whether each of the two tokens, and with both a group, ends there."""
    ends = _ends(a, bytes_a, "a").join(
        _ends(b, bytes_b, "b"), ["doc", "end"], join_type="full outer", use_threads=False
    )
    ends = ends.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()
    found = {"doc": ends["doc"]}
    for x in "ab":
        found |= {x: pc.fill_null_backward(ends[x]), f"ends_{x}": pc.is_valid(ends[x])}
    return pa.table(found)


def _sizes_of_lists(lists: pa.Array) -> pa.Array:
    return pc.list_value_length(lists).cast(pa.int64())


def _group_texts(links: pa.Table, n: int) -> tuple[np.ndarray, list[str]]:
    """The number of groups of each of ``n`` documents, and their ids: ``a1,a2|b1;a3|b2,b3``."""
    ends = {x: links[f"ends_{x}"].to_numpy() for x in "ab"}
    last = ends["a"] & ends["b"]
    doc = links["doc"].to_numpy()
    group = np.cumsum(last) - last
    n_groups = int(last.sum())
    sides = []
    for x in "ab":
        ids = links[x].combine_chunks().filter(pa.array(ends[x])).cast(pa.string())
        sizes = np.bincount(group[ends[x]], minlength=n_groups)
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        sides.append(pc.binary_join(pa.ListArray.from_arrays(first, ids), ","))
    texts = pc.binary_join_element_wise(*sides, "|")
    counts = np.bincount(doc[last], minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return counts, pc.binary_join(pa.ListArray.from_arrays(first, texts), ";").to_pylist()


def _pair_type(n_a: int, n_b: int) -> str:
    """Of numbers for two ids, given how many ids there are: four bytes for two ordinary vocabularies."""
    return "int" if n_a * n_b < 2**31 else "long"


def linked_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document the numbers of tokens and groups, a digest of the groups, the ``pairs`` of linked ids in order
    (``a`` times the number of second ids, plus ``b``), and a number of the row, which is fixed once it is written."""

    encoder = pair_encoder(path_a, path_b)
    n_b, kind = len(encoder.bytes_b), _pair_type(len(encoder.bytes_a), len(encoder.bytes_b))
    schema = _ENCODED.format(kind)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = pair_encoder(path_a, path_b), 0
        for batch in slices(batches, "text", BATCH_BYTES):
            n = batch.num_rows
            number = pc.add(batch.column("part"), pa.array(range(row, row + n), pa.int64()))
            row += n
            a, b = encoder.encode(batch.column("text"))
            links = _links(a, b, encoder.bytes_a, encoder.bytes_b)
            groups, texts = _group_texts(links, n)
            first = np.searchsorted(links["doc"].to_numpy(), np.arange(n + 1)).astype(np.int32)
            pairs = links["a"].to_numpy().astype(np.int64) * n_b + links["b"].to_numpy()
            pairs = pa.array(pairs.astype(np.int32 if kind == "int" else np.int64))
            yield pa.RecordBatch.from_arrays(
                [number, batch.column("doc_id"), _sizes_of_lists(a), _sizes_of_lists(b), pa.array(groups, pa.int64()),
                 pa.array([sha256(t.encode()).hexdigest() if t else "" for t in texts], pa.string()),
                 pa.ListArray.from_arrays(first, pairs)],
                [c.split()[0] for c in schema.split(", ")],
            )

    part = F.shiftleft(F.spark_partition_id().cast("long"), 40).alias("part")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", part).mapInArrow(rows, schema)


def _few_links(batches: Iterable[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many links, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column("pairs")).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def _once_per_document(pairs: pa.ListArray) -> pa.Table:
    """``doc, pair, n``: the different pairs of each document and how often each is in it."""
    flat = pa.table({"doc": pc.list_parent_indices(pairs), "pair": pc.list_flatten(pairs).cast(pa.int64())})
    found = flat.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    return found.rename_columns({"count_all": "n"})


def _added_up(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by("pair", use_threads=False).aggregate([("n", "sum")])
    return found.rename_columns({"n_sum": "n"}).select(["pair", "n"])


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, n``: in how many documents each pair of ids is linked."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = [pa.table({"pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})]
        rows = 0
        for batch in _few_links(batches):
            once = _once_per_document(batch.column("pairs"))
            found = once.group_by("pair", use_threads=False).aggregate([([], "count_all")])
            waiting.append(found.rename_columns({"count_all": "n"}).select(["pair", "n"]))
            rows += found.num_rows
            if rows > HELD_PAIRS:
                held = _added_up(waiting)
                if held.num_rows > HELD_PAIRS // 2:  # few repeat: pass them on instead of adding them up once more
                    yield from held.to_batches()
                    held = held.slice(0, 0)
                waiting, rows = [held], held.num_rows
        yield from _added_up(waiting).to_batches()

    return linked.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_best(counts: DataFrame, n_b: int) -> DataFrame:
    """``pair, n, best``: whether no other pair with the same first id is in more documents. An id of the first
    tokenizer has no more pairs than the second has ids."""
    of_first = Window.partitionBy(F.floor(F.col("pair") / n_b))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_first))


def document_pairs(linked: DataFrame) -> DataFrame:
    """``row, doc_id, pair, n``: the different pairs of each document and how often each is in it."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_links(batches):
            found = _once_per_document(batch.column("pairs")).combine_chunks()
            own = [batch.column(c).take(found["doc"].combine_chunks()) for c in ("row", "doc_id")]
            table = pa.table([*own, found["pair"], found["n"]], ["row", "doc_id", "pair", "n"])
            yield from table.to_batches()

    return linked.select("row", "doc_id", "pairs").mapInArrow(rows, "row long, doc_id long, pair long, n long")


def _looked_up(linked: DataFrame, counts: DataFrame) -> DataFrame:
    """The result by binary search in the counts of all pairs, which are sent to executors."""
    table = counts.toArrow().combine_chunks()
    pairs, n = table["pair"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(pairs)
    small = n.astype(np.int32) if n.max(initial=0) < 2**31 else n
    best = table["best"].to_numpy()[order]
    sent = linked.sparkSession.sparkContext.broadcast((pairs[order], small[order], best))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, is_best = sent.value
        for batch in _few_links(batches):
            lists = batch.column("pairs")
            at = np.searchsorted(known, pc.list_flatten(lists).to_numpy())
            first = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
            sums = [np.concatenate([[0], np.cumsum(x[at], dtype=np.int64)])[first] for x in (is_best, counts)]
            of = {c: batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "groups_sha256")}
            of |= {"n_links": _sizes_of_lists(lists)}
            of |= {c: pa.array(np.diff(x)) for c, x in zip(("n_best", "count_sum"), sums, strict=True)}
            yield pa.RecordBatch.from_arrays([of[c] for c in _RESULT], _RESULT)

    return linked.mapInArrow(rows, _KINDS)


def _joined_up(linked: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a join of each document's different pairs."""
    found = document_pairs(linked).join(counts.withColumnRenamed("n", "in_docs"), "pair")
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("in_docs")).alias("count_sum"),
    )
    rows = linked.withColumn("n_links", F.size("pairs").cast("long")).drop("pairs").join(sums, "row", "left")
    return rows.na.fill(0, ["n_best", "count_sum"]).select(*_RESULT)


def align_documents(docs: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document the numbers of tokens, groups and links, how many links are their first id's most frequent in the
    corpus (``n_best``), the sum of their counts, and a digest of the groups."""
    stash = Stash(docs.sparkSession)
    n_b = len(pair_encoder(path_a, path_b).bytes_b)
    # Lists are long: a task holds no more than a few megabytes of each before it writes them.
    linked = stash.keep(linked_documents(docs, path_a, path_b), "links", **{"parquet.block.size": 16 << 20})
    counts = stash.keep(with_best(pair_counts(linked), n_b), "pairs")
    return (_looked_up if counts.count() <= broadcast_pairs else _joined_up)(linked, counts)
