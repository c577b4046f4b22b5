"""Removal of repeated byte strings by external induced sorting of suffixes.

Induced sorting sorts a sample of all suffixes and derives the order of the others from it, from right to left: the
suffix one byte to the left sorts by that byte and then by the order already known, and its common prefix with its
neighbour is one byte longer. Here the sample are the suffixes at anchors. The anchor of a string of the judged length
is the place of the least hash of ``GRAM`` bytes in it, so equal strings have equal anchors at equal places. Strings
that share no anchor cannot be equal; so suffixes that meet are sent to one shard by the hash at their anchor, sorted
there from the anchor on, and the strings that start up to ``REACH`` bytes before it are induced step by step, with
their common prefixes. A string is repeated where that reaches the judged length.

Anchors found once only can be left out. A bitmap of those found several times goes to the tasks that read texts, so
neither texts nor anchors are shuffled; up to its share of false hits it is exact, and what it lets through by chance is
alone in its group. More anchors than a bitmap is made for are joined by a shuffle.

Shards of any size work in bounded memory: the tuples come from Spark's sort, which spills to disk, some groups at a
time, and a group has at most ``MOST_PIECES`` different pieces. Texts that are equal are one text, and equal pieces of
an anchor are one piece, before anything is sorted; so what a third of all texts share is a few pieces. Anchors with
more different pieces than that, such as those at the edge of such a passage, are split into their single strings,
which are counted by a 128-bit hash over the whole cluster; the result is the same.

Defined cases: a NULL text is empty. Texts shorter than the judged length lose nothing. Repeated rows are equal texts
and lose everything if long enough. NULL ids are rows like others. Extra columns are ignored. An empty table gives no
rows.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.llm.groups import whole_groups
from loanlake.llm.key_bitmap import KeyBitmap, key_bitmap
from loanlake.llm.stash import Stash
from loanlake.llm.words import mix, slices, text_bytes

LENGTH = 200
GRAM = 40
REACH = LENGTH - GRAM
MOST_PIECES = 2000
#: Keys of texts are broadcast up to this count; beyond it they are joined by a shuffle.
BROADCAST_KEYS = 1_000_000

_TEXT = ["text_a", "text_b"]
_BASE = 0x9E3779B97F4A7C15
_PLACE_BITS = 24
STEP = 1 << 18


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hashes of all runs of ``gram`` bytes, by runs of doubled length."""
    runs = {1: data.astype(np.uint64) + np.uint64(1)}
    size = 1
    while 2 * size <= gram:
        x = runs[size]
        runs[2 * size] = x[:-size] * _power(size) + x[size:]
        size *= 2
    found, have = runs[size], size
    while have < gram:
        part = max(s for s in runs if have + s <= gram)
        n = len(data) - have - part + 1
        found = found[:n] * _power(part) + runs[part][have : have + n]
        have += part
    return mix(found)


def _least_places(hashes: np.ndarray) -> np.ndarray:
    """For each string, the place of the least hash among its ``REACH + 1`` runs, the leftmost of equal ones.

    The lowest bits of the hash give way to the place.
    """
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    x = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= REACH + 1:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = REACH + 1 - size
    x = np.minimum(x[:-rest], x[rest:]) if rest else x
    return (x & mask).astype(np.int64)


def anchors(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(text, place, from, to, hash)`` of each anchor: strings that start at ``from`` to ``to`` have it.

    Places count from the start of the text. Works on ``STEP`` strings at a time, so memory follows the number of
    anchors, not the length of a text.
    """
    found = [(np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)]
    for begin in range(0, len(data) - LENGTH + 1, STEP):
        hashes = gram_hashes(data[begin : begin + STEP + LENGTH - 1])
        places = _least_places(hashes)
        text = np.repeat(np.arange(len(first) - 1), np.diff(np.clip(first, begin, begin + len(places))))
        inside = np.flatnonzero(np.arange(begin, begin + len(places)) + LENGTH <= first[text + 1])
        if not len(inside):
            continue
        places, text = places[inside], text[inside]
        new = np.ones(len(places), bool)
        new[1:] = (places[1:] != places[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        to = np.append(at[1:], len(places)) - 1
        found.append((text[at], places[at] + begin, inside[at] + begin, inside[to] + begin, hashes[places[at]]))
    text, place, begin, end, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    # A run that goes on in the next step is one run.
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    at = np.flatnonzero(new)
    to = np.append(at[1:], len(place))[: len(at)] - 1
    text, start = text[at], first[text[at]]
    return text, place[at] - start, begin[at] - start, end[to] - start, hashes[at]


def _anchor_hashes(texts: DataFrame) -> DataFrame:
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", STEP):
            found = anchors(*text_bytes(batch.column("text")))[-1]
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["anchor"])

    return texts.select("text").mapInArrow(hashes, "anchor long")


def _anchor_rows(texts: DataFrame) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", STEP):
            text, place, begin, end, found = anchors(*text_bytes(batch.column("text")))
            at = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(found.view(np.int64)),
                    *[batch.column(c).take(at) for c in _TEXT],
                    *[pa.array(x, pa.int32()) for x in (place, begin, end)],
                ],
                ["anchor", *_TEXT, "place", "begin", "end"],
            )

    return texts.mapInArrow(rows, "anchor long, text_a long, text_b long, place int, begin int, end int")


PIECE = "anchor long, piece_a long, piece_b long, text_a long, text_b long, place int, begin int, end int, piece binary"


def _of_texts(batch: pa.RecordBatch, anchor, text, place, begin, end) -> pa.RecordBatch:
    """The bytes of all strings of each anchor, and 128 bits that tell them and the anchor's place in them."""
    data, first = text_bytes(batch.column("text"))
    starts, ends = first[text] + begin, first[text] + end + LENGTH
    raw = data.tobytes()
    pieces = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    keys = [
        hashlib.blake2b(x, digest_size=16, salt=p.to_bytes(8, "little")).digest()
        for x, p in zip(pieces, (place - begin).tolist(), strict=True)
    ]
    key = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
    at = pa.array(text)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(anchor, pa.int64()),
            pa.array(key[:, 0]),
            pa.array(key[:, 1]),
            *[batch.column(c).take(at) for c in _TEXT],
            *[pa.array(x, pa.int32()) for x in (place, begin, end)],
            pa.array(pieces, pa.binary()),
        ],
        ["anchor", "piece_a", "piece_b", *_TEXT, "place", "begin", "end", "piece"],
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Those of the anchors that come with each text."""
    for batch in slices(batches, "text"):
        lists = batch.column("anchors")
        flat = lists.flatten()
        places = (flat.field(c).to_numpy() for c in ("place", "begin", "end"))
        yield _of_texts(batch, flat.field("anchor").to_numpy(), pc.list_parent_indices(lists).to_numpy(), *places)


def _mapped_pieces(texts: DataFrame, repeated: KeyBitmap) -> DataFrame:
    """Those of the anchors that the bitmap may hold."""
    sent = texts.sparkSession.sparkContext.broadcast(repeated)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", STEP):
            text, place, begin, end, found = anchors(*text_bytes(batch.column("text")))
            keep = np.flatnonzero(sent.value.may_hold(found))
            if len(keep):
                yield _of_texts(batch, found.view(np.int64)[keep], *[x[keep] for x in (text, place, begin, end)])

    return texts.select(*_TEXT, "text").mapInArrow(pieces, PIECE)


def _joined_pieces(texts: DataFrame, repeated: DataFrame, stash: Stash) -> DataFrame:
    """Those of the anchors in ``repeated``, joined to the texts."""
    rows = _anchor_rows(texts).join(repeated, "anchor")
    of_text = rows.groupBy(*_TEXT).agg(
        F.collect_set(F.struct("anchor", "place", "begin", "end")).alias("anchors")
    )
    of_text = stash.keep(of_text, "anchors")
    keys = of_text.select("text_a")
    few = keys.count() <= BROADCAST_KEYS
    wanted = texts.join(F.broadcast(keys) if few else keys, "text_a", "left_semi")
    return wanted.join(of_text, _TEXT).select(*_TEXT, "text", "anchors").mapInArrow(_pieces, PIECE)


def _common_prefixes(rows: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Of each row with the one before it in ``order``; 0 between groups."""
    differs = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    common[group[order[1:]] != group[order[:-1]]] = 0
    return np.concatenate([[0], common])


def repeated_starts(pieces: list[bytes], left: np.ndarray, group: np.ndarray) -> np.ndarray:
    """For each piece and each number of bytes before its anchor: does the string that starts there occur in another
    piece of the group? ``left`` has the bytes before the anchor in each piece; pieces of a group differ."""
    n = len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, n)
    rows = np.zeros((n, REACH + LENGTH), np.uint8)
    row = np.repeat(np.arange(n), sizes)
    column = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + REACH - np.repeat(left, sizes)
    rows[row, column] = np.frombuffer(b"".join(pieces), np.uint8)
    least = left - (sizes - LENGTH)
    # The sample: suffixes from the anchor on, eight bytes a column.
    sample = np.ascontiguousarray(rows[:, REACH:])
    columns = sample.view(">u8")
    order = np.lexsort((*columns.T[::-1], group))
    common = _common_prefixes(sample, order, group)
    found = np.zeros((n, REACH + 1), bool)
    for back in range(REACH + 1):
        if back:
            # Induce: by the byte before, then by the order known; one byte more in common, if that byte is.
            key = (group * 256 + rows[:, REACH - back])[order]
            moved = np.argsort(key, kind="stable")
            same = np.flatnonzero(key[moved[1:]] == key[moved[:-1]])
            between = np.stack([moved[same] + 1, moved[same + 1] + 1], axis=1).ravel()
            longer = np.zeros(n, np.int64)
            if len(same):
                longer[same + 1] = 1 + np.minimum.reduceat(np.append(common, 0), between)[::2]
            order, common = order[moved], np.minimum(longer, LENGTH)
        present = (least <= back) & (back <= left)
        run = np.cumsum(common < LENGTH) - 1
        several = np.bincount(run, present[order]) > 1
        found[order, back] = several[run]
        found[:, back] &= present
    return found


SPAN = "text_a long, text_b long, begin int, end int"


def _spans(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(text[:, 0]), pa.array(text[:, 1]), pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
        [*_TEXT, "begin", "end"],
    )


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of bytes covered by repeated strings, of pieces that one text alone has."""
    for table, starts in whole_groups(batches, ["anchor"]):
        sizes = np.diff(starts)
        take = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(take):
            continue
        table = table.take(pa.array(take))
        group = np.repeat(np.arange(len(sizes)), sizes)[take]
        n, place, begin = (table.column(c).combine_chunks().to_numpy() for c in ("n", "place", "begin"))
        found = repeated_starts(table.column("piece").to_pylist(), (place - begin).astype(np.int64), group)
        found[n > 1] = False
        # Runs of starts: strings that start at anchor - back; columns from right to left are starts from left to right.
        edges = np.diff(np.pad(found[:, ::-1].astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, first = np.nonzero(edges == 1)
        _, after = np.nonzero(edges == -1)
        text = np.stack([table.column(c).combine_chunks().to_numpy() for c in _TEXT], axis=1)[row]
        yield _spans(text, place[row] - REACH + first, place[row] - REACH + after - 1 + LENGTH)


WINDOW = "string_a long, string_b long, text_a long, text_b long, begin int, n long"


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of a piece with a 128-bit hash."""
    for batch in batches:
        for row in batch.to_pylist():
            strings = np.lib.stride_tricks.sliding_window_view(np.frombuffer(row["piece"], np.uint8), LENGTH)
            keys = b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in strings)
            key = np.frombuffer(keys, np.int64).reshape(-1, 2)
            k = len(key)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[:, 0]),
                    pa.array(key[:, 1]),
                    *[pa.array(np.full(k, row[c])) for c in _TEXT],
                    pa.array(row["begin"] + np.arange(k), pa.int32()),
                    pa.array(np.full(k, row["n"])),
                ],
                ["string_a", "string_b", *_TEXT, "begin", "n"],
            )


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        out: list[list] = [[] for _ in range(3)]
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw, gone = text.encode(), _merged(spans)
            edges = [0, *[e for span in gone for e in span], len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            row = (len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest())
            for column, value in zip(out, row, strict=True):
                column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in _TEXT], *[pa.array(o, k) for o, k in zip(out, kinds, strict=True)]],
            [*_TEXT, "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_spans(texts: DataFrame, stash: Stash, most_pieces: int = MOST_PIECES) -> DataFrame:
    """``text_a, text_b, begin, end`` of bytes that repeated strings cover, for ``texts(text_a, text_b, text)``.

    Texts should differ; a text that comes twice counts once. Spans may overlap and come more than once.
    """
    counted = _anchor_hashes(texts).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    repeated = stash.keep(counted.select("anchor"), "repeated")
    bitmap = key_bitmap(repeated, repeated.count())
    members = _joined_pieces(texts, repeated, stash) if bitmap is None else _mapped_pieces(texts, bitmap)
    members = stash.keep(members, "members")
    piece = ["anchor", "piece_a", "piece_b"]
    pieces = stash.keep(
        members.groupBy(*piece).agg(
            F.count("*").alias("n"), F.first(F.struct(*_TEXT, "place", "begin", "piece")).alias("one")
        ).select(*piece, "n", "one.*"),
        "pieces",
    )
    large = pieces.groupBy("anchor").agg(F.count("*").alias("pieces")).where(F.col("pieces") > most_pieces)
    large = stash.keep(large.select("anchor"), "large")
    induced = (
        pieces.join(large, "anchor", "left_anti").select("anchor", *_TEXT, "place", "begin", "n", "piece")
        .repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_induce, SPAN)
    )
    strings = pieces.join(large, "anchor", "left_semi").select(*_TEXT, "begin", "n", "piece").mapInArrow(_strings, WINDOW)
    strings = stash.keep(strings, "strings")
    string = ["string_a", "string_b"]
    twice = stash.keep(
        strings.groupBy(*string).agg(F.sum("n").alias("times")).where("times > 1").select(*string), "twice"
    )
    split = strings.where("n = 1").join(twice, string).select(*_TEXT, "begin", (F.col("begin") + LENGTH).alias("end"))
    copied = pieces.where("n > 1").select(*piece)
    whole = members.drop("piece", "place").join(copied, piece).select(*_TEXT, "begin", (F.col("end") + LENGTH).alias("end"))
    return induced.unionAll(split).unionAll(whole)


def remove_repeats(docs: DataFrame, most_pieces: int = MOST_PIECES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row, texts as UTF-8 bytes.

    A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else, in the same text or
    another. Strings are judged on the texts as given.
    """
    stash = Stash(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_a"),
        F.xxhash64(F.lit("text"), text).alias("text_b"),
    )
    known = stash.keep(
        rows.select(
            "doc_id", *_TEXT, F.octet_length("text").cast("long").alias("n_bytes"),
            F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
        ),
        "texts",
    )
    long_ones = known.where(F.col("n_bytes") >= LENGTH)
    copied = long_ones.groupBy(*_TEXT).agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).where("n > 1")
    copied = stash.keep(copied.drop("n"), "copied")
    again = stash.keep(known.join(copied, _TEXT).where("doc_id <> least").select("doc_id", "text_a").distinct(), "again")
    few = again.count() <= BROADCAST_KEYS
    again = again.withColumnRenamed("doc_id", "_id")
    same = (F.col("doc_id") == F.col("_id")) & (rows["text_a"] == again["text_a"])
    distinct = rows.where(F.octet_length("text") >= LENGTH).join(F.broadcast(again) if few else again, same, "left_anti")
    texts = distinct.select(*_TEXT, "text")
    spans = repeated_spans(texts, stash, most_pieces).join(copied.select(*_TEXT), _TEXT, "left_anti")
    of_text = stash.keep(spans.groupBy(*_TEXT).agg(F.collect_set(F.struct("begin", "end")).alias("spans")), "spans")
    keys = of_text.select("text_a")
    wanted = texts.join(F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys, "text_a", "left_semi")
    cut = wanted.join(of_text, _TEXT).select(*_TEXT, "text", "spans").mapInArrow(
        _cut, "text_a long, text_b long, n_removed long, n_spans long, kept_sha256 string"
    )
    nothing = hashlib.sha256(b"").hexdigest()
    gone = copied.select(
        *_TEXT, F.lit(-1).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(nothing).alias("kept_sha256"),
    )
    changed = stash.keep(cut.dropDuplicates(_TEXT).unionAll(gone), "changed")
    stash.keep_only(known, changed)
    removed = F.when(F.col("n_removed") < 0, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0)))
    return known.join(changed, _TEXT, "left").select(
        "doc_id", "n_bytes", removed.cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
    )
