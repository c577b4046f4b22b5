"""Line dedup with levelled sorted runs of line hashes.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z in lower case, as two 64-bit hashes.
Documents are worked off in batches from the largest id to the smallest. Each batch is merge-anti-joined with the
runs: keys that no run has are new, the batch keeps them in its largest document that holds them, and adds them as a
sorted run of its own. When a level has ``fanout`` runs they are merged into one run of the next level. Only DataFrame
functions are used.

Defined cases: a NULL or empty text is one empty line. Rows are documents, so repeated rows count each; rows that
share the largest id of a key all keep it. NULL ids come last; they count, and keep a key only if no other id has it.
Extra columns are kept as they are, or ignored where ids are returned.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.llm.stash import Stash

_SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["hi", "lo"]
#: Frequent keys are broadcast up to this count (16 bytes each); beyond it they are joined by a shuffle.
BROADCAST_KEYS = 500_000
#: Positions of lines to drop are broadcast up to this count (some 40 MB with their documents); beyond it texts are
#: shuffled to meet them.
BROADCAST_LINES = 500_000


class LineRuns:
    """Sorted runs of line keys in levels; a key is in one run only."""

    def __init__(self, stash: Stash, fanout: int = 3):
        self._stash = stash
        self._fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def all(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        return reduce(DataFrame.unionAll, runs) if runs else None

    def _add(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._stash.keep(run.sortWithinPartitions(*KEY), f"run-level{level}"))
        if len(self.levels[level]) >= self._fanout:
            merged = reduce(DataFrame.unionAll, self.levels[level])
            self.levels[level] = []
            self._add(merged.repartition(*KEY), level + 1)

    def add(self, lines: DataFrame) -> None:
        """Add the keys of ``lines(hi, lo, doc_id)`` that no run has, each with its largest document."""
        known = self.all()
        new = lines if known is None else lines.join(known.select(*KEY), KEY, "left_anti")
        self._add(new.groupBy(*KEY).agg(F.max("doc_id").alias("keeper")), 0)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACES)), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("hi"), F.xxhash64(F.lit("line"), key).alias("lo")]


def _long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row per line of at least so many code points: ``doc_id, text_hash, at, hi, lo``."""
    stripped = F.btrim(F.col("line"), F.lit(_SPACES))
    return (
        docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("at", "line"))
        .where(F.length(stripped) >= min_chars)
        .select("doc_id", "text_hash", "at", *_hashes(line_key(F.col("line"))))
    )


def _batches(lines: DataFrame, n: int) -> list[DataFrame]:
    """The lines in parts of about as many rows, from the largest ids to the smallest."""
    shares = [i / n for i in range(1, n)]
    cuts = sorted({int(x) for x in lines.approxQuantile("doc_id", shares, 0.01)}, reverse=True) if shares else []
    doc, parts, above = F.col("doc_id"), [], None
    for cut in cuts:
        inside = doc > cut if above is None else (doc > cut) & (doc <= above)
        parts.append(lines.where(inside))
        above = cut
    rest = F.lit(True) if above is None else doc <= above
    return [*parts, lines.where(rest | doc.isNull())]


def dropped_lines(
    docs: DataFrame, stash: Stash, min_chars: int = 40, min_docs: int = 5, batches: int = 4
) -> DataFrame:
    """``doc_id, text_hash, dropped``: the positions of lines to drop, for documents that lose any."""
    lines = _long_lines(docs, min_chars)
    held = docs.select(F.explode(F.array_distinct(_row_keys(min_chars))).alias("k")).select("k.hi", "k.lo")
    counted = held.groupBy(*KEY).agg(F.count("*").alias("n_docs"))
    frequent = stash.keep(counted.where(F.col("n_docs") >= min_docs).select(*KEY), "frequent")
    small = frequent.count() <= BROADCAST_KEYS
    repeated = stash.keep(lines.join(F.broadcast(frequent) if small else frequent, KEY), "repeated")
    runs = LineRuns(stash)
    for batch in _batches(repeated, batches):
        runs.add(batch.select(*KEY, "doc_id"))
    gone = repeated.join(runs.all(), KEY).where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return gone.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("dropped"))


def _row_keys(min_chars: int) -> Column:
    """Hash pairs of the row's lines that are long enough."""
    stripped = F.transform(_lines(F.col("text")), lambda x: F.btrim(x, F.lit(_SPACES)))
    long_ones = F.filter(stripped, lambda x: F.length(x) >= min_chars)
    return F.transform(long_ones, lambda x: F.struct(*_hashes(F.translate(x, _UPPER, _LOWER))))


def dedup_texts(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4) -> DataFrame:
    """``row, doc_id, text, kept_text, n_lines, n_dropped`` of every row; ``row`` holds its columns.

    Lines whose key has at least ``min_chars`` code points and is found in at least ``min_docs`` documents are
    dropped, except in the largest ``doc_id`` that holds the key. Other lines stay, joined by line breaks.
    """
    stash = Stash(docs.sparkSession)
    gone = stash.keep(dropped_lines(docs.select("doc_id", "text"), stash, min_chars, min_docs, batches), "dropped")
    stash.keep_only(gone)
    n_dropped = gone.agg(F.sum(F.size("dropped")).alias("n")).first()["n"] or 0
    gone = gone.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), "dropped")
    if n_dropped <= BROADCAST_LINES:
        gone = F.broadcast(gone)
    lines, n = _lines(F.col("text")), F.size(_lines(F.col("text")))
    kept = F.array_except(F.sequence(F.lit(0), n - 1), "dropped")
    joined = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & F.xxhash64("text").eqNullSafe(F.col("_hash"))
    return docs.select(F.struct("*").alias("row"), "doc_id", "text").join(gone, same, "left").select(
        "row", "doc_id", "text",
        F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(joined).alias("kept_text"),
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 4) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""
    done = dedup_texts(docs.select("doc_id", "text"), min_chars, min_docs, batches)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines dropped from ``text``; ``n_chars`` follows. Texts that lose nothing stay as they are."""
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    own = {c: F.col("row").getField(c) for c in docs.columns}
    columns = [F.when(changed, new[c]).otherwise(own[c]) if c in new else own[c] for c in docs.columns]
    return dedup_texts(docs).select(*[x.alias(c) for x, c in zip(columns, docs.columns, strict=True)])
