"""How well the characters of a text follow from those before them in other texts of its language.

A modified Kneser-Ney model of runs of ``ORDER`` characters, one per language. Characters are folded to 64 symbols, so a
run is a number of 36 bits, exact and not a hash that could clash. Runs are counted by Spark over all texts: tasks add up
what they have seen, and the runs, which grow with the corpus, are tables of a row per run; no executor counts alone and
none has to hold a table whole. Lower orders count the different symbols before a run.

Texts are dealt into two halves, and a text is scored by the counts of the half it isn't in: most long runs are found
once or twice, and a text would be its own best evidence. So would its copies: the half follows from the least hash of a
text's words, which exact copies share and near copies share nearly always.

For scoring, runs with their probabilities in either half are sorted arrays per language that are sent to executors, if
there are no more than ``BROADCAST_RUNS``. Beyond that the different runs of each text are joined to the table, which
gives the same values.

Defined cases: the first runs of a text begin with edge marks. A context never seen in the other half leaves all weight
to the shorter run, and a symbol never seen there has an equal share of what order one leaves. A NULL or empty text has
no score. A NULL language is a language of its own.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.llm.stash import Stash
from loanlake.llm.tokens import release_encoders, release_memory
from loanlake.llm.words import mix, slices, split_words, text_bytes

ORDER = 6
BITS = 6
SYMBOLS = 1 << BITS
HALVES = (0, 1)
#: Runs that are sent to executors, at 16 bytes each; more are joined by a shuffle.
BROADCAST_RUNS = 8_000_000
#: Different runs that a task holds before it passes them on, and bytes of text that it looks at together: some forty
#: bytes of arrays for each.
HELD_RUNS = 1_500_000
BATCH_BYTES = 1_000_000

_EDGE, _SPACE, _OTHER = 0, 1, 2
_MARKS = b".,;:!?'-"
_FOLD = np.full(256, _OTHER, np.int64)
_FOLD[[0x20, *range(0x09, 0x0E)]] = _SPACE
for _first in b"Aa":
    _FOLD[_first : _first + 26] = 3 + np.arange(26)
_FOLD[ord("0") : ord("9") + 1] = 29 + np.arange(10)
_FOLD[list(_MARKS)] = 39 + np.arange(len(_MARKS))
_FOLD[128:] = 48 + np.arange(128) % 16


def language_key() -> Column:
    return F.xxhash64("lang").alias("lang_key")


def halves(column: pa.Array) -> np.ndarray:
    """The half of each text; 0 for one without words."""
    words = split_words(column)
    out = np.zeros(len(words.first) - 1, np.int64)
    some = np.flatnonzero(np.diff(words.first))
    if len(some):
        least = np.minimum.reduceat(mix(words.hashes ^ np.uint64(0x51ED270B)), words.first[some])
        out[some] = (least >> np.uint64(20)).astype(np.int64) & 1
    return out


def codes(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The run that ends at each byte of each text, the last symbol in the lowest bits."""
    lead, sizes = ORDER - 1, np.diff(first)
    inside = np.ones(len(data) + lead * len(sizes), bool)
    inside[(first[:-1] + lead * np.arange(len(sizes)))[:, None] + np.arange(lead)] = False
    stream = np.full(len(inside), _EDGE, np.int64)
    stream[inside] = _FOLD[data]
    out = stream.copy()
    for back in range(1, ORDER):
        out[back:] |= stream[:-back] << (BITS * back)
    return out[inside]


def _numbered(languages: list[int], known: dict[int, int]) -> np.ndarray:
    return np.array([known.setdefault(x, len(known)) for x in languages], np.int64)


def count_runs(docs: DataFrame) -> DataFrame:
    """``lang_key, code, c0, c1``: how often each run is in the texts of either half."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        known: dict[int, int] = {}
        held, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def add_up() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([held, *[k for k, _ in waiting]]), return_inverse=True)
            total = np.bincount(at, np.concatenate([sums, *[n for _, n in waiting]]), minlength=len(keys))
            waiting.clear()
            return keys, total.astype(np.int64)

        def rows() -> pa.RecordBatch:
            group, code = held >> (BITS * ORDER), held & ((1 << BITS * ORDER) - 1)
            languages = np.array(list(known), np.int64)[group >> 1]
            arrays = [languages, (group & 1).astype(np.int32), code, sums]
            return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["lang_key", "half", "code", "n"])

        for batch in slices(batches, "text", BATCH_BYTES):
            text = batch.column("text")
            data, first = text_bytes(text)
            group = _numbered(batch.column("lang_key").to_pylist(), known) * 2 + halves(text)
            found, n = np.unique(codes(data, first) | np.repeat(group << (BITS * ORDER), np.diff(first)), return_counts=True)
            waiting.append((found, n))
            if sum(len(k) for k, _ in waiting) > HELD_RUNS // 2:
                held, sums = add_up()
                if len(held) > HELD_RUNS:
                    yield rows()
                    held, sums, known = held[:0].copy(), sums[:0].copy(), {}
        held, sums = add_up()
        yield rows()
        held, sums = held[:0].copy(), sums[:0].copy()
        release_memory()

    parts = docs.select(language_key(), "text").mapInArrow(count, "lang_key long, half int, code long, n long")
    of_half = [F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"c{h}") for h in HALVES]
    return parts.groupBy("lang_key", "code").agg(*of_half)


def discounts(counts: DataFrame) -> DataFrame:
    """``lang_key`` and for each half ``h`` and ``k`` of 1 to 3, ``off{h}_{k}``: what is taken off counts of 1, 2 and
    3 or more, from how many runs have counts of 1 to 4. At least a tenth."""
    of = counts.groupBy("lang_key").agg(
        *[F.count_if(F.col(f"c{h}") == k).cast("double").alias(f"n{h}_{k}") for h in HALVES for k in range(1, 5)]
    )

    def off(h: int, k: int) -> Column:
        n = [None, *[F.col(f"n{h}_{i}") for i in range(1, 5)]]
        # A count of 0 divides nothing: the fallback is taken then, and NULL is the value of x / 0 without ANSI mode.
        safe = [None, *[F.greatest(x, F.lit(1.0)) for x in n[1:]]]
        y = n[1] / (safe[1] + 2 * n[2])
        found = k - (k + 1) * y * n[k + 1] / safe[k]
        clipped = F.least(F.greatest(found, F.lit(0.1)), F.lit(float(k)))
        return F.when(F.least(*n[1:]) == 0, F.lit(0.5 * k)).otherwise(clipped).alias(f"off{h}_{k}")

    return of.select("lang_key", *[off(h, k) for h in HALVES for k in (1, 2, 3)])


def _probabilities(counts: DataFrame, lower: DataFrame | None, stash: Stash, order: int) -> DataFrame:
    """``lang_key, code, p0, p1`` of the last symbol of each run after the others; ``lower`` has those of its end."""
    off = stash.keep(discounts(counts), f"discounts{order}")
    rows = counts.join(F.broadcast(off), "lang_key")  # a row per language
    for h in HALVES:
        c = F.col(f"c{h}")
        taken = F.when(c == 0, 0.0).when(c == 1, F.col(f"off{h}_1")).when(c == 2, F.col(f"off{h}_2"))
        rows = rows.withColumn(f"d{h}", taken.otherwise(F.col(f"off{h}_3")))
    context, shorter = F.shiftright("code", BITS), F.col("code").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1))
    rows = rows.select("lang_key", "code", "c0", "c1", "d0", "d1", context.alias("context"), shorter.alias("shorter"))
    totals = rows.groupBy("lang_key", "context").agg(*[F.sum(f"{x}{h}").alias(f"{x}{h}_all") for x in "cd" for h in HALVES])
    joined = rows.join(totals, ["lang_key", "context"])
    if lower is None:
        joined = joined.withColumns({f"lower{h}": F.lit(1 / SYMBOLS) for h in HALVES})
    else:
        below = lower.select("lang_key", F.col("code").alias("shorter"), *[F.col(f"p{h}").alias(f"lower{h}") for h in HALVES])
        joined = joined.join(below, ["lang_key", "shorter"])

    def p(h: int) -> Column:
        c, d, total, left, low = (F.col(x) for x in (f"c{h}", f"d{h}", f"c{h}_all", f"d{h}_all", f"lower{h}"))
        return F.when(total > 0, (c - d + left * low) / total).otherwise(low).alias(f"p{h}")

    return stash.keep(joined.select("lang_key", "code", p(0), p(1)), f"model{order}")


def fit(docs: DataFrame, stash: Stash) -> DataFrame:
    """``lang_key, code, p0, p1``: all runs, and the probability of their last symbol by the counts of either half."""
    kinds = [F.count_if(F.col(f"c{h}") > 0).alias(f"c{h}") for h in HALVES]
    counts = {ORDER: stash.keep(count_runs(docs), f"runs{ORDER}")}
    for order in range(ORDER - 1, 0, -1):
        end = F.col("code").bitwiseAND(F.lit((1 << BITS * order) - 1)).alias("code")
        counts[order] = stash.keep(counts[order + 1].groupBy("lang_key", end).agg(*kinds), f"runs{order}")
    model = None
    for order in range(1, ORDER + 1):
        model = _probabilities(counts[order], model, stash, order)
    return model


#: Bits of a place among the runs that are looked up together; a run and a place fit into a signed number.
_AT_BITS = 63 - BITS * ORDER


def _looked_up(run: np.ndarray, log: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The entry of ``log`` for each wanted run, all of which are in ``run``. Each different one is searched once, in
    order, so that the search stays near where it was: in a table beyond the caches others wait for memory."""
    ranked = np.sort(wanted << _AT_BITS | np.arange(len(wanted)))
    place = ranked & ((1 << _AT_BITS) - 1)
    ranked >>= _AT_BITS
    new = np.flatnonzero(np.diff(ranked, prepend=-1))
    out = np.empty(len(wanted), log.dtype)
    out[place] = np.repeat(log[np.searchsorted(run, ranked[new])], np.diff(new, append=len(ranked)))
    return out


class SortedRuns:
    """Per language the sorted runs and the logarithms of their probabilities in either half."""

    def __init__(self, model: DataFrame):
        table = model.toArrow().combine_chunks()
        languages, run = table["lang_key"].to_numpy(), table["code"].to_numpy()
        order = np.lexsort((run, languages))
        languages, run = languages[order], run[order]
        logs = [np.log(table[f"p{h}"].to_numpy()[order]).astype(np.float32) for h in HALVES]
        names, starts = np.unique(languages, return_index=True)
        ends = np.append(starts[1:], len(run))[: len(names)]
        self._of = {int(x): (run[a:b], logs[0][a:b], logs[1][a:b]) for x, a, b in zip(names, starts, ends, strict=True)}

    def log_perplexities(self, text: pa.Array, languages: list[int]) -> np.ndarray:
        """Of each text, the mean over its bytes; NaN for one without any."""
        data, first = text_bytes(text)
        own, half, sizes = codes(data, first), halves(text), np.diff(first)
        values, of = np.zeros(len(own), np.float32), np.array(languages, np.int64)
        for language in np.unique(of[sizes > 0]).tolist():
            for h in HALVES:
                run, log = self._of[language][0], self._of[language][2 - h]
                where = np.flatnonzero(np.repeat((of == language) & (half == h), sizes))
                for begin in range(0, len(where), 1 << _AT_BITS):
                    here = where[begin : begin + (1 << _AT_BITS)]
                    values[here] = _looked_up(run, log, own[here])
        out = np.full(len(sizes), np.nan)
        for i in np.flatnonzero(sizes):
            out[i] = -values[first[i] : first[i + 1]].mean(dtype=np.float64)
        return out


def joined_log_perplexities(docs: DataFrame, model: DataFrame) -> DataFrame:
    """``text_hash, lang_key, log_perplexity`` of every different text with bytes, by a join of its different runs."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            text = batch.column("text")
            data, first = text_bytes(text)
            own, half = codes(data, first), halves(text)
            for i in np.flatnonzero(np.diff(first)):
                found, n = np.unique(own[first[i] : first[i + 1]], return_counts=True)
                keys = [np.full(len(found), batch.column(c)[i].as_py(), np.int64) for c in ("text_hash", "lang_key")]
                arrays = [*keys, np.full(len(found), half[i], np.int32), found, n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["text_hash", "lang_key", "half", "code", "n"])

    wanted = docs.select(F.xxhash64("text").alias("text_hash"), language_key(), "text").dropDuplicates(["text_hash", "lang_key"])
    found = wanted.mapInArrow(rows, "text_hash long, lang_key long, half int, code long, n long").join(model, ["lang_key", "code"])
    p = F.when(F.col("half") == 0, F.col("p1")).otherwise(F.col("p0"))
    sums = found.groupBy("text_hash", "lang_key").agg(F.sum(F.col("n") * F.log(p)).alias("log"), F.sum("n").alias("n"))
    return sums.select("text_hash", "lang_key", (-F.col("log") / F.col("n")).alias("log_perplexity"))
