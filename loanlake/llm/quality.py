"""Quality rules: counts of a text, and its perplexity under a modified Kneser-Ney model of its language.

The model is described in ``kneser_ney``. Each language has a lower and an upper band of perplexity around the median of
its own texts; texts outside are rejected: above, what other texts of the language are not written like; below, what they
say over and over.

Defined cases: a NULL or empty text has no words and fails the base rules; it has no perplexity. A NULL language is a
language of its own. Repeated rows are judged each. Extra columns are ignored. An empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.llm import kneser_ney
from loanlake.llm.stash import Stash
from loanlake.llm.tokens import release_memory
from loanlake.llm.words import Words, mix, shingles, slices, split_words, text_bytes

#: Rejected rows are broadcast up to this count; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 500_000
_SPACES = np.array([0x20, *range(0x09, 0x0E)])

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CHARACTER = (np.arange(256) & 0xC0) != 0x80  # bytes that start a character
_CHARACTER[_SPACES] = False


def _per_text(marks: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(marks)])
    return sums[first[1:]] - sums[first[:-1]]


def _repeated_words(words: Words) -> np.ndarray:
    """Words of each text that lie in a run of three words found twice or more in the text."""
    covered = np.zeros(len(words.hashes), bool)
    runs = shingles(words.hashes, 3)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    inside = np.flatnonzero(text[: len(runs)] == text[2:])
    keys = mix(runs[inside] ^ mix(text[inside].astype(np.uint64)))
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.zeros(len(keys), bool)
    equal = ranked[1:] == ranked[:-1]
    same[1:] |= equal
    same[:-1] |= equal
    twice = inside[order[same]]
    for i in range(3):
        covered[twice + i] = True
    return _per_text(covered, words.first)


def _duplicate_lines(column: pa.Array) -> list[int]:
    out = []
    for text in pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary()).to_pylist():
        lines = [line for line in text.split(b"\n") if line.strip()]
        out.append(len(lines) - len(set(lines)))
    return out


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def score(docs: DataFrame, model: DataFrame, broadcast_runs: int) -> DataFrame:
    """``doc_id, lang, text_hash``, the counts, and ``log_perplexity``, the mean over the bytes of a text."""
    sent = model.count() <= broadcast_runs
    table = docs.sparkSession.sparkContext.broadcast(kneser_ney.SortedRuns(model)) if sent else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", kneser_ney.BATCH_BYTES):
            text = batch.column("text")
            words = split_words(text, fold=False)
            data, first = text_bytes(text)
            counts = [
                np.diff(words.first),
                _per_text(_CHARACTER[data], first),
                _per_text(_SYMBOL[data], first),
                _duplicate_lines(text),
                _repeated_words(words),
            ]
            log = np.full(len(counts[0]), np.nan)
            if table:
                log = table.value.log_perplexities(text, batch.column("lang_key").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "lang", "lang_key", "text_hash")]
                + [pa.array(c, pa.int64()) for c in counts]
                + [pa.array(log, mask=np.isnan(log))],
                ["doc_id", "lang", "lang_key", "text_hash", *COUNTS, "log_perplexity"],
            )
        release_memory()

    wanted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        kneser_ney.language_key(), F.xxhash64("text").alias("text_hash"), "text",
    )
    kinds = ", ".join(f"{c} long" for c in COUNTS)
    schema = f"doc_id long, lang string, lang_key long, text_hash long, {kinds}, log_perplexity double"
    scored = wanted.mapInArrow(rows, schema)
    if not sent:
        logs = kneser_ney.joined_log_perplexities(docs, model)
        scored = scored.drop("log_perplexity").join(logs, ["text_hash", "lang_key"], "left")
    return scored.drop("lang_key")


def base_failed(min_words: int = 50, most_repeated: int = 50) -> Column:
    """Too few words, or more than so many percent of them in repeated runs."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def _short_text_factor(steady: int) -> Column:
    """How much further than a long text's a text's perplexity strays by chance."""
    return F.sqrt(1 + steady / F.greatest(F.col("word_chars"), F.lit(1)))


def bands(scored: DataFrame, least_spread: float, steady: int) -> DataFrame:
    """``_lang, middle, spread``: the median log perplexity of a language's texts and how far texts are from it.

    The spread is the median distance from the median, scaled as for a normal distribution. Both medians are merged
    from sketches of all texts of a language, so a language with most texts is no single task's work.
    """
    column = "log_perplexity"
    judged = scored.where(~F.col("base_failed") & F.col(column).isNotNull())
    middle = judged.groupBy("lang").agg(F.percentile_approx(column, 0.5, 10_000).alias("middle"))
    middle = middle.select(F.col("lang").alias("_lang"), "middle")
    distance = F.abs(F.col(column) - F.col("middle")) / _short_text_factor(steady)
    far = judged.join(middle, F.col("lang").eqNullSafe(F.col("_lang"))).groupBy("_lang").agg(
        F.first("middle").alias("middle"), F.percentile_approx(distance, 0.5, 10_000).alias("distance")
    )
    return far.select("_lang", "middle", F.greatest(F.lit(least_spread), F.col("distance") / 0.6745).alias("spread"))


def judge(
    docs: DataFrame,
    width: float = 5.0,
    least_spread: float = 0.01,
    steady: int = 1000,
    broadcast_runs: int = kneser_ney.BROADCAST_RUNS,
) -> DataFrame:
    """Every text's ``doc_id``, counts, ``base_failed`` and ``kept``, then ``lang, text_hash``, its perplexity and the
    bands that apply to it.

    The bands lie ``width`` spreads of the language below and above its median. They are wider for short texts, by a
    half at about ``steady`` characters.
    """
    stash = Stash(docs.sparkSession)
    model = kneser_ney.fit(docs, stash)
    stash.keep_only(model)
    scored = stash.keep(score(docs, model, broadcast_runs).withColumn("base_failed", base_failed()), "scored")
    limits = stash.keep(bands(scored, least_spread, steady), "bands")
    stash.keep_only(scored, limits)
    far = width * _short_text_factor(steady) * F.col("spread")
    judged = scored.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumns(
        {"lower": F.col("middle") - far, "upper": F.col("middle") + far}
    )
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower"), F.col("upper")), F.lit(True))
    return judged.select(
        "doc_id", *COUNTS, "base_failed", (~F.col("base_failed") & inside).alias("kept"), "lang", "text_hash",
        F.exp("log_perplexity").alias("perplexity"),
        F.exp("lower").alias("lowest_perplexity"), F.exp("upper").alias("highest_perplexity"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that the rules or the bands reject, found again by id, language and text."""
    judged = judge(docs.select("doc_id", "lang", "text"))
    own = ["doc_id", "lang", "text_hash"]
    out = judged.where(~F.col("kept")).select(*[F.col(c).alias(f"_{c}") for c in own]).distinct()
    out = Stash(docs.sparkSession).keep(out, "rejected")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "lang", F.xxhash64("text").alias("text_hash"))
    same = F.lit(True)
    for c in own:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    few = out.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(out) if few else out, same, "left_anti").select("row.*")
