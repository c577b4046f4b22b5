"""The corpus pipeline: operators for training data applied one after the other to ``documents``.

Every stage but the last returns the columns of its documents, columns that an operator uses itself included.

Each stage takes what the one before has kept and returns the columns of ``documents``; the last returns the pieces of
packed sequences. SQL can express neither the model of the first stage nor the tokenizer of the last, so there is none.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loanlake.llm import decontamination, line_dedup, ngram_jaccard, packing, quality
from loanlake.llm.stash import Stash

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that break a base rule or lie outside of the perplexity bands of their language.

    NULL and empty texts go; rows that repeat, and rows without an id, are judged each. An empty table stays empty.
    """
    return quality.keep_good(docs)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that several documents have, but for the last of these.

    NULL and empty texts have one empty line, which is too short to go.
    """
    return line_dedup.without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id; one without an id if none has one.

    Of rows that repeat, one stays. Documents without words have no copies.
    """
    return ngram_jaccard.keep_one_of_each_class(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold most of an item of ``benchmark``, in whatever order. NULL and empty texts hold none."""
    return decontamination.without_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens; a NULL or empty text is its end token."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("repeated_lines", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("packed_sequences", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage has kept is written and read again by the next."""
    stash = Stash(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash.keep(stage(spark, docs, sf_dir), name)
        stash.keep_only(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
