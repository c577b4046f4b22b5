"""Registered queries of the operators: name, query, and SQL where SQL can express it."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlake.llm import alignment, compact_windows, decontamination, hard_negatives, licenses, line_dedup, ngram_jaccard, packing, quality, sharding, suffix_dedup, token_file, url_rules

Query = Callable[[SparkSession, str], DataFrame]

LISTED_RULES = [
    url_rules.ListedRule("block", "net", "/"),
    url_rules.ListedRule("allow", "example.net", "/en/"),
    url_rules.ListedRule("block", "example.com", "/de/"),
    url_rules.ListedRule("allow", "org", "/fr/"),
]

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ALIGNED = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.link_documents(_documents(spark, sf_dir)).drop("text_hash")


def consistent_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(_documents(spark, sf_dir), n_shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def line_dedup_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(_documents(spark, sf_dir))


def packed_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.encode_and_read_back(_documents(spark, sf_dir), TOKENIZER)


def minimum_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir), TOKENIZER)


def string_tiling_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def compact_window_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.find_passages(_documents(spark, sf_dir))


def induced_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_documents(spark, sf_dir))


def association_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_rules.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), labels, LISTED_RULES)


def kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return judged.drop("text_hash", "lang")


def suffix_automaton_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir)).drop("spans")


def spanning_tree_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_hard_negatives(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_documents(spark, sf_dir), *ALIGNED)


def queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard_join": ngram_jaccard_join,
        "op2_consistent_hash_shards": consistent_hash_shards,
        "op3_line_dedup_runs": line_dedup_runs,
        "op4_packed_token_files": packed_token_files,
        "op5_string_tiling_decontamination": string_tiling_decontamination,
        "op6_compact_window_passages": compact_window_passages,
        "op7_induced_suffix_dedup": induced_suffix_dedup,
        "op8_association_url_filter": association_url_filter,
        "op9_minimum_bin_slack_packing": minimum_bin_slack_packing,
        "op10_kneser_ney_quality": kneser_ney_quality,
        "op11_suffix_automaton_licenses": suffix_automaton_licenses,
        "op12_spanning_tree_hard_negatives": spanning_tree_hard_negatives,
        "op13_cross_tokenizer_alignment": cross_tokenizer_alignment,
    }


_LINE_KEY = r"translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id,
        unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
    FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y, h.n = a.n AND h.n = b.n AS equal
    FROM shared h JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 5 * h.n >= 4 * (a.n + b.n - h.n)),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other)
SELECT doc_id, min(other) AS class_id,
    least(doc_id, coalesce((SELECT min(y) FROM links WHERE x = doc_id AND equal), doc_id)) AS copy_id,
    (SELECT count(*) FROM links WHERE x = doc_id) AS n_links
FROM reached GROUP BY doc_id""",
        "op3_line_dedup_runs": f"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS line_no
    FROM documents),
keyed AS (SELECT doc_id, line_no, line, {_LINE_KEY} AS line_key FROM lines),
frequent AS (
    SELECT line_key, max(doc_id) AS keeper FROM keyed WHERE length(line_key) >= 40
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
    SELECT k.doc_id, k.line_no, k.line, f.keeper IS NOT NULL AND f.keeper <> k.doc_id AS gone
    FROM keyed k LEFT JOIN frequent f USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    }
