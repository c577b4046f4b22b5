"""Registered queries against their SQL, or against brute force where SQL cannot express them."""

import glob
import os

import duckdb
import public_tokenizers
import pytest
from conftest_llm import by_id
from test_ngram_jaccard import brute as brute_links
from test_packing import check as check_packing
from test_quality import brute_judged

import __spark_entry__ as registered
import corpus_pipeline
from loanlake.llm import queries

SQL = queries.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return connection


def test_all_are_registered():
    names = registered.queries()
    assert [n for n in range(1, 14) if sum(x.startswith(f"op{n}_") for x in names) != 1] == []
    assert "pipeline" in names and set(SQL) <= set(names)


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, sf_dir, database, name):
    found = queries.queries()[name](spark, sf_dir)
    answer = database.execute(SQL[name])
    names = [c[0] for c in answer.description]
    assert sorted(found.columns) == sorted(names)
    want = sorted(str(tuple(row[names.index(c)] for c in sorted(names))) for row in answer.fetchall())
    assert sorted(str(tuple(r)) for r in found.select(*sorted(names)).collect()) == want


def test_columns_of_the_contracts(spark, sf_dir):
    wanted = {
        2: {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
        3: {"doc_id", "n_lines", "n_dropped", "kept_sha256"},
        4: {"doc_id", "start", "n_tokens", "ids_crc32"},
        7: {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
        8: {"page_id", "host", "path", "rule", "verdict"},
        9: {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
        10: {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
        11: {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
        12: {"anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"},
        13: {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"},
    }
    for name, query in queries.queries().items():
        n = int(name[2:].split("_")[0])
        if n in wanted:
            kinds = dict(query(spark, sf_dir).dtypes)
            assert wanted[n] <= set(kinds), name
            whole = {c for c in wanted[n] if kinds[c] == "int"}
            assert whole <= {"shard", "grown_shard", "rank"}, (name, whole)


def brute_stages(spark, sf_dir, database):
    """What each stage keeps, by plain Python and SQL: ids and texts."""
    docs = sorted(map(tuple, spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text").collect()))
    _, _, kept = brute_judged(docs)
    docs = [(i, t) for (i, _, t), k in zip(docs, kept, strict=True) if k]
    yield docs
    from test_line_dedup import SPACES

    def key(line):
        return line.strip(SPACES).translate({c: c + 32 for c in range(65, 91)})

    held = {}
    for i, text in docs:
        for k in {key(x) for x in text.split("\n")}:
            held.setdefault(k, []).append(i)
    docs = [
        (i, "\n".join(x for x in t.split("\n") if len(k := key(x)) < 40 or len(held[k]) < 5 or max(held[k]) == i))
        for i, t in docs
    ]
    yield docs
    least = {i: c for i, c, _ in brute_links(docs)}
    docs = [(i, t) for i, t in docs if least[i] == i]
    yield docs
    from conftest_llm import words

    items = [words(t) for _, t in database.execute("SELECT item_id, text FROM benchmark").fetchall()]

    def covered(item, text):
        grams = {tuple(text[k : k + 5]) for k in range(len(text) - 4)}
        return len({k + d for k in range(len(item) - 4) if tuple(item[k : k + 5]) in grams for d in range(5)})

    yield [(i, t) for i, t in docs if all(2 * covered(x, words(t)) < len(x) for x in items)]


def test_pipeline(spark, sf_dir, database, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, stages = docs.columns, brute_stages(spark, sf_dir, database)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        rows = sorted((i, x[0]["text"]) for i, x in by_id(docs).items())
        assert rows == next(stages), name
        assert all(len(r["text"]) == r["n_chars"] for r in docs.collect())
    found = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    check_packing(rows, found, 2048)
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, found))


EDGES = {
    # Which ids a stage keeps of the edge rows, whatever the rows' other columns.
    "quality_rules": lambda i: i in (None, 4, 5, 6, 10, 11, 12, 13, 14, 15, 16),
    "repeated_lines": lambda i: True,
    "near_duplicates": lambda i: i not in (5, 6, 9, 12, 13, 14, 15),
    "benchmark_passages": lambda i: True,
}


@pytest.mark.parametrize("name", EDGES)
def test_stages_on_edge_rows(spark, edges, nothing, sf_dir, name):
    """NULL ids and texts, empty and long texts, repeated rows, clashing columns, and an empty table."""
    stage = dict(corpus_pipeline.STAGES)[name]
    kept = stage(spark, edges, sf_dir)
    assert kept.columns == edges.columns
    assert {r["doc_id"] for r in kept.collect()} <= {r["doc_id"] for r in edges.collect() if EDGES[name](r["doc_id"])}
    assert stage(spark, nothing, sf_dir).count() == 0


def test_last_stage_on_edge_rows(spark, edges, nothing, sf_dir):
    pack = corpus_pipeline.STAGES[-1][1]
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    check_packing(rows, pack(spark, edges, sf_dir).collect(), 2048)
    assert pack(spark, nothing, sf_dir).count() == 0


def test_tokenizer_is_not_copied():
    assert queries.TOKENIZER == public_tokenizers.path("word_bpe_49k.json")
