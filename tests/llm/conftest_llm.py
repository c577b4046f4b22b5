import re

import public_tokenizers
import pytest

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Columns with names that the operators use inside.
CLASHING = ["row", "n", "_id", "_key", "key", "keys", "text_hash", "line", "dropped", "shard", "slot", "band", "bands",
            "block", "x", "y", "anchor", "spans", "code", "bad", "tokens", "length", "_salt", "component", "signature"]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, fold=True):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found] if fold else found


def shingle_set(text, size=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < size else [tuple(w[i : i + size]) for i in range(len(w) - size + 1)])


def edge_texts():
    """Ids and texts with nulls, empty and long texts, copies, repeated rows and texts of one word over and over."""
    some = " ".join(f"word{i} and{i % 7}" for i in range(60))
    near = some.replace("word30", "other")
    lines = "\n".join([f"this line is long enough to be told from others {i % 3}" for i in range(9)])
    return [
        (None, some), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, some), (5, some), (5, some), (6, near),
        (7, "a"), (8, "tie " * 90), (9, "tie " * 90), (10, " ".join(f"w{i * i % 9973}" for i in range(60_000))),
        (11, lines), (12, lines), (13, lines), (14, lines), (15, lines + "\nand more"), (16, "é ü ñ 日本語 🙂 " * 30),
        (17, "x" * 3000), (18, "y" * 199), (19, "Σίσυφος <|endoftext|> DON'T don't..., 12345\x1cab"),
    ]


@pytest.fixture(scope="session")
def make(spark):
    def frame(rows, clashing=True):
        full = [(i, t, "en" if (i or 0) % 2 else None, f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if clashing:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(c) for c in CLASHING})
        return df

    return frame


@pytest.fixture(scope="session")
def edges(make):
    return make(edge_texts()).repartition(4)


@pytest.fixture(scope="session")
def nothing(make):
    return make([])


def by_id(df):
    """Rows as dictionaries by id; repeated ids give lists of one."""
    out = {}
    for row in df.collect():
        out.setdefault(row["doc_id"], []).append(row.asDict(recursive=True))
    return out
