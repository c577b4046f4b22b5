import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import by_id, edge_texts, words

from loanlake.llm import kneser_ney
from loanlake.llm import quality as q
from loanlake.llm.words import text_bytes


def brute_counts(text):
    text = text or ""
    w = words(text, fold=False)
    runs = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + d for k in range(len(w) - 2) if runs[tuple(w[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), failed)


def fold(byte):
    c = chr(byte)
    if byte in b" \t\n\x0b\x0c\r":
        return 1
    if byte < 128 and c.isalpha():
        return 3 + ord(c.lower()) - ord("a")
    if byte < 128 and c.isdigit():
        return 29 + int(c)
    if byte < 128:
        return 39 + ".,;:!?'-".index(c) if c in ".,;:!?'-" else 2
    return 48 + byte % 16


def half(text):
    column = pa.array([text], pa.string())
    return int(kneser_ney.halves(column)[0])


class Brute:
    """Modified Kneser-Ney of one half over dictionaries, by its definition."""

    def __init__(self, texts):
        runs = Counter()
        for text in texts:
            s = [0] * 5 + list(map(fold, text.encode()))
            runs.update(tuple(s[k - 5 : k + 1]) for k in range(5, len(s)))
        self.counts = {6: runs}
        for n in range(5, 0, -1):
            self.counts[n] = Counter(run[1:] for run in self.counts[n + 1])
        self.off, self.total, self.kinds = {}, {}, {}
        for n, counts in self.counts.items():
            of = Counter(counts.values())
            n1, n2, n3, n4 = (of[k] for k in (1, 2, 3, 4))
            if min(n1, n2, n3, n4) == 0:
                self.off[n] = [0, 0.5, 1, 1.5]
            else:
                y = n1 / (n1 + 2 * n2)
                raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
                self.off[n] = [0, *[min(max(x, 0.1), k) for k, x in zip((1, 2, 3), raw, strict=True)]]
            self.total[n], self.kinds[n] = Counter(), Counter()
            for run, c in counts.items():
                self.total[n][run[:-1]] += c
                self.kinds[n][run[:-1], min(c, 3)] += 1

    def probability(self, run):
        n = len(run)
        if not n:
            return 1 / 64
        total = self.total[n][run[:-1]]
        if not total:
            return self.probability(run[1:])
        c = self.counts[n][run]
        weight = sum(self.off[n][k] * self.kinds[n][run[:-1], k] for k in (1, 2, 3)) / total
        return max(c - self.off[n][min(c, 3)], 0) / total + weight * self.probability(run[1:])

    def log_perplexity(self, text):
        s = [0] * 5 + list(map(fold, text.encode()))
        return -sum(math.log(self.probability(tuple(s[k - 5 : k + 1]))) for k in range(5, len(s))) / (len(s) - 5)


def median(x):
    return sorted(x)[(len(x) - 1) // 2]


def brute_judged(rows, width=5.0, least=0.01, steady=1000):
    """Log perplexities, counts and ``kept`` for ``rows(doc_id, lang, text)``."""
    model = {(lang, h): Brute([t for _, x, t in rows if t and x == lang and half(t) == h])
             for lang in {x for _, x, _ in rows} for h in (0, 1)}
    log = [model[lang, 1 - half(t)].log_perplexity(t) if t else None for _, lang, t in rows]
    base = [brute_counts(t) for _, _, t in rows]
    factor = [math.sqrt(1 + steady / max(b[1], 1)) for b in base]
    kept = []
    for i, (_, lang, _) in enumerate(rows):
        if base[i][5]:
            kept.append(False)
            continue
        own = [j for j, r in enumerate(rows) if r[1] == lang and not base[j][5] and log[j] is not None]
        middle = median([log[j] for j in own])
        spread = max(least, median([abs(log[j] - middle) / factor[j] for j in own]) / 0.6745)
        kept.append(abs(log[i] - middle) <= width * spread * factor[i])
    return log, base, kept


def prose(n=150, junk=15, seed=1):
    rng = random.Random(seed)
    parts = {"en": ["th", "er", "on", "an", "re", "he"], "de": ["sch", "ei", "ung", "en", "ü", "ber"], None: ["ka", "mo"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randrange(1, 5))) for _ in range(rng.randrange(60, 200)))
        rows.append((i, lang, text))
    for i in range(n, n + junk):
        rows.append((i, rng.choice(list(parts)), " ".join(f"{rng.randrange(10**6)}#{rng.randrange(99)}" for _ in range(90))))
    return rows


def frame(spark, rows):
    full = [(i, lang, t, "x", "y") for i, lang, t in rows]
    return spark.createDataFrame(full, "doc_id long, lang string, text string, n string, text_hash string")


def more_rows():
    """Prose, junk, a text of very common syllables (below the band), copies, NULL and empty texts."""
    english = next(t for _, lang, t in prose() if lang == "en")
    rng = random.Random(4)
    plain = " ".join(rng.choice(["thther", "therth", "erthth", "ththth"]) for _ in range(300))
    return [*prose(), (900, None, None), (901, "en", ""), (902, "fr", "one " * 60), (None, "en", english),
            (3, *prose()[3][1:]), (903, "en", plain)]


@pytest.mark.parametrize("most", [kneser_ney.BROADCAST_RUNS, 0])
def test_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(kneser_ney, "HELD_RUNS", 2000)
    rows = more_rows()
    log, base, kept = brute_judged(rows)
    df = q.judge(frame(spark, rows).repartition(3), broadcast_runs=most)
    assert df.columns[:8] == ["doc_id", *q.COUNTS, "base_failed", "kept"]
    found = df.collect()
    got = sorted((str((r["doc_id"], r["lang"])), *[r[c] for c in q.COUNTS], r["base_failed"], r["kept"],
                  r["perplexity"] and round(math.log(r["perplexity"]), 4)) for r in found)
    want = sorted((str((i, lang)), *b, k, x and round(x, 4)) for (i, lang, _), x, b, k in
                  zip(rows, log, base, kept, strict=True))
    assert got == want
    sides = {(r["perplexity"] < r["lowest_perplexity"], r["perplexity"] > r["highest_perplexity"])
             for r in found if not r["base_failed"]}
    assert sides == {(False, False), (True, False), (False, True)}


def test_good_rows_stay(spark):
    rows = more_rows()
    _, _, kept = brute_judged(rows)
    stay = q.keep_good(frame(spark, rows))
    assert sorted(str(r["doc_id"]) for r in stay.collect()) == sorted(str(i) for (i, _, _), k in zip(rows, kept, strict=True) if k)
    assert stay.columns == frame(spark, rows).columns
    assert {i for (i, _, _), k in zip(rows, kept, strict=True) if k and i is not None} >= set(range(140))


def test_probabilities_add_up(spark):
    from loanlake.llm.stash import Stash

    model = kneser_ney.fit(frame(spark, prose()), Stash(spark)).toPandas()
    for h in "01":
        sums = model.groupby(["lang_key", model.code // 64])[f"p{h}"].sum()
        assert (sums < 1 + 1e-9).all() and (model[f"p{h}"] > 0).all()


def test_near_copies_share_a_half():
    rng = random.Random(3)
    same = 0
    for _ in range(300):
        words = ["".join(rng.choices("abcdefg", k=6)) for _ in range(200)]
        other = [*words]
        other[rng.randrange(200)] = "changed"
        same += half(" ".join(words)) == half(" ".join(other))
    assert same > 290


def test_edges(edges):
    found = q.judge(edges.select("*")).collect()
    want = sorted((str(i), *brute_counts(t)) for i, t in edge_texts())
    assert sorted((str(r["doc_id"]), *[r[c] for c in q.COUNTS], r["base_failed"]) for r in found) == want


def test_empty(nothing):
    assert q.judge(nothing).count() == 0 and q.keep_good(nothing).count() == 0


def test_runs_are_searched_once_and_in_order(monkeypatch):
    rng = np.random.default_rng(5)
    run = np.unique(rng.integers(0, 1 << 36, 400))
    log = rng.random(len(run)).astype(np.float32)
    wanted = rng.choice(run, 5000)
    asked = []
    searched = np.searchsorted

    def search(table, needles):
        asked.append(needles)
        return searched(table, needles)

    monkeypatch.setattr(np, "searchsorted", search)
    found = kneser_ney._looked_up(run, log, wanted)
    assert found.tolist() == log[searched(run, wanted)].tolist()
    assert np.concatenate(asked).tolist() == sorted(set(wanted.tolist()))


def test_codes_of_many_texts():
    texts = ["", None, "a", "ab c\tD9!é", "", "x" * 20, None]
    data, first = text_bytes(pa.array(texts))
    want = []
    for text in texts:
        folded = [0] * 5 + [int(kneser_ney._FOLD[b]) for b in (text or "").encode()]
        want += [sum(folded[i + j] << 6 * (5 - j) for j in range(6)) for i in range(len(folded) - 5)]
    assert kneser_ney.codes(data, first).tolist() == want
