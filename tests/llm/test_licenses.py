import random
import re

import pytest
from conftest_llm import edge_texts

from loanlake.llm import licenses as li
from loanlake.llm.license_texts import BASE_PHRASES, NOTICES


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_matches(words, notice):
    """Right-maximal runs of five words and more that stand in the notice, at all their places."""

    def at(i, j, n):
        return words[i - n + 1 : i + 1] == notice[j - n + 1 : j + 1]

    return [(i, j, n) for i in range(len(words)) for j in range(len(notice))
            if (n := next((n for n in range(min(i, j) + 1, 0, -1) if at(i, j, n)), 0))]


def brute(text, phrases, notices, share=0.8):
    words = tokens(text)
    places = [(k, tuple(tokens(p)), label) for p, label in phrases.items() for k in range(len(words))]
    found = [(k, label) for k, p, label in places if tuple(words[k : k + len(p)]) == p]
    base = {label for _, label in found}
    every = [tokens(t) for texts in notices.values() for t in texts] + [tokens(p) for p in phrases]
    # The longest run that ends at each word and stands in any text.
    longest = []
    for i in range(len(words)):
        n = 0
        for text_words in every:
            for j in range(len(text_words)):
                m = 0
                while m <= min(i, j) and words[i - m] == text_words[j - m]:
                    m += 1
                n = max(n, m)
        longest.append(n)
    spans, best = [], float(bool(base))
    number = 0
    for label, texts in notices.items():
        for t in texts:
            notice = tokens(t)
            matches = [(i, j, n) for i, n in enumerate(longest) if n >= 5 and (i + 1 == len(words) or longest[i + 1] != n + 1)
                       for j in range(n - 1, len(notice)) if notice[j - n + 1 : j + 1] == words[i - n + 1 : i + 1]]
            score, root, ends = [], [], {}
            for i, (x, y, n) in enumerate(sorted(matches)):
                score.append(n)
                root.append(i)
                for j, (px, py, _) in enumerate(sorted(matches)[:i]):
                    shared = max(px - x + n, py - y + n, 0)
                    if px < x and py < y and -12 <= px - x + n + 0 and x - n - px <= 12 and y - n - py <= 12:
                        if score[j] + n - shared > score[i]:
                            score[i], root[i] = score[j] + n - shared, root[j]
                ends[root[i]] = max(ends.get(root[i], (0, 0)), (score[i], -i))
            for r, (covered, i) in ends.items():
                best = max(best, min(1.0, covered / len(notice)))
                if covered >= share * len(notice):
                    m = sorted(matches)
                    spans.append((label, number, m[r][0] - m[r][2] + 1, m[-i][0], covered, len(notice)))
            number += 1
    starts = [k for k, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {s[0] for s in spans})), best, sorted(spans))


def got(df):
    return sorted(((r["doc_id"], *[r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")],
                    sorted(tuple(s) for s in r["spans"])) for r in df.collect()), key=str)


def changed(rng, text, p):
    out = []
    for w in tokens(text):
        x = rng.random()
        out += [] if x < p / 3 else [w, "extra"] if x < 2 * p / 3 else ["other"] if x < p else [w]
    return " ".join(out)


def test_against_brute_force(spark, make):
    rng = random.Random(5)
    texts = [t for own in NOTICES.values() for t in own]
    rows = [(None, "All rights reserved."), (1, None), (2, ""), (3, "cc, BY! cc by cc_by ccby CC\x00by 日cc by"),
            (4, "GNU General\nPublic License; the general public license"), (5, "all rights all rights reserved reserved"),
            (6, "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0."), (7, texts[1] + " and " + texts[1]),
            (8, "the software is provided as is"), (9, " ".join(texts)), (9, " ".join(texts))]
    rows += [(10 + i, "before " * rng.randrange(9) + changed(rng, rng.choice(texts), rng.choice([0, 0.02, 0.1, 0.3])) + " x" * rng.randrange(3))
             for i in range(80)]
    found = got(li.scan_licenses(make(rows).repartition(3)))
    assert found == sorted(((i, *brute(t, BASE_PHRASES, NOTICES)) for i, t in rows), key=str)
    assert len({r[6] for r in found}) > 12


def test_repetitive_words(spark, make):
    """Few different words, so that runs overlap in many ways."""
    rng = random.Random(7)

    def some(n):
        return " ".join(rng.choice("ab") for _ in range(n))

    notices = {f"n{i}": [some(rng.randrange(5, 14))] for i in range(6)}
    phrases = {"a": "one", "a b": "two", "b a b": "three", "b a b b a b a": "seven"}
    rows = [(i, some(rng.randrange(0, 40)) + rng.choice(["", " z "]) + some(9)) for i in range(120)]
    want = sorted(((i, *brute(t, phrases, notices)) for i, t in rows), key=str)
    assert got(li.scan_licenses(make(rows), phrases, notices)) == want


def test_edges(edges, nothing):
    found = got(li.scan_licenses(edges))
    base = [(i, t) for i, t in edge_texts() if len(t or "") < 10_000]
    want = {str((i, *brute(t, BASE_PHRASES, NOTICES))) for i, t in base}
    assert want <= {str(r) for r in found} and len(found) == len(edge_texts())
    assert li.scan_licenses(nothing).count() == 0 and li.license_spans(nothing).count() == 0


def test_a_long_text_is_scanned_to_its_end(spark, make):
    notice = NOTICES["isc"][0]
    text = "software " * 200_000 + notice
    row = li.license_spans(make([(1, text)])).first()
    assert (row["label"], row["last_word"] + 1) == ("isc", len(tokens(text)))


def test_too_short_a_notice():
    with pytest.raises(ValueError, match="less than 5"):
        li.Scanner({}, {"x": ["four words it has"]}, 0.8)
