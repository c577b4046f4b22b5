"""Licence notices in texts, whole or in parts, found with a generalised suffix automaton of the notices' words.

The automaton knows every run of words of every notice. A text is streamed through it: after each word, its state is the
longest run that ends there and stands in some notice (matching statistics). Runs that cannot go on and have at least
``LEAST_RUN`` words are long matches; each is placed wherever it stands in a notice, and places in order, with small gaps
on both sides, are chained into a span. A span counts if it covers ``least_share`` of the notice, so notices with changed,
missing or inserted words are found, and parts that all software licences share are told apart by what follows.

Phrases are part of the automaton; a phrase ends where its state is the current one or a suffix of it.

Texts are independent of each other: there is no shuffle, and the automaton, which is sent to executors, is bounded by
``MOST_WORDS`` of notices, whatever the corpus. Words that no notice has end a run, and texts are streamed side by side:
a step takes the next word of all runs of a batch.

Words are runs of digits, a-z, A-Z counted as a-z, and characters beyond ASCII. Defined cases: a NULL or empty text has
no words, no labels ('') and score 0; its first and last places are NULL. A NULL id stays. Repeated rows are scanned
each. The score is the largest share of a notice or phrase that is covered. Extra columns are ignored. An empty table
gives no rows.
"""

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.llm.license_texts import BASE_PHRASES, NOTICES
from loanlake.llm.stash import share_package
from loanlake.llm.words import slices, split_words

#: Words of the shortest match that counts as evidence of a notice.
LEAST_RUN = 5
#: Words between two matches of a span, in the text or in the notice.
WIDEST_GAP = 12
#: Words of all notices and phrases; about 300 bytes of automaton each.
MOST_WORDS = 200_000

_BREAKS = np.zeros(256, bool)
_BREAKS[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_SPAN = "label string, notice int, first_word long, last_word long, n_covered int, n_words int"
_SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    f"score double, spans array<struct<{_SPAN.replace(' ', ':').replace(',:', ',')}>>"
)


def _words(texts: list[str]) -> list[np.ndarray]:
    words = split_words(pa.array(texts, pa.string()), breaks=_BREAKS)
    return [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]


class _Builder:
    """The states of the automaton: length of the longest run, suffix link and next states."""

    def __init__(self):
        self.length, self.link, self.next = [0], [-1], [{}]

    def _state(self, length: int, link: int, following: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        """The runs of ``q`` no longer than one from ``p`` become a state of their own."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def add(self, last: int, token: int) -> int:
        """The state of the run of ``last`` and one more token."""
        if token in self.next[last]:
            q = self.next[last][token]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, token, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, token, q)
        return new


@dataclass(frozen=True)
class Automaton:
    """Sorted arrays: word hashes, edges by state and word, and the places of each state's runs in the notices."""

    vocabulary: np.ndarray
    edges: np.ndarray
    targets: np.ndarray
    length: np.ndarray
    link: np.ndarray
    place_first: np.ndarray  # of each state among the places
    place_text: np.ndarray
    place_end: np.ndarray
    phrases_below: np.ndarray  # phrases that are suffixes of all runs of a state, as bits
    phrase_here: np.ndarray  # a phrase that is the longest run of a state, as a bit

    @classmethod
    def build(cls, texts: list[np.ndarray], n_phrases: int) -> "Automaton":
        """Of word hashes; the first ``n_phrases`` texts are phrases."""
        if sum(map(len, texts)) > MOST_WORDS:
            raise ValueError(f"notices of more than {MOST_WORDS} words")
        vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *texts]))
        built, own = _Builder(), defaultdict(list)
        here = {}
        for number, text in enumerate(texts):
            state = 0
            for end, token in enumerate(np.searchsorted(vocabulary, text).tolist()):
                state = built.add(state, token)
                own[state].append((number, end))
            if number < n_phrases:
                here[state] = here.get(state, 0) | 1 << number
        n = len(built.length)
        # Later runs may have split a state; a phrase or prefix is still the longest run of its state.
        order = sorted(range(1, n), key=built.length.__getitem__)
        below, places = [0] * n, {s: list(x) for s, x in own.items()}
        for s in order:
            up = built.link[s]
            below[s] = below[up] | here.get(up, 0)
        for s in reversed(order):
            if s in places and built.length[s] >= LEAST_RUN:
                places.setdefault(built.link[s], []).extend(places[s])
        lists = [sorted(places.get(s, [])) if built.length[s] >= LEAST_RUN else [] for s in range(n)]
        flat = [p for x in lists for p in x]
        pairs = sorted((s * len(vocabulary) + t, q) for s in range(n) for t, q in built.next[s].items())
        return cls(
            vocabulary, np.array([k for k, _ in pairs], np.int64), np.array([q for _, q in pairs], np.int64),
            np.array(built.length, np.int64), np.array(built.link, np.int64),
            np.cumsum([0, *map(len, lists)]), np.array([t for t, _ in flat], np.int64),
            np.array([e for _, e in flat], np.int64), np.array(below, np.int64),
            np.array([here.get(s, 0) for s in range(n)], np.int64),
        )

    def _step(self, state: np.ndarray, length: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Go on with a word each, dropping words from the front of a run until some notice goes on like it."""
        state, length = state.copy(), length.copy()
        todo = np.arange(len(state))
        while len(todo):
            key = state[todo] * len(self.vocabulary) + token[todo]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            found = self.edges[at] == key
            done = todo[found]
            state[done] = self.targets[at[found]]
            length[done] += 1
            todo = todo[~found]  # never at the root: every word of the vocabulary starts a run
            state[todo] = self.link[state[todo]]
            length[todo] = self.length[state[todo]]
        return state, length

    def stream(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state and the length of the longest run after each word of each text; 0 and 0 outside of runs."""
        states, lengths = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        if not len(self.vocabulary) or not len(hashes):
            return states, lengths
        token = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[token] == hashes
        opens = known.copy()
        opens[1:] &= ~known[:-1]
        starts = first[:-1][np.diff(first) > 0]
        opens[starts] = known[starts]
        begins = np.flatnonzero(opens)
        closes = np.flatnonzero(~known | opens)  # the first word after a run, or the end
        sizes = np.append(closes, len(hashes))[np.searchsorted(closes, begins, side="right")] - begins
        order = np.argsort(-sizes, kind="stable")
        begins, sizes = begins[order], sizes[order]
        state, length = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
        for k in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -k, side="left"))  # runs with more than k words
            at = begins[:n] + k
            state, length = self._step(state[:n], length[:n], token[at])
            states[at], lengths[at] = state, length
        return states, lengths

    def phrases(self, states: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The phrases that end at each word, as bits."""
        whole = lengths == self.length[states]
        return np.where(lengths > 0, self.phrases_below[states] | np.where(whole, self.phrase_here[states], 0), 0)


def _chains(matches: list[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """``(first word, last word, covered words)`` of the best chain from each of its beginnings.

    ``matches`` of one text and one notice: last word in the text, last word in the notice, and length. A match goes
    after one that ends before it on both sides, with at most ``gap`` words between; words that both have count once.
    """
    matches = sorted(matches)
    score, root = [], []
    best: dict[int, tuple[int, int]] = {}
    low = 0
    longest = max(n for _, _, n in matches)
    for i, (x, y, n) in enumerate(matches):
        score.append(n)
        root.append(i)
        while matches[low][0] < x - longest - gap:
            low += 1
        for j in range(low, i):
            px, py, _ = matches[j]
            shared = max(px - (x - n), py - (y - n), 0)
            if px < x and py < y and x - n - px <= gap and y - n - py <= gap and score[j] + n - shared > score[i]:
                score[i], root[i] = score[j] + n - shared, root[j]
        best[root[i]] = max(best.get(root[i], (0, 0)), (score[i], -i))
    return [(matches[r][0] - matches[r][2] + 1, matches[-i][0], covered) for r, (covered, i) in sorted(best.items())]


class Scanner:
    """The automaton of phrases and notices, and what a batch of texts has of them."""

    def __init__(self, phrases: dict[str, str], notices: dict[str, list[str]], least_share: float):
        if len(phrases) > 62:
            raise ValueError("more than 62 phrases")
        self._phrases = list(phrases.values())
        self._labels = [label for label, texts in notices.items() for _ in texts]
        hashes = _words([*phrases, *[t for texts in notices.values() for t in texts]])
        k = len(phrases)
        self._sizes = [len(h) for h in hashes[k:]]
        self._phrase_sizes = [len(h) for h in hashes[:k]]
        if min(self._sizes, default=LEAST_RUN) < LEAST_RUN or not all(self._phrase_sizes):
            raise ValueError(f"a notice of less than {LEAST_RUN} words, or an empty phrase")
        self._automaton, self._least_share = Automaton.build(hashes, k), least_share

    def _spans(self, words, states: np.ndarray, lengths: np.ndarray) -> dict[int, list[tuple]]:
        """``label, notice, first_word, last_word, n_covered, n_words`` of all chains, by text."""
        a, k = self._automaton, len(self._phrases)
        goes_on = np.zeros(len(lengths), bool)
        goes_on[:-1] = lengths[1:] == lengths[:-1] + 1
        ends = np.flatnonzero((lengths >= LEAST_RUN) & ~goes_on)
        text = np.searchsorted(words.first, ends, side="right") - 1
        by_pair = defaultdict(list)
        for end, t in zip(ends.tolist(), text.tolist(), strict=True):
            s, n = states[end], int(lengths[end])
            for p in range(a.place_first[s], a.place_first[s + 1]):
                by_pair[t, int(a.place_text[p]) - k].append((end - int(words.first[t]), int(a.place_end[p]), n))
        spans = defaultdict(list)
        for (t, notice), matches in by_pair.items():
            if notice >= 0:
                for begin, last, covered in _chains(matches, WIDEST_GAP):
                    spans[t].append((self._labels[notice], notice, begin, last, covered, self._sizes[notice]))
        return spans

    def scan(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        words = split_words(batch.column("text"), breaks=_BREAKS)
        n = batch.num_rows
        states, lengths = self._automaton.stream(words.hashes, words.first)
        bits = self._automaton.phrases(states, lengths)
        text_of = np.repeat(np.arange(n), np.diff(words.first))
        counts, labels = np.zeros(n, np.int64), [set() for _ in range(n)]
        first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
        for i, (label, size) in enumerate(zip(self._phrases, self._phrase_sizes, strict=True)):
            ends = np.flatnonzero(bits >> i & 1)
            of = text_of[ends]
            start = ends - size + 1 - words.first[of]
            counts += np.bincount(of, minlength=n)
            np.minimum.at(first, of, start)
            np.maximum.at(last, of, start)
            for t in np.unique(of).tolist():
                labels[t].add(label)
        spans = self._spans(words, states, lengths)
        score = [max([float(bool(labels[t])), *[min(1.0, s[4] / s[5]) for s in spans.get(t, [])]]) for t in range(n)]
        sure = {t: [s for s in own if s[4] >= self._least_share * s[5]] for t, own in spans.items()}
        everything = [labels[t] | {s[0] for s in sure.get(t, [])} for t in range(n)]
        names = [c.split()[0] for c in _SPAN.split(", ")]
        kind = pa.struct([(c, t) for c, t in zip(names, [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()], strict=True)])
        none = last < 0
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(np.diff(words.first), pa.int64()), pa.array(counts),
                pa.array(first, mask=none), pa.array(last, mask=none),
                pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                pa.array([",".join(sorted(x)) for x in everything], pa.string()), pa.array(score, pa.float64()),
                pa.array([[dict(zip(names, s, strict=True)) for s in sure.get(t, [])] for t in range(n)], pa.list_(kind)),
            ],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
        )


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = BASE_PHRASES,
    notices: dict[str, list[str]] = NOTICES,
    least_share: float = 0.8,
) -> DataFrame:
    """Per document its words, the places of ``phrases`` (number, first and last start), the labels of these and of
    all, the score, and the ``spans`` of notices."""
    share_package(docs.sparkSession)
    scanner = Scanner(phrases, notices, least_share)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield scanner.scan(batch)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, _SCANNED)


def license_spans(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id`` and the label, notice and place of every span, a row each."""
    return scan_licenses(docs, **settings).select("doc_id", F.inline("spans"))
