"""Periodic run detection: seeds on diagonals of a text against itself, extended to whole runs.

A run is a stretch of words that repeats itself with smallest period q at least ``exponent`` times and
has at least ``shortest`` words, extended as far as the period holds. On the diagonal of lag q it is a
stretch of matches that is q shorter than the run, so lags are taken in bands (1, 2, 3-4, 5-8, ...) and
for each band the grams of the shortest such stretch are indexed: their length is the overlap that
every run of the band guarantees. The names of all grams of 2, 4, 8, ... words come from pairs of names
half as long; a gram that occurs once in its text is dropped, and longer ones are not built on it. A
gram of any length is the pair of two overlapping names.

Inside a run of smallest period q the next occurrence of a gram of at least q words lies exactly q
further (nearer ones would give a smaller period), so of the occurrences in a text only
neighbouring ones are paired, and a pair whose distance is in the band is a seed. For each lag a
table holds how far the text is covered; a seed before that place is skipped, others are extended in
both directions as long as words q apart agree. So no more pairs are looked at than there are words in
each of log2(n) bands, however often a gram occurs.

Result: the id, n_words, runs (start, length, period; by start, then period) and collapsed (the words
that are kept, joined by one space: a word goes if a run has it after the run's first q words).

Edge cases. Words are what stands between ASCII white space; null counts as empty and has no words.
Repeated rows are treated alike; extra columns are not read. A text is worked on whole, with
about 100 bytes of memory a word beside it, in one task; others come in pieces of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import by_pieces

EXPONENT, SHORTEST = 4, 6

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def bands(longest: int, exponent: int = EXPONENT, shortest: int = SHORTEST) -> Iterator[tuple[int, int, int]]:
    """(smallest lag, largest lag, guaranteed overlap) of the bands for texts of up to ``longest`` words."""
    low, high = 1, 1
    while max(shortest, exponent * low) <= longest:
        yield low, high, min(max(shortest, exponent * q) - q for q in range(low, min(high, low + shortest) + 1))
        low, high = high + 1, 2 * high


class Words(dict):
    """Numbers for words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def named(pairs: np.ndarray) -> np.ndarray:
    """Names of equal values; -1 for a value that occurs once."""
    values, names, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    return np.where(counts[names] > 1, names, -1)


def joined(names: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram and the one ``step`` further both recur, and the pair as one number."""
    places = np.flatnonzero((names[:-step] >= 0) & (names[step:] >= 0)) if step < len(names) else np.zeros(0, np.int64)
    return places, names[places] * len(names) + names[places + step]


def seeds(words: np.ndarray, document: np.ndarray, longest: int, exponent: int,
          shortest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(places, lags, overlap) by band. ``words`` are numbers; grams across documents occur once."""
    names, size = named(document * (int(words.max()) + 1) + words), 1
    for low, high, overlap in bands(longest, exponent, shortest):
        while 2 * size <= overlap:
            places, pairs = joined(names, size)
            names = np.full(len(names), -1)
            names[places] = named(pairs)
            size *= 2
        places, pairs = joined(names, overlap - size) if overlap > size else (
            np.flatnonzero(names >= 0), names[names >= 0])
        if not len(places):
            continue
        order = np.argsort(pairs, kind="stable")
        places, pairs = places[order], pairs[order]
        lags = np.diff(places)
        near = np.flatnonzero((pairs[1:] == pairs[:-1]) & (lags >= low) & (lags <= high))
        if len(near):
            yield places[near], lags[near], overlap


def reach(words: np.ndarray, at: int, lag: int, end: int) -> int:
    """The first place from ``at`` on whose word differs from that ``lag`` further, before ``end``."""
    step = 64
    while at + lag < end:
        stop = min(at + step, end - lag)
        differs = np.flatnonzero(words[at:stop] != words[at + lag:stop + lag])
        if len(differs):
            return at + int(differs[0])
        at, step = stop, 2 * step
    return at


def reach_back(words: np.ndarray, at: int, lag: int, begin: int) -> int:
    """The first place of the stretch of agreeing words that ends at ``at``."""
    step = 64
    while at > begin:
        start = max(at - step, begin)
        differs = np.flatnonzero(words[start:at] != words[start + lag:at + lag])
        if len(differs):
            return start + int(differs[-1]) + 1
        at, step = start, 2 * step
    return at


def find_runs(texts: list[list[bytes]], exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start and then period."""
    if exponent < 3:
        raise ValueError("neighbouring occurrences tell the period only from three repetitions on")
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    if not sizes.sum():
        return found
    number = Words()
    words = np.fromiter((number[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    firsts = np.concatenate([[0], np.cumsum(sizes)])
    document = np.repeat(np.arange(len(texts)), sizes)
    for places, lags, overlap in seeds(words, document, int(sizes.max()), exponent, shortest):
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        # A seed right behind another of its lag lies on the same stretch.
        starts = np.flatnonzero(np.concatenate([[True], (np.diff(places) != 1) | (np.diff(lags) != 0)]))
        covered: dict[tuple[int, int], int] = {}
        for place, lag in zip(places[starts].tolist(), lags[starts].tolist(), strict=True):
            text = int(document[place])
            if place < covered.get((text, lag), 0):
                continue
            begin, end = int(firsts[text]), int(firsts[text + 1])
            right = reach(words, place + overlap, lag, end)
            left = reach_back(words, place, lag, begin)
            covered[text, lag] = right
            if right - left + lag >= max(shortest, exponent * lag):
                found[text].append((left - begin, right - left + lag, lag))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without what a run repeats."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:-1]) > 0
    return [w for w, drop in zip(words, gone.tolist(), strict=True) if not drop]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT,
                  shortest: int = SHORTEST) -> DataFrame:
    """id, n_words, runs and collapsed of each row; see above."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or "").encode().split() for t in batch.column("_text").to_pylist()]
        runs = find_runs(texts, exponent, shortest)
        kept = [b" ".join(collapse(t, r)).decode() for t, r in zip(texts, runs, strict=True)]
        spans = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], RUNS)
        return pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array([len(t) for t in texts], pa.int64()), spans, pa.array(kept, pa.string())],
            ["_id", "n_words", "runs", "collapsed"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(by_pieces(work, "_text"), f"_id {kind}, n_words bigint, "
                           "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
                           ).withColumnRenamed("_id", id_col)
