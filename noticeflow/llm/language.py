"""Language identification: interpolated Kneser-Ney character models in sorted hash arrays.

A text is lower-cased and cut into words at white space; of a word only the letters count,
between word marks. For each language an interpolated Kneser-Ney model of order ``ORDER`` gives
the probability of each letter (and of the word's end). The n-grams of all languages stand
together in one sorted array of 64-bit hashes per order, beside it a row of discounted
probabilities and, for contexts, of back-off weights, with a column for each language; a lookup
is a binary search. The language with the lowest cross-entropy per character wins.

Words are scored once and kept in a bounded cache, so most of a text is a sum of known rows.

Calibration, on a part of the sample that the models have not seen: the temperature of the
score (a softmax over the total log-probabilities divided by it), and for each language a
bound on the cross-entropy per character; a text above the bound is not ``accepted``, though
its nearest language is still named.

Learning takes a bounded sample: per language the ``SAMPLE_ROWS`` texts with the lowest hash of
the id, of texts up to ``SAMPLE_CHARS`` (longer ones are only scored), so at most languages *
SAMPLE_ROWS * SAMPLE_CHARS characters reach the driver.

Edge cases. Null, empty and letterless texts are ``und`` with score 0 and not accepted. A
language without a text to learn from is unknown; with none at all every text is ``und``.
Repeated rows are treated alike; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeflow.llm.common import among_lowest, by_pieces, texts_of

ORDER = 4
SAMPLE_ROWS = 500
SAMPLE_CHARS = 20_000
ACCEPT_SHARE = 0.995
CACHE_WORDS = 400_000
FACTOR = np.uint64(0x100000001B3)


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def hashed(codes: np.ndarray) -> np.ndarray:
    """A hash of each row of character codes."""
    out = np.full(len(codes), 0xCBF29CE484222325, np.uint64)
    for column in codes.T:
        out = (out ^ column.astype(np.uint64)) * FACTOR
        out ^= out >> np.uint64(29)
    return out


def grams(words: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every letter and the end of every word: the codes of it and its ``order`` - 1
    predecessors (word marks before the word), its word, and its place in the word."""
    marked = [w + "\n" for w in words]
    data = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.array([len(m) for m in marked])
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.full((len(data), order), ord("\t"), np.uint32)
    for back in range(order):
        has = place >= back
        out[has, order - 1 - back] = data[np.flatnonzero(has) - back]
    return out, word, place


class Table:
    """Rows of numbers by sorted hashes."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]

    def rows(self, keys: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        out = self.values[at]
        out[self.keys[at] != keys] = missing
        return out


class Models:
    def __init__(self, counts: dict[str, Counter], order: int = ORDER):
        self.languages = sorted(counts)
        self.order = order
        self.tables: list[tuple[Table, Table]] = []
        self.temperature = 1.0
        self.bounds = {lang: np.inf for lang in self.languages}
        self.known: dict[str, int] = {}
        self.sums, self.sizes = np.zeros((0, len(self.languages))), np.zeros(0)
        if not counts:
            return
        per_lang = [self.count(counts[lang]) for lang in self.languages]
        self.letters = max(len(np.unique(np.concatenate([c[0][0][:, -1] for c in per_lang]))), 1) + 1
        for n in range(order):
            self.tables.append(self.merge([self.discounted(c[n], n) for c in per_lang]))

    def count(self, words: Counter) -> list[tuple[np.ndarray, np.ndarray]]:
        """(n-grams, counts) by order: true counts for the highest, else in how many
        contexts an n-gram follows."""
        names = list(words)
        codes, word, _ = grams(names, self.order)
        full, where = np.unique(codes, axis=0, return_inverse=True)
        totals = np.bincount(where.ravel(), weights=np.array([words[w] for w in names], float)[word])
        out = [(full, totals)]
        for n in range(self.order - 1, 0, -1):
            longer = out[0][0]
            shorter, where = np.unique(longer[:, 1:], axis=0, return_inverse=True)
            out.insert(0, (shorter, np.bincount(where.ravel()).astype(float)))
        return out

    def discounted(self, counted: tuple[np.ndarray, np.ndarray], n: int) -> tuple:
        codes, counts = counted
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        contexts, where = np.unique(codes[:, :-1], axis=0, return_inverse=True) if n else (codes[:1, :0], np.zeros(len(codes), int))
        where = where.ravel()
        totals = np.bincount(where, weights=counts)
        kinds = np.bincount(where)
        return hashed(codes), (counts - discount) / totals[where], hashed(contexts), discount * kinds / totals

    def merge(self, parts: list[tuple]) -> tuple[Table, Table]:
        out = []
        for k, missing in ((0, 0.0), (2, 1.0)):
            keys = np.unique(np.concatenate([p[k] for p in parts]))
            values = np.full((len(keys), len(parts)), missing)
            for column, p in enumerate(parts):
                values[np.searchsorted(keys, p[k]), column] = p[k + 1]
            out.append(Table(keys, values))
        return tuple(out)

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word in each language."""
        codes, word, _ = grams(words, self.order)
        p = np.full((len(codes), len(self.languages)), 1 / self.letters)
        for n, (seen, contexts) in enumerate(self.tables):
            tail = codes[:, self.order - 1 - n:]
            p = seen.rows(hashed(tail), 0.0) + contexts.rows(hashed(tail[:, :-1]), 1.0) * p
        starts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        return np.add.reduceat(np.log(p), starts, axis=0)

    def learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.known]
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self.known, self.sums, self.sizes, fresh = {}, self.sums[:0], self.sizes[:0], list(words)
        rows = np.zeros((len(fresh), len(self.languages)))
        cut = [letters(w) for w in fresh]
        full = [i for i, w in enumerate(cut) if w]
        if full:
            rows[full] = self.word_rows([cut[i] for i in full])
        self.known.update(zip(fresh, range(len(self.sums), len(self.sums) + len(fresh)), strict=True))
        self.sums = np.concatenate([self.sums, rows])
        self.sizes = np.concatenate([self.sizes, [len(w) + 1 if w else 0 for w in cut]])

    def totals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability by language, and number of characters, of each text."""
        cut = [t.lower().split() for t in texts]
        self.learn(set().union(*cut))
        get = self.known.__getitem__
        sums, sizes = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for i, words in enumerate(cut):
            at = np.fromiter(map(get, words), np.int64, len(words))
            sums[i], sizes[i] = self.sums[at].sum(0), self.sizes[at].sum()
        return sums, sizes

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[bool], np.ndarray]:
        """Language, score, accepted, and cross-entropy per character in bits."""
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), [False] * len(texts), np.zeros(len(texts))
        sums, sizes = self.totals(texts)
        best, some = sums.argmax(1), sizes > 0
        entropy = np.where(some, -sums.max(1) / np.maximum(sizes, 1) / np.log(2), 0)
        odds = np.exp((sums - sums.max(1, keepdims=True)) / self.temperature)
        score = np.where(some, 1 / odds.sum(1), 0)
        names = [self.languages[b] if s else "und" for b, s in zip(best, some, strict=True)]
        fine = [bool(s) and e <= self.bounds[n] for n, s, e in zip(names, some, entropy, strict=True)]
        return names, score, fine, entropy

    def calibrate(self, texts: list[str], langs: list[str]) -> None:
        """Set the temperature and the bounds from texts that were not learned from."""
        known = [i for i, lang in enumerate(langs) if lang in self.bounds]
        if not known:
            return
        sums, sizes = self.totals([texts[i] for i in known])
        right = np.array([self.languages.index(langs[i]) for i in known])
        best, loss = 1.0, np.inf
        for t in 2.0 ** np.arange(0, 9):
            z = (sums - sums.max(1, keepdims=True)) / t
            own = (np.log(np.exp(z).sum(1)) - z[np.arange(len(z)), right]).mean()
            if own < loss - 1e-12:
                best, loss = float(t), own
        self.temperature = best
        entropy = -sums[np.arange(len(sums)), right] / np.maximum(sizes, 1) / np.log(2)
        for k, lang in enumerate(self.languages):
            own = entropy[(right == k) & (sizes > 0)]
            if len(own):
                self.bounds[lang] = float(np.quantile(own, ACCEPT_SHARE)) * 1.05

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}, "sums": self.sums[:0], "sizes": np.zeros(0)}


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
          exclude: Column | None = None, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Models:
    """Learn one model per language; ``exclude`` marks rows that must not be learned from."""
    rows = docs.filter(F.col(lang_col).isNotNull() & (F.length(text_col) <= sample_chars) & F.col(id_col).isNotNull())
    rows = rows.filter(~exclude) if exclude is not None else rows
    ids = rows.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"))
    hashed = F.xxhash64("_id", F.lit(5))
    sizes = ids.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n"))
    ids = ids.join(F.broadcast(sizes), "_lang").filter(among_lowest(hashed, sample_rows, F.col("_n")))
    order = Window.partitionBy("_lang").orderBy(hashed, "_id")
    ids = ids.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= sample_rows).select("_id").distinct()
    sample = rows.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).join(
        F.broadcast(ids), "_id").collect()
    sample = sorted({(r._id, r._text, r._lang) for r in sample})
    counts: dict[str, Counter] = {}
    later: list[tuple[str, str]] = []
    for n, (_, text, lang) in enumerate(sample):
        if n % 5 == 4:
            later.append((text, lang))
        else:
            counts.setdefault(lang, Counter()).update(w for word in text.lower().split() if (w := letters(word)))
    models = Models({lang: c for lang, c in counts.items() if c})
    if models.languages and later:
        models.calibrate([t for t, _ in later], [lang for _, lang in later])
    return models


def identify(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, accepted, bits_per_char for each row."""
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score, fine, entropy = sent.value.predict(texts_of(batch, "text"))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64()),
             pa.array(fine, pa.bool_()), pa.array(entropy, pa.float64())],
            ["doc_id", "lang_pred", "score", "accepted", "bits_per_char"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(by_pieces(work, "text"),
                           f"doc_id {kind}, lang_pred string, score double, accepted boolean, bits_per_char double")
