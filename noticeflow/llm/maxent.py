"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class times that of the token within its class. Both are
log-linear in hashed features of the tokens before it: the last one (bigram), the last two (trigram),
and the second and the third last alone (skips). Words are what stands between ASCII white space, with
A-Z in lower case; every text has one end token.

Classes. The ``HEAD`` most frequent tokens are clustered by their neighbours among the most frequent
ones (k-means on the driver, over a matrix of fixed size) and each cluster is cut by frequency into
classes of ``SLOTS`` words, each with a softmax of its own. All other words belong to one tail class per
cluster, which the last three bytes of a word decide, again by the neighbours of the words that end
so. Within a tail class the features are the words themselves: their discounted relative frequency, the
discount being the share of the class that unknown words have. So the probabilities of all known words
and of an unknown one in each tail class add up to 1.

Counting takes every text that is learned from: tasks count words, Spark adds the counts up, and the
table of all words stays distributed. Words frequent enough to be among ``VOCABULARY`` are
broadcast with their counts (a table of fixed size); the others are joined to it, as rows of (text,
word). Words of more than ``KEY_BYTES`` bytes go by their SHA-256.

Training goes over all texts that are learned from, a part in each of ``ROUNDS`` rounds: each task
follows the gradient over its part in batches, from the weights the round began with, and sends its
updates of the rows it touched; the new weights are their means by the number of touches. Weights
have a fixed size whatever the corpus. The result depends a little on how the input is split into tasks.

Edge cases. A null text is empty and has its end token only; a null id is never held out. With nothing to
learn from, all tokens are one unknown event of probability 1 and scores are 0. Repeated rows are
scored alike; extra columns are not read. Long texts are worked on in slices of bounded size.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import BATCH_BYTES, pieces, stage, texts_of

HEAD, SLOTS, CLUSTERS = 1024, 32, 8
VOCABULARY, KEY_BYTES = 1 << 19, 64
NEAR = 64
SUFFIXES = 4096
BITS = 14
ROWS = 1 << BITS
ROUNDS, RATE, BATCH = 2, 0.3, 16384
COUNTER_WORDS = 400_000
END = b""
#: Tokens that a context reaches back.
BACK = 2
SPACE = b" \t\n\r\x0b\x0c"


def key_of(word: bytes) -> bytes:
    """The word itself, or what stands for a long one; no short word looks like that."""
    return word if len(word) <= KEY_BYTES else b"#" + hashlib.sha256(word).hexdigest().encode()


def suffix_of(key: bytes) -> int:
    return zlib.crc32(key[-3:]) % SUFFIXES


def slices(raw: bytes, limit: int = BATCH_BYTES) -> Iterator[bytes]:
    """A text in slices of about ``limit`` bytes, cut at white space."""
    at = 0
    while len(raw) - at > limit:
        cut = at + limit
        while cut < len(raw) and raw[cut] not in SPACE:
            cut += 1
        yield raw[at:cut]
        at = cut
    yield raw[at:] if at else raw


def units(texts: Iterable[str], limit: int = BATCH_BYTES) -> Iterator[list[tuple[int, bytes, bool, bool]]]:
    """Groups of (text, slice, is its first, is its last) with about ``limit`` bytes together; A-Z in lower case."""
    group, size = [], 0
    for i, text in enumerate(texts):
        parts = list(slices(text.encode().lower(), limit))
        for n, part in enumerate(parts):
            if group and size + len(part) > limit:
                yield group
                group, size = [], 0
            group.append((i, part, n == 0, n == len(parts) - 1))
            size += len(part)
    if group:
        yield group


def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by word of a task's texts, sent on whenever there are ``COUNTER_WORDS`` of them."""
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        names = [key_of(w) for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(counts.values(), pa.int64())], ["key", "n"])

    for batch in batches:
        for piece in pieces(batch, "_text"):
            for group in units(texts_of(piece, "_text")):
                for _, part, _, last in group:
                    counts.update(part.split())
                    counts[END] += last
                if len(counts) > COUNTER_WORDS:
                    yield out()
                    counts.clear()
    if counts:
        yield out()


_IS_SPACE = np.isin(np.arange(256), list(SPACE))
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
ODD = [np.uint64(n) for n in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * ODD[3]
    x = (x ^ x >> np.uint64(29)) * ODD[0]
    return x ^ x >> np.uint64(32)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words of a text that begins and ends with a space."""
    space = _IS_SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    return edges[::2], edges[1::2] - edges[::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64 bits for each word: its length and its bytes, eight at a time, mixed one after the other."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # the eight bytes from each place on
    out = mixed(lengths.astype(np.uint64) * ODD[1])
    live, at, left = np.arange(len(starts)), starts, lengths
    while len(live):
        chunk = eights[at] & _MASKS[np.minimum(left, 8)]
        out[live] = mixed(out[live] ^ chunk)
        on = left > 8
        live, at, left = live[on], at[on] + 8, left[on] - 8
    return out


class HashIndex:
    """Numbers of known words by their hash: an open table four times as large as they are many."""

    def __init__(self, words: list[bytes]):
        lengths = np.array([len(w) for w in words], np.int64)
        data = np.frombuffer(b"".join(words), np.uint8)
        self.hashes = word_hashes(data, np.cumsum(lengths) - lengths, lengths)
        self.mask = np.uint64((4 << max(len(words), 1).bit_length()) - 1)
        self.table = np.full(int(self.mask) + 1, -1, np.int32)
        at, pending = (self.hashes & self.mask).astype(np.int64), np.arange(len(words))
        while len(pending):
            own = at[pending]
            free = self.table[own] < 0
            self.table[own[free]] = pending[free]
            pending = pending[self.table[own] != pending]
            at[pending] = at[pending] + 1 & int(self.mask)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for an unknown one."""
        out = np.full(len(hashes), -1, np.int64)
        at, live = (hashes & self.mask).astype(np.int64), np.arange(len(hashes))
        while len(live):
            there = self.table[at]
            same = (there >= 0) & (self.hashes[there] == hashes[live])
            out[live[same]] = there[same]
            on = (there >= 0) & ~same
            live, at = live[on], at[on] + 1 & int(self.mask)
        return out


@dataclass
class Lexicon:
    """The broadcast words, most frequent first, END being number 0, with their counts and classes."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    kinds: int
    head: int
    classes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    tail_class: np.ndarray = field(default_factory=lambda: np.zeros(SUFFIXES, np.int64))
    tail_total: np.ndarray = field(default_factory=lambda: np.zeros(SUFFIXES))
    tail_kinds: np.ndarray = field(default_factory=lambda: np.zeros(SUFFIXES))
    discount: float = 0.5

    def __post_init__(self) -> None:
        self.prepared = False
        self.codes = np.array([zlib.crc32(w) for w in self.words] + [0x9E3779B9], np.uint64)
        self.suffixes = np.array([suffix_of(w) for w in self.words], np.int64)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("index", "base", "share")} | {"prepared": False}

    def prepare(self) -> None:
        if not self.prepared:
            self.index, self.base, self.share = HashIndex(self.words), None, None
            self.prepared = True

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.kinds + 1)))

    def log_share(self) -> np.ndarray:
        """log10 of the share of each word in its tail class; 0 for the head."""
        tail = slice(self.head, None)
        return np.concatenate([np.zeros(self.head), np.log10(
            (self.counts[tail] - self.discount) / self.tail_total[self.suffixes[tail]])])

    def log_unknown(self) -> np.ndarray:
        """By suffix: log10 of the share that unknown words have in the tail class."""
        total = np.maximum(self.tail_total, 1e-300)
        return np.where(self.tail_total > 0, np.log10(np.maximum(self.discount * self.tail_kinds, 1e-300) / total), 0.0)

    def encode(self, texts: list[str]) -> Iterator[Tokens]:
        """The tokens of the texts in groups of bounded size."""
        self.prepare()
        start, carry = len(self.words), None
        for group in units(texts):
            text, raw, first, last = (list(x) for x in zip(*group, strict=True))
            blob = b" " + b" ".join(raw) + b" "
            data = np.frombuffer(blob, np.uint8)
            words, widths = word_bounds(data)
            hashes = word_hashes(data, words, widths)
            ids = self.index.numbers(hashes)
            unknown = np.flatnonzero(ids < 0)
            _, at, which = np.unique(hashes[unknown], return_index=True, return_inverse=True)
            ids[unknown] = start + 1 + which
            met = [key_of(blob[a:a + n]) for a, n in zip(words[unknown[at]].tolist(), widths[unknown[at]].tolist(), strict=True)]

            offsets = np.cumsum([0, *(len(r) + 1 for r in raw)])
            sizes = np.diff(np.searchsorted(words, offsets + 1))
            lengths = sizes + BACK + np.array(last)
            begins = np.cumsum(lengths) - lengths
            stream = np.zeros(int(lengths.sum()), np.int64)  # 0 is the end of a text
            is_word, inside = np.ones(len(stream), bool), np.ones(len(stream), bool)
            for back in range(BACK):
                inside[begins + back] = is_word[begins + back] = False
                stream[begins + back] = start
            is_word[(begins + lengths - 1)[np.array(last)]] = False
            if not first[0] and carry is not None:
                stream[:BACK] = carry
            stream[is_word] = ids
            if not last[-1]:  # the next slice goes on after this one's last words; its new words have other numbers
                carry = np.where(stream[-BACK:] <= start, stream[-BACK:], start)
            yield Tokens(self, stream, np.flatnonzero(inside), np.repeat(np.array(text), lengths)[inside], met)


class Tokens:
    """Tokens of a group of texts: numbers, their texts, and the numbers before them."""

    def __init__(self, lexicon: Lexicon, stream: np.ndarray, places: np.ndarray, text: np.ndarray, met: list[bytes]):
        self.stream, self.places, self.text, self.met = stream, places, text, met
        self.ids = stream[places]
        self.first_met = len(lexicon.words) + 1
        self.suffixes = np.array([suffix_of(w) for w in met], np.int64)
        self.codes = np.concatenate([lexicon.codes, np.array([zlib.crc32(w) for w in met], np.uint64)])

    def before(self, back: int, part: slice = slice(None)) -> np.ndarray:
        return self.codes[self.stream[self.places[part] - back]]

    def by_id(self, known: np.ndarray, met: np.ndarray) -> np.ndarray:
        """Values of the tokens from those of the known words and of the words met."""
        return np.concatenate([known, known[:1], met])[self.ids]


def bucket(kind: int, *values: np.ndarray) -> np.ndarray:
    """Row of a hashed feature."""
    out = np.full(1, kind, np.uint64)
    for value, odd in zip(values, ODD, strict=False):
        out = (out ^ (value * odd)) * ODD[3]
        out ^= out >> np.uint64(31)
    return ((out * ODD[0]) >> np.uint64(64 - BITS)).astype(np.uint16)


def add_rows(rows: np.ndarray, values: np.ndarray, into: np.ndarray) -> None:
    """Add each value to its row of ``into``. All rows are gone through at once, a value at a time; the few
    rows with more than eight values are then summed alone."""
    order = np.argsort(rows, kind="stable")
    rows, values = rows[order], values.take(order, axis=0)
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    n = np.diff(np.append(starts, len(rows)))
    out, more = values.take(starts, axis=0), np.flatnonzero(n > 1)
    for k in range(1, 8):
        out[more] += values.take(starts[more] + k, axis=0)
        more = more[n[more] > k + 1]
    for i in more.tolist():
        out[i] += values[starts[i] + 8:starts[i] + n[i]].sum(0)
    into[rows[starts]] += out


class Softmax:
    """Rows of weights; the logits of a token are the sum of the rows of its features."""

    def __init__(self, table: np.ndarray):
        self.table = table

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        out = self.table.take(rows[0], axis=0)
        for more in rows[1:]:
            out += self.table.take(more, axis=0)
        return out

    def learn(self, rows: list[np.ndarray], error: np.ndarray, sums: np.ndarray, touched: np.ndarray, rate: float) -> None:
        """One step along the gradient; ``sums`` of its squares set the length of the step in each weight."""
        gradient = np.zeros_like(self.table)
        for column in rows:
            if column[0] == ROWS and (column == ROWS).all():  # one bias for all
                gradient[ROWS] += error.sum(0)
            else:
                add_rows(column, error, gradient)
            touched += np.bincount(column, minlength=len(touched))
        squares = gradient * gradient
        sums += squares
        np.sqrt(sums, out=squares)
        gradient /= squares
        gradient *= rate
        self.table -= gradient


def powers(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the logits and their sum in each row. Rows out of range are first moved (in place) so
    that their greatest logit is 0; others need not be, as that changes no probability."""
    with np.errstate(over="ignore"):
        out = np.exp(logits)
        total = out @ np.ones(out.shape[1], out.dtype)
    odd = np.flatnonzero(~((total > 1e-20) & (total < 1e20)))
    if len(odd):
        logits[odd] -= logits[odd].max(1, keepdims=True)
        out[odd] = np.exp(logits[odd])
        total[odd] = out[odd].sum(1)
    return out, total


def softmax(logits: np.ndarray) -> np.ndarray:
    out, total = powers(logits)
    out /= total[:, None]
    return out


class Model:
    """Weights of both softmaxes: class rows for hashed features and one bias row; rows of places in
    a class for hashed features with the class, and a bias row for each class."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        n = len(lexicon.sizes)
        self.outer = Softmax(np.zeros((ROWS + 1, n), np.float32))
        self.inner = Softmax(np.zeros((ROWS + n, SLOTS), np.float32))
        self.closed = np.where(np.arange(SLOTS) < lexicon.sizes[:, None], 0, -1e9).astype(np.float32)
        mass = np.zeros(n)
        head = slice(0, lexicon.head)
        np.add.at(mass, lexicon.classes[head], lexicon.counts[head])
        in_head = lexicon.sizes > 0
        for k in range(n):
            if not in_head[k]:
                mass[k] = lexicon.tail_total[lexicon.tail_class == k][:1].sum()
        self.outer.table[ROWS] = np.log((mass + 0.5) / (mass.sum() + 0.5 * n))
        self.inner.table[ROWS + lexicon.classes[head], lexicon.slots[head]] = np.log(lexicon.counts[head] + 0.5)

    @property
    def tables(self) -> list[np.ndarray]:
        return [self.outer.table, self.inner.table]

    @property
    def width(self) -> int:
        return max(t.shape[1] for t in self.tables)

    def batches(self, tokens: Tokens) -> Iterator[tuple]:
        """Per batch its places, classes, class features, which tokens are in the head, slots and slot features."""
        lexicon = self.lexicon
        classes = tokens.by_id(lexicon.classes, lexicon.tail_class[tokens.suffixes])
        for at in range(0, len(tokens.ids), BATCH):
            part = slice(at, at + BATCH)
            a, b = tokens.before(1, part), tokens.before(2, part)
            own = classes[part]
            outer = [np.full(len(own), ROWS, np.uint16), bucket(1, a), bucket(2, a, b), bucket(3, b)]
            head = np.flatnonzero(tokens.ids[part] < lexicon.head)
            group = own[head].astype(np.uint64)
            inner = [(ROWS + own[head]).astype(np.uint16), bucket(4, a[head], group), bucket(5, b[head], group)]
            yield part, own, outer, head, lexicon.slots[tokens.ids[part][head]], inner

    def log_features(self, tokens: Tokens) -> np.ndarray:
        """Natural logarithm of each token's class probability times, for the head, its own in the class."""
        out = np.empty(len(tokens.ids))
        for part, own, outer, head, slots, inner in self.batches(tokens):
            logits = self.outer.logits(outer)
            _, total = powers(logits)
            log = logits[np.arange(len(own)), own].astype(np.float64) - np.log(total)
            if len(head):
                logits = self.inner.logits(inner)
                logits += self.closed.take(own[head], axis=0)
                _, total = powers(logits)
                log[head] += logits[np.arange(len(head)), slots] - np.log(total)
            out[part] = log
        return out

    def learn(self, tokens: Tokens, sums: list[np.ndarray], touched: list[np.ndarray], rate: float) -> None:
        for _, own, outer, head, slots, inner in self.batches(tokens):
            error = softmax(self.outer.logits(outer))
            error[np.arange(len(own)), own] -= 1
            self.outer.learn(outer, error, sums[0], touched[0], rate)
            if len(head):
                logits = self.inner.logits(inner)
                logits += self.closed.take(own[head], axis=0)
                error = softmax(logits)
                error[np.arange(len(head)), slots] -= 1
                self.inner.learn(inner, error, sums[1], touched[1], rate)

    def score(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Per text: tokens, known tokens, base and model score, without what words beyond the lexicon add
        within their class; and those words: (text, word, count) arrays."""
        lexicon, n = self.lexicon, len(texts)
        sums, tail = np.zeros((4, n)), []
        lexicon.prepare()
        if lexicon.share is None:
            lexicon.base, lexicon.share = lexicon.log_base(lexicon.counts), lexicon.log_share()
        for tokens in lexicon.encode(texts):
            none = np.zeros(len(tokens.met))
            known = tokens.ids < tokens.first_met
            log = self.log_features(tokens) / np.log(10) + tokens.by_id(lexicon.share, none)
            for row, values in enumerate((None, known, tokens.by_id(lexicon.base, none), log)):
                sums[row] += np.bincount(tokens.text, values, n)
            beyond = np.flatnonzero(~known)
            pairs, counts = np.unique(tokens.text[beyond] * (len(none) + 1) + tokens.ids[beyond] - tokens.first_met,
                                      return_counts=True)
            tail.append((pairs // (len(none) + 1), pa.array(tokens.met, pa.binary()).take(
                pa.array(pairs % (len(none) + 1), pa.int64())), counts))
        return sums, tail


def nearest(points: np.ndarray, weights: np.ndarray, wanted: int, steps: int = 20) -> np.ndarray:
    """k-means from fixed beginnings: the cluster of each point."""
    centres = [points[np.argmax(weights)]]
    gap = ((points - centres[0]) ** 2).sum(1)
    while len(centres) < min(wanted, len(points)) and (gap * weights).max() > 0:
        centres.append(points[np.argmax(gap * weights)])
        gap = np.minimum(gap, ((points - centres[-1]) ** 2).sum(1))
    centres = np.array(centres)
    for _ in range(steps):
        of = ((centres ** 2).sum(1) - 2 * points @ centres.T).argmin(1)
        for k in range(len(centres)):
            own = of == k
            if own.any():
                centres[k] = np.average(points[own], axis=0, weights=weights[own])
    return of


VECTORS = "key int, n double, vector binary"


def vectors(keys: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int32()), pa.array(weights, pa.float64()), pa.array([r.tobytes() for r in rows], pa.binary())],
        ["key", "n", "vector"])


def added(rows: DataFrame, width: int, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the rows (key, n, vector of ``width`` half floats) of n and of n * vector by key below
    ``kinds``: added up by key in Spark, then a table of fixed size."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            values = np.frombuffer(b"".join(batch.column("vector").to_pylist()), np.float16).reshape(-1, width)
            n = batch.column("n").to_numpy()
            weighted = np.concatenate([values * n[:, None], n[:, None]], 1)
            for key, row in zip(batch.column("key").to_pylist(), weighted, strict=True):
                if key in totals:
                    totals[key] += row
                else:
                    totals[key] = row.copy()
        if totals:
            yield vectors(np.array(list(totals)), np.zeros(len(totals)), np.array(list(totals.values())))

    parts = min(rows.sparkSession.sparkContext.defaultParallelism, 64)
    n, sums = np.zeros(kinds), np.zeros((kinds, width))
    for row in rows.repartition(parts, "key").mapInArrow(work, VECTORS).collect():
        values = np.frombuffer(row.vector, np.float64)
        sums[row.key], n[row.key] = values[:-1], values[-1]
    return n, sums


def lexicon_of(counts: DataFrame) -> Lexicon:
    """The broadcast part of the counted words: all above a count that at most ``VOCABULARY`` reach."""
    level = F.when(F.col("c") < 256, F.col("c")).otherwise(256 + F.floor(16 * F.log2(F.col("c").cast("double"))))
    short = F.octet_length("key") <= KEY_BYTES
    by_level = counts.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("c").alias("tokens"), F.count_if(short).alias("short")).collect()
    tokens, kinds, room, least = sum(r.tokens for r in by_level), sum(r.kinds for r in by_level), VOCABULARY, None
    for row in sorted(by_level, key=lambda r: -r.level):
        room -= row.short
        if room < 0:
            break
        least = row.level
    wanted = F.col("key") == F.lit(END) if least is None else short & ((level >= least) | (F.col("key") == F.lit(END)))
    found = counts.filter(wanted).toArrow()
    rows = sorted(zip(found.column("c").to_pylist(), found.column("key").to_pylist(), strict=True), key=lambda r: (r[1] != END, -r[0], r[1]))
    return Lexicon([w for _, w in rows], np.array([c for c, _ in rows], float), tokens, kinds, min(HEAD, len(rows)))


def neighbours(sent, text: str = "_text"):
    """Counts of the frequent words beside each head word and beside the words of each suffix."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, sums = sent.value, np.zeros((HEAD + SUFFIXES) * NEAR)
        lexicon.prepare()
        numbers = np.arange(len(lexicon.words))
        row = np.where(numbers < lexicon.head, numbers, HEAD + lexicon.suffixes)
        for batch in batches:
            for piece in pieces(batch, text):
                for tokens in lexicon.encode(texts_of(piece, text)):
                    rows = tokens.by_id(row, HEAD + tokens.suffixes) * NEAR
                    beside = np.concatenate([tokens.stream[tokens.places - 1], tokens.ids[1:]])
                    near = np.flatnonzero(beside < min(NEAR, len(lexicon.words)))
                    sums += np.bincount(np.concatenate([rows, rows[:-1]])[near] + beside[near], minlength=len(sums))
        sums = sums.reshape(-1, NEAR)
        some = np.flatnonzero(sums.any(1))
        if len(some):  # shares as half floats, with the total as weight
            total = sums[some].sum(1)
            yield vectors(some, total, (sums[some] / total[:, None]).astype(np.float16))
    return work


def classify(lexicon: Lexicon, counts: DataFrame, beside: np.ndarray) -> None:
    """Set the classes, and of the tail classes the totals and the discount."""
    some = np.flatnonzero(beside.any(1))
    cluster = np.zeros(HEAD + SUFFIXES, np.int64)
    if len(some):
        points = np.sqrt(beside[some] / beside[some].sum(1, keepdims=True))
        cluster[some] = nearest(points, np.sqrt(beside[some].sum(1)), CLUSTERS)
    head = np.arange(lexicon.head)
    lexicon.classes, lexicon.slots, sizes = np.zeros(len(lexicon.words), np.int64), np.zeros(len(lexicon.words), np.int64), []
    for k in range(CLUSTERS):
        own = head[cluster[:lexicon.head] == k]  # most frequent first
        for at in range(0, len(own), SLOTS):
            part = own[at:at + SLOTS]
            lexicon.classes[part], lexicon.slots[part] = len(sizes), np.arange(len(part))
            sizes.append(len(part))
    lexicon.sizes = np.array(sizes + [0] * CLUSTERS)
    lexicon.tail_class = len(sizes) + cluster[HEAD:]
    suffix = (F.crc32(F.substring("key", -3, 3)) % SUFFIXES).cast("int")
    table = np.zeros((SUFFIXES, 4))
    for r in counts.groupBy(suffix.alias("suffix")).agg(
            F.sum("c").alias("c"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("c") == 1).alias("once"),
            F.count_if(F.col("c") == 2).alias("twice")).collect():
        table[r.suffix] = r.c, r.n, r.once, r.twice
    suffixes = lexicon.suffixes
    for i in head:  # the head is not in the tail
        c = lexicon.counts[i]
        table[suffixes[i]] -= c, 1, c == 1, c == 2
    lexicon.classes[lexicon.head:] = lexicon.tail_class[suffixes[lexicon.head:]]
    once, twice = table[:, 2].sum(), table[:, 3].sum()
    lexicon.discount = float(np.clip(once / (once + 2 * twice), 0.1, 0.9)) if once and twice else 0.5
    by_class = np.zeros((len(lexicon.sizes), 2))
    np.add.at(by_class, lexicon.tail_class, table[:, :2])
    lexicon.tail_total, lexicon.tail_kinds = by_class[lexicon.tail_class].T


def one_round(sent, rate: float):
    """A task's share of a round: the updates of the weights it touched."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        starts = [t.copy() for t in model.tables]
        sums, touched = [np.ones_like(t) for t in starts], [np.zeros(len(t)) for t in starts]
        for batch in batches:
            for piece in pieces(batch, "_text"):
                for tokens in model.lexicon.encode(texts_of(piece, "_text")):
                    model.learn(tokens, sums, touched, rate)
        offset = 0
        for table, start, n in zip(model.tables, starts, touched, strict=True):
            hit = np.flatnonzero(n)
            wide = np.zeros((len(hit), model.width), np.float16)
            wide[:, :table.shape[1]] = table[hit] - start[hit]
            for at in range(0, len(hit), 4096):
                yield vectors(offset + hit[at:at + 4096], n[hit[at:at + 4096]], wide[at:at + 4096])
            offset += len(table)
            table[:] = start  # the worker may run another task with this model
    return work


@dataclass
class Trained:
    model: Model
    counts: DataFrame


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, exclude: Column | None = None,
          rounds: int = ROUNDS, rate: float = RATE) -> Trained:
    """Learn from all rows but those that ``exclude`` marks."""
    spark = docs.sparkSession
    rows = docs.filter(~exclude) if exclude is not None else docs
    rows = rows.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = rows.select("_text")
    counts = stage(texts.mapInArrow(count_words, "key binary, n bigint").groupBy("key").agg(F.sum("n").alias("c")),
                   "lm-counts")
    lexicon = lexicon_of(counts)
    if lexicon.tokens:
        sent = spark.sparkContext.broadcast(lexicon)
        _, beside = added(texts.mapInArrow(neighbours(sent), VECTORS), NEAR, HEAD + SUFFIXES)
        sent.unpersist()
        classify(lexicon, counts, beside)
    model = Model(lexicon)
    for turn in range(rounds if lexicon.tokens else 0):
        part = rows.filter(F.pmod(F.xxhash64("_id"), F.lit(rounds)) == turn).select("_text")
        sent = spark.sparkContext.broadcast(model)
        n, sums = added(part.mapInArrow(one_round(sent, rate / (1 + turn)), VECTORS), model.width, sum(map(len, model.tables)))
        sent.unpersist()
        mean = sums / np.maximum(n, 1)[:, None]
        model.outer.table += mean[:ROWS + 1, :model.outer.table.shape[1]].astype(np.float32)
        model.inner.table += mean[ROWS + 1:, :SLOTS].astype(np.float32)
    return Trained(model, counts)


SCORED = "_id {}, _row bigint, n_tokens bigint, n_known bigint, base double, own double, beyond array<struct<key: binary, n: bigint>>"


def score(docs: DataFrame, trained: Trained, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score (log10 of the text's probability) of each row."""
    lexicon = trained.model.lexicon
    sent = docs.sparkSession.sparkContext.broadcast(trained.model)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                       F.monotonically_increasing_id().alias("_row"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text"):
                texts = texts_of(piece, "_text")
                sums, tail = sent.value.score(texts)
                text = np.concatenate([t for t, _, _ in tail])
                order = pa.array(np.argsort(text, kind="stable"))
                words = pa.StructArray.from_arrays(
                    [pa.concat_arrays([w for _, w, _ in tail]).take(order),
                     pa.array(np.concatenate([n for _, _, n in tail]), pa.int64()).take(order)], ["key", "n"])
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(texts)))])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("_id"), piece.column("_row"), pa.array(sums[0].astype(np.int64)),
                     pa.array(sums[1].astype(np.int64)), pa.array(sums[2]), pa.array(sums[3]),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words)],
                    ["_id", "_row", "n_tokens", "n_known", "base", "own", "beyond"])

    if not lexicon.tokens:
        return nothing_learned(rows, id_col)
    found = stage(rows.mapInArrow(work, SCORED.format(rows.schema["_id"].dataType.simpleString())), "lm-scored", compression="zstd")
    spread = docs.sparkSession.createDataFrame(
        [(i, float(np.log10(max(t, 1e-300))), float(u)) for i, (t, u) in enumerate(zip(lexicon.tail_total, lexicon.log_unknown()))],
        "suffix int, _total double, _unknown double")
    suffix = (F.crc32(F.substring("key", -3, 3)) % SUFFIXES).cast("int")
    known = F.col("c").isNotNull()
    floor = F.lit(float(lexicon.tokens + 0.1 * (lexicon.kinds + 1)))
    beyond = found.select("_row", F.explode("beyond").alias("_w")).select("_row", "_w.key", "_w.n").join(
        trained.counts, "key", "left").withColumn("suffix", suffix).join(F.broadcast(spread), "suffix").groupBy("_row").agg(
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("_known"),
        F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + 0.1) / floor)).alias("_base"),
        F.sum(F.col("n") * F.when(known, F.log10(F.col("c") - lexicon.discount) - F.col("_total")).otherwise(
            F.col("_unknown"))).alias("_own"))
    zero = F.lit(0)
    return found.drop("beyond").join(beyond, "_row", "left").select(
        F.col("_id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("_known", zero)).alias("n_known"),
        F.lit(int(lexicon.tokens)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        (F.col("own") + F.coalesce("_own", F.lit(0.0))).alias("score"))


def nothing_learned(rows: DataFrame, id_col: str) -> DataFrame:
    """Tokens are counted; nothing is known."""
    words = F.filter(F.split(F.coalesce("_text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return rows.select(F.col("_id").alias(id_col), (F.size(words) + 1).cast("bigint").alias("n_tokens"),
                       F.lit(0).cast("bigint").alias("n_known"), F.lit(0).cast("bigint").alias("train_tokens"),
                       F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
