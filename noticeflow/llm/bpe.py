"""Byte-level BPE: encoding with a contiguous rank array, and decoding.

A text is cut at its special tokens, then at every space that a non-space follows (no token
of the split pattern crosses such a place), so that most of it is looked up as
space-separated pieces in a bounded cache. The unknown pieces of a batch are cut by the pattern
in one go, and its unknown words are merged together: a word is a column of part ids, beside it
the column of ranks of adjacent parts. Each round finds the smallest rank of every word (the
leftmost of equals), deletes that boundary by moving the rest of both columns up by one place,
and looks up anew only the two ranks beside the merge. Words that have no rank left leave the
array. Words over ``LONG_WORD`` bytes use a heap of ranks instead, as repeated scans would be
quadratic.

Edge cases. Null counts as empty and gives no ids. Special tokens in a text become their own
id. Ids may repeat; every row gives one row. Extra columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.llm.common import by_pieces, texts_of

#: Split pattern of byte-level BPE with its usual contractions (fixed value of the format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of a word up to which ranks are kept in an array that is scanned.
LONG_WORD = 64
#: A rank and its place in a word of at most ``LONG_WORD`` bytes are one number: these are the place's bits.
PLACE_BITS = 6
#: Slots of the hash table of pairs, as a power of two.
PAIR_BITS = 18
#: Words are merged together with those up to this many bytes shorter.
SIZE_STEP = 4
#: Pieces that a worker keeps, words of letters among them; when full, the cache starts anew.
CACHE_ENTRIES = 265_000
NO_RANK = np.int32(2**24)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in plain else next(other)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """What a worker needs: a few MB, as large as the vocabulary file."""

    token_bytes: list[bytes]
    byte_ids: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    merged: np.ndarray
    specials: dict[str, int]
    digest: str


def load_vocabulary(path: str) -> Vocabulary:
    """Read a ``tokenizers`` JSON file of a byte-level BPE model."""
    with open(path, "rb") as f:
        raw = f.read()
    spec = json.loads(raw)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    symbols = byte_symbols()
    value = {s: b for b, s in enumerate(symbols)}
    specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
    token_bytes = [b""] * (max([*vocab.values(), *specials.values()]) + 1)
    for token, i in vocab.items():
        token_bytes[i] = bytes(value[c] for c in token) if token not in specials else token.encode()
    for token, i in specials.items():
        token_bytes[i] = token.encode()
    split = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
    keys = np.array([vocab[a] << 20 | vocab[b] for a, b in split], dtype=np.int64)
    order = np.argsort(keys)
    return Vocabulary(
        token_bytes, np.array([vocab[s] for s in symbols], dtype=np.int32), keys[order],
        order.astype(np.int32), np.array([vocab[a + b] for a, b in split], dtype=np.int32),
        specials, hashlib.sha256(raw).hexdigest())


class Known(dict):
    """Ids by piece; a piece that is not there is noted and gives an array of bytes to be filled."""

    missed: list[str]

    def __missing__(self, piece: str) -> bytearray:
        self.missed.append(piece)
        self[piece] = hole = bytearray()
        return hole


class Encoder:
    def __init__(self, vocabulary: Vocabulary, cache_entries: int = CACHE_ENTRIES):
        self.v = vocabulary
        self.pattern = regex.compile(PATTERN)
        self.cache_entries = cache_entries
        self.known = Known()
        self.words: dict[str, bytes] = {}
        self.special = re.compile("(" + "|".join(map(re.escape, vocabulary.specials)) + ")") \
            if vocabulary.specials else None
        self.odd_space = re.compile(r" (?!\S)")
        self.cut = re.compile(r" (?=\S)")
        # Of each slot: one of its pairs, and whether there are more.
        slots = self.slot_of(vocabulary.pair_keys)
        self.pair_at = np.zeros(1 << PAIR_BITS, np.int32)
        self.pair_at[slots] = np.arange(len(slots))
        self.crowded = np.bincount(slots, minlength=1 << PAIR_BITS) > 1
        every = vocabulary.byte_ids.astype(np.int32)
        self.byte_ranks = self.ranks_of(np.repeat(every, 256), np.tile(every, 256))

    def slot_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PAIR_BITS)).view(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.v.pair_keys):
            return np.full(left.shape, NO_RANK)
        key = left.astype(np.int64) << 20 | right
        slot = self.slot_of(key)
        at = self.pair_at.take(slot)
        there = self.v.pair_keys.take(at) == key
        other = np.flatnonzero(~there & self.crowded.take(slot))
        if len(other):
            at[other] = np.minimum(np.searchsorted(self.v.pair_keys, key[other]), len(self.v.pair_keys) - 1)
            there[other] = self.v.pair_keys[at[other]] == key[other]
        return np.where(there, self.v.pair_ranks.take(at), NO_RANK)

    def merge_rows(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian, 32 bits) of words of at most ``LONG_WORD`` bytes, shorter ones padded."""
        count = np.fromiter(map(len, words), np.int64, len(words))
        size = int(count.max())
        letters = np.ascontiguousarray(np.array(words, f"S{size}").view(np.uint8).reshape(len(words), size).T)
        ids = self.v.byte_ids[letters]
        out: list[bytes] = [b""] * len(words)
        where, place = np.arange(len(words)), np.arange(size, dtype=np.int32)[:, None]
        none = NO_RANK << PLACE_BITS
        ranks = self.byte_ranks[letters[:-1].astype(np.int32) << 8 | letters[1:]] << PLACE_BITS
        ranks = np.where(place[:-1] < count - 1, ranks, none) | place[:-1]
        while True:
            width = len(ranks)
            low = ranks.min(axis=0, initial=none)
            done = low >= none
            if done.any():
                flat, step = np.ascontiguousarray(ids.compress(done, axis=1).T, dtype="<u4").tobytes(), 4 * (width + 1)
                for k, (w, c) in enumerate(zip(where[done].tolist(), count[done].tolist(), strict=True)):
                    out[w] = flat[k * step:k * step + 4 * c]
                go = np.flatnonzero(~done)
                ids, ranks, where, low, count = ids.take(go, axis=1), ranks.take(go, axis=1), where[go], low[go], count[go]
            n = len(where)
            if not n:
                return out
            count, place, best = count - 1, place[:width], low & ((1 << PLACE_BITS) - 1)
            # Places in the arrays as they are in memory.
            at = best * np.int64(n) + np.arange(n)
            ids.reshape(-1)[at] = self.v.merged[low >> PLACE_BITS]
            ids = np.where(place <= best, ids[:-1], ids[1:])
            ranks = np.where(place[:-1] < best, ranks[:-1], ranks[1:] - 1)
            if width > 1:
                left, right = np.flatnonzero(best > 0), np.flatnonzero(best < count - 1)
                at = np.concatenate([at[left] - n, at[right]])
                there = np.concatenate([best[left] - 1, best[right]])
                parts = ids.reshape(-1)
                ranks.reshape(-1)[at] = self.ranks_of(parts.take(at), parts.take(at + n)) << PLACE_BITS | there

    def merge_long(self, word: bytes) -> bytes:
        ids = self.v.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.ranks_of(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NO_RANK]
        heapq.heapify(heap)
        seen: dict[tuple[int, int], int] = {}

        def push(i: int) -> None:
            if i < 0 or following[i] >= n:
                return
            pair = (ids[i], ids[following[i]])
            if pair not in seen:
                seen[pair] = int(self.ranks_of(np.array([pair[0]]), np.array([pair[1]]))[0])
            if seen[pair] != NO_RANK:
                heapq.heappush(heap, (seen[pair], i, *pair))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = following[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.v.merged[rank]), -1
            following[i] = following[j]
            if following[i] < n:
                before[following[i]] = i
            push(before[i])
            push(i)
        return np.array([x for x in ids if x >= 0], dtype="<u4").tobytes()

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word."""
        kinds = -(-np.fromiter(map(len, words), np.int64, len(words)) // SIZE_STEP)
        out: list[bytes] = [b""] * len(words)
        for kind in np.unique(kinds).tolist():
            places = np.flatnonzero(kinds == kind).tolist()
            group = [words[k] for k in places]
            ids = [self.merge_long(w) for w in group] if kind * SIZE_STEP > LONG_WORD else self.merge_rows(group)
            for k, x in zip(places, ids, strict=True):
                out[k] = x
        return out

    def learn(self, pieces: list[str], first: list[str]) -> dict[str, bytes]:
        """Keep the ids of pieces that follow a space, and give those of other words. A piece of letters is
        one word, which is kept as a piece only. The others are cut by the pattern, all at once: no word crosses
        a space before a non-space, and without other spaces, a word that begins with one begins a piece."""
        known = self.known
        plain = list(map(str.isalpha, pieces))
        letters = list(compress(pieces, plain))
        others = [p for p, x in zip(pieces, plain, strict=True) if not x and " " not in p]
        odd = [p for p in pieces if " " in p]
        cut = self.pattern.findall(" " + " ".join(others)) if others else []
        odd_cut = [self.pattern.findall(" " + p) for p in odd]
        words = set(cut).union(first, *odd_cut)
        after = [w for w in words if w[0] == " " and w[1:].isalpha()]
        cores, other = [w[1:] for w in after], list(words.difference(after))
        fresh = [*letters, *(p for p in cores if p not in known)]
        new = [w for w in other if w not in self.words]
        ids = self.merge([b" " + p.encode() for p in fresh] + [w.encode() for w in new])
        self.fill(letters, ids[:len(letters)])
        known.update(zip(fresh[len(letters):], ids[len(letters):]))
        self.words.update(zip(new, ids[len(fresh):], strict=True))
        own = dict(zip(after, map(known.__getitem__, cores), strict=True))
        own.update(zip(other, map(self.words.__getitem__, other), strict=True))
        parts = list(map(own.__getitem__, cut))
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        begins = np.fromiter(map(str.startswith, cut, repeat(" ")), bool, len(cut))
        flat = b"".join(parts)
        bounds = [*np.append(0, ends)[:-1][begins].tolist(), len(flat)]
        self.fill(others, [flat[a:b] for a, b in zip(bounds, bounds[1:])])
        self.fill(odd, [b"".join(map(own.__getitem__, c)) for c in odd_cut])
        return own

    def fill(self, pieces: list[str], ids: list[bytes]) -> None:
        """The ids of missed pieces, also where they are already in use."""
        for hole, x in zip(map(self.known.__getitem__, pieces), ids, strict=True):
            hole += x
        self.known.update(zip(pieces, ids))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        was_on = gc.isenabled()
        gc.disable()  # nothing here is cyclic; collections would walk the whole cache
        try:
            return self._encode(texts)
        except BaseException:
            self.known.clear()  # some of it may not be filled
            raise
        finally:
            if was_on:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.cache_entries:
            self.known.clear()
            self.words.clear()
        self.known.missed = missed = []
        found: list[list[bytes | bytearray]] = []
        starts: list[tuple[list[bytes | bytearray], int, list[str]]] = []
        for text in texts:
            values: list[bytes | bytearray] = []
            segments = self.special.split(text) if self.special and self.special.search(text) else [text]
            for s in segments:
                if len(segments) > 1 and s in self.v.specials:
                    values.append(self.v.specials[s].to_bytes(4, "little"))
                elif s:
                    parts = self.cut.split(s) if self.odd_space.search(s) else s.split(" ")
                    if parts[0]:
                        starts.append((values, len(values), self.pattern.findall(parts[0])))
                        values.append(b"")
                    values += map(self.known.__getitem__, parts[1:])
            found.append(values)
        ids = self.learn(missed, [w for *_, words in starts for w in words])
        for values, at, words in starts:
            values[at] = b"".join(map(ids.__getitem__, words))
        return [b"".join(values) for values in found]

    def decode(self, ids: bytes) -> str:
        table = self.v.token_bytes
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def encoder(vocabulary: Vocabulary, cache_entries: int = CACHE_ENTRIES) -> Encoder:
    """The worker's encoder; its cache outlives a task."""
    if vocabulary.digest not in _ENCODERS:
        _ENCODERS[vocabulary.digest] = Encoder(vocabulary)
    _ENCODERS[vocabulary.digest].cache_entries = cache_entries
    return _ENCODERS[vocabulary.digest]


def forget() -> None:
    """Drop the worker's encoders with their caches, where later work of a job needs the memory."""
    _ENCODERS.clear()


def shared(spark: SparkSession, path: str):
    """The vocabulary for all executors: a table of fixed size read from ``path``."""
    return spark.sparkContext.broadcast(load_vocabulary(path))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (binary, 32 bits little-endian each), decoded."""
    vocabulary = shared(docs.sparkSession, path)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(vocabulary.value)
        ids = enc.encode(texts_of(batch, "text"))
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array(ids, pa.binary()), pa.array([enc.decode(x) for x in ids], pa.string())],
            ["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(by_pieces(work, "text"), f"doc_id {kind}, n_tokens long, ids binary, decoded string")


def encode(docs: DataFrame, path: str, text_col: str = "text", into: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of the text as an array of integers in the column ``into``."""
    vocabulary = shared(docs.sparkSession, path)
    kept = [c for c in docs.columns if c != into]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = encoder(vocabulary.value).encode(texts_of(batch, text_col))
        ends = np.cumsum([0, *[len(x) // 4 for x in ids]], dtype=np.int32)
        flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), flat)], [*kept, into])

    rows = docs.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(by_pieces(work, text_col), f"{schema}, `{into}` array<int>")


def decode(rows: DataFrame, path: str, ids_col: str = "token_ids", into: str = "text") -> DataFrame:
    """``rows`` with the text of an array of ids in the column ``into``; null ids give null."""
    vocabulary = shared(rows.sparkSession, path)
    kept = [c for c in rows.columns if c != into]

    def run(batches):
        for batch in batches:
            enc = encoder(vocabulary.value)
            texts = [None if x is None else enc.decode(np.array(x, "<u4").tobytes())
                     for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*kept, into])

    source = rows.select(*kept)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    return source.mapInArrow(run, f"{schema}, `{into}` string")
