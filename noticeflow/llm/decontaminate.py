"""Benchmark decontamination: pigeonhole pieces, then Myers' bit-parallel edit distance.

Texts are lower-cased and reduced to words with single spaces. An item of n characters may be
found with up to k = floor(``error_rate`` * n) edits. It is cut into k + 1 pieces: whatever the
k edits are, at least one piece is untouched, so every occurrence holds an exact piece hit.
All pieces are searched in one walk over a document; around the hits, the windows that the
item could reach are joined where they overlap and searched with Myers' algorithm.

The benchmark is the query set: it is taken in blocks of at most ``BLOCK_CHARS`` characters
(or one item), each block goes to the executors once and is held against all rows.

Edge cases. Null and empty texts and items (also those without a word) match nothing; an item
too short for an edit has to occur exactly, with whole words. Repeated items and documents
give a row each. A null item id stays null. An empty benchmark gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import by_pieces, texts_of, words

ERROR_RATE = 0.06
BLOCK_CHARS = 4_000_000


def normalized(text: str | None) -> str:
    """Words with a space before, between and after them; empty without a word."""
    found = words(text or "")
    return f" {' '.join(found)} " if found else ""


def cut(text: str, count: int) -> list[tuple[int, str]]:
    """``count`` pieces of almost the same length, with their offsets."""
    edges = [len(text) * i // count for i in range(count + 1)]
    return [(a, text[a:b]) for a, b in zip(edges, edges[1:])]


def letter_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_end(masks: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """Smallest edit distance of the pattern to a substring of ``text``, and the end of the
    first substring that has it (Myers 1999, search form)."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for at, c in enumerate(text, 1):
        equal = masks.get(c, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, at
    return best, end


@dataclass(frozen=True)
class Item:
    item_id: object
    text: str
    budget: int


class Matcher:
    def __init__(self, items: list[Item]):
        self.items = items
        self.masks = [letter_masks(i.text) for i in items]
        self.back = [letter_masks(i.text[::-1]) for i in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(items):
            for offset, piece in cut(item.text, item.budget + 1):
                places.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """By item, the joined stretches of ``text`` in which it could occur."""
        found: dict[int, list[list[int]]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for n, offset in where:
                item = self.items[n]
                start = max(0, last + 1 - size - offset - item.budget)
                end = last + 1 - size - offset + len(item.text) + item.budget
                own = found.setdefault(n, [])
                if own and start <= own[-1][1] and own[-1][0] <= start:
                    own[-1][1] = max(own[-1][1], end)
                else:
                    own.append([start, end])
        return found

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the best occurrence of each item in ``text``."""
        out = []
        for n, spans in self.windows(text).items() if self.items and text else ():
            item, best = self.items[n], None
            for start, end in sorted(spans):
                distance, stop = best_end(self.masks[n], len(item.text), text[start:end])
                if distance <= item.budget and (best is None or distance < best[0]):
                    best = (distance, start, start + stop)
            if best:
                _, length = best_end(self.back[n], len(item.text), text[best[1]:best[2]][::-1])
                out.append((n, best[0], best[2] - length, best[2]))
        return out


_MATCHERS: dict[str, Matcher] = {}


def matcher(items: list[Item]) -> Matcher:
    """The worker's matcher of a block; one block is kept."""
    key = hashlib.sha256(repr(items).encode()).hexdigest()
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = Matcher(items)
    return _MATCHERS[key]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               item_id_col: str = "item_id", item_text_col: str = "text",
               error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document and item that occurs in it: doc_id, item_id, distance, and
    match_start, match_end in the document's normalised text."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id_col).alias("item_id"), F.col(item_text_col).alias("text"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in [rows.schema["doc_id"], items.schema["item_id"]]}
    schema = (f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, distance int, "
              "match_start long, match_end long")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-2 * chars // block_chars) or 1

    def search(block: int) -> DataFrame:
        held = [Item(r.item_id, text, int(error_rate * len(text))) for r in items.filter(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
            if (text := normalized(r.text))]
        sent = spark.sparkContext.broadcast(held)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            search = matcher(sent.value)
            out = [(d, search.items[m[0]].item_id, *m[1:])
                   for d, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text"), strict=True)
                   for m in search.matches(normalized(text))]
            if not out:
                return None
            doc, item, *numbers = map(list, zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, batch.schema.field("doc_id").type), pa.array(item),
                 pa.array(numbers[0], pa.int32()), pa.array(numbers[1], pa.int64()), pa.array(numbers[2], pa.int64())],
                ["doc_id", "item_id", "distance", "match_start", "match_end"])

        return rows.mapInArrow(by_pieces(work, "text"), schema)

    found = search(0)
    for block in range(1, blocks):
        found = found.unionByName(search(block))
    return found
