"""Jaccard join on word five-grams: MinHash LSH forest, then exact verification.

Documents with the same words are one text (a class of copies); everything below works on
texts. A signature has ``TREES`` * ``DEPTH`` MinHash values. Each tree orders the texts by its
``DEPTH`` values, as a prefix trie; two texts meet in a tree where they share a prefix. The
prefix starts at full depth and is shortened until the expected recall at the threshold,
1 - (1 - s^length)^trees, reaches ``RECALL`` (``prefix_length``).

1. sketch: one pass over the documents gives the key of the words and the signature,
2. forest: prefixes that one text has alone go; texts under a shared prefix are compared by
   signature, in tiles of ``SKETCH_TILE`` texts so that no prefix is one task, and each tile
   returns a spanning forest (as many rows as texts) of those that look alike,
3. blocks: connected components of these forests; only their texts are read again,
4. verification: within a block, by tiles of ``TILE``, the exact sets of five-grams are compared; a
   tile returns each text's number of links and a spanning forest of the true links. Pairs are
   never written out, and no number of partners is cut off.

Result, one row per document: class_id (smallest id among the documents joined by links or
copies), n_copies (documents with the same words), n_links (other texts with a similarity of
``THRESHOLD`` or more), kept (the document has its class's id).

Edge cases. Texts of one to four words have one shingle, all their words. Null and texts
without a word are copies of each other and have no links. Rows that repeat an id are
documents of their own; null ids are allowed, and give a class its id only where it has no
other. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import by_pieces, drop_staged, stage, texts_of, words
from noticeflow.llm.components import components
from noticeflow.llm.membership import bitmap, probe

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 8
RECALL = 0.999
TILE = 256
#: Texts under one prefix that are compared by signature in one piece.
SKETCH_TILE = 1024
#: Signature agreement from which texts are put in one block, and from which a pair in a
#: block is compared exactly: 0.8 less 5 and 8 standard deviations of the estimate.
BLOCK_CUT, PAIR_CUT = 0.62, 0.5

MIX = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers: each orders the shingle hashes in its own way.
ORDERS = np.random.default_rng(2024).integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x2545F4914F6CDD1D


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix that reaches the recall, one value at least."""
    for length in range(depth, 1, -1):
        if 1 - (1 - threshold ** length) ** trees >= recall:
            return length
    return 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, made as far as needed."""

    def __init__(self, base: int = BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def ranges(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each data[start:end]."""
        self.need(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=sums[1:])
        return mixed((sums[end] - sums[start]) * self.down[start])


POWERS = Powers()


def word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def shingles(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-grams of all texts (each a non-empty list of words), and the place of
    each text's first. Words are hashed with BLAKE2b, once each, and their hashes mixed one after the
    other, so that no two five-grams that differ are made equal by the form of the hash."""
    codes = {w: word_hash(w) for w in set().union(*texts)}
    data = np.fromiter(map(codes.__getitem__, chain.from_iterable(texts)), np.uint64)
    counts = np.array([len(t) for t in texts])
    own = np.maximum(counts - SHINGLE + 1, 1)
    first = np.concatenate([[0], np.cumsum(own)])[:-1]
    word = np.repeat(np.cumsum(counts) - counts, own) + np.arange(own.sum()) - np.repeat(first, own)
    span = np.repeat(np.minimum(counts, SHINGLE), own)
    out = span.astype(np.uint64)
    for k in range(SHINGLE):
        inside = np.flatnonzero(k < span)
        out[inside] = mixed(out[inside] * MIX + data[word[inside] + k])
    return out, first


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the smallest value of each order, a row for each text."""
    out = np.empty((len(first), len(ORDERS)), np.uint32)
    for k, order in enumerate(ORDERS):
        out[:, k] = np.minimum.reduceat(hashes * order, first) >> np.uint64(32)
    return out


def alike(sigs: np.ndarray, others: np.ndarray, cut: float) -> np.ndarray:
    """Which pairs of rows agree in at least that share of values."""
    out = np.empty((len(sigs), len(others)), bool)
    step = max(1, (1 << 21) // max(1, others.size))
    for a in range(0, len(sigs), step):
        same = (sigs[a:a + step, None, :] == others[None, :, :]).sum(2, dtype=np.int32)
        out[a:a + step] = same >= cut * sigs.shape[1]
    return out


def roots(linked: np.ndarray) -> np.ndarray:
    """The first member of each row's component of a symmetric relation."""
    label = np.arange(len(linked))
    while True:
        low = np.minimum(label, np.where(linked, label, len(label)).min(1, initial=len(label)))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of sorted batches, one after the other."""
    held: list[pa.RecordBatch] = []
    mark = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        marks = list(zip(*columns, strict=True))
        start = 0
        for i, m in enumerate(marks):
            if m != mark:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, mark = [], i, m
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key (hash of the words), signature (null without a word)."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = [words(t) for t in texts_of(batch, "text")]
        keys = [hashlib.blake2b(" ".join(w).encode(), digest_size=16).digest() for w in lists]
        full = [w for w in lists if w]
        sigs = iter(signatures(*shingles(full)) if full else ())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(keys, pa.binary()),
             pa.array([next(sigs).tobytes() if w else None for w in lists], pa.binary())],
            ["doc_id", "key", "signature"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(by_pieces(work, "text"), f"doc_id {kind}, key binary, signature binary")


def tiled(rows: DataFrame, by: str, size: str, tile: int) -> DataFrame:
    """Deal the members of each group to pairs of tiles: a row for every tile that a member's
    tile is compared with. ``tile`` is the member's own, (x, y) the pair."""
    count = F.greatest(F.lit(1), F.ceil(F.col(size) / tile)).cast("int")
    own = rows.withColumn("tile", F.pmod(F.xxhash64("key"), count).cast("int"))
    return own.withColumn("_other", F.explode(F.sequence(F.lit(0), count - 1))).select(
        by, F.least("tile", "_other").alias("x"), F.greatest("tile", "_other").alias("y"),
        *[c for c in own.columns if c not in (by, size)])


def pairs_of(group: pa.Table, relation: np.ndarray) -> np.ndarray:
    """Leave only the pairs that this pair of tiles is there for."""
    x, y = group.column("x")[0].as_py(), group.column("y")[0].as_py()
    if x != y:
        tile = np.array(group.column("tile").to_pylist())
        relation &= tile[:, None] != tile[None, :]
    np.fill_diagonal(relation, False)
    return relation


def look_alike(batches):
    """Spanning forests (a, b) of the texts of each tile pair that look alike."""
    def forest():
        for group in runs(batches, ["prefix", "x", "y"]):
            keys = group.column("key").to_pylist()
            sigs = np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(len(keys), -1)
            root = roots(pairs_of(group, alike(sigs, sigs, BLOCK_CUT)))
            yield from ((keys[i], keys[r]) for i, r in enumerate(root.tolist()) if i != r)

    rows = []
    for row in forest():
        rows.append(row)
        if len(rows) == 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows, strict=True)], ["a", "b"])
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows, strict=True)], ["a", "b"])


def wanted_sets(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """The sorted set of shingles of each text that is the one looked for."""
    lists = [words(t) for t in texts_of(batch, "text")]
    wanted = batch.column("key").to_pylist()
    keep = [i for i, w in enumerate(lists)
            if w and hashlib.blake2b(" ".join(w).encode(), digest_size=16).digest() == wanted[i]]
    if not keep:
        return None
    hashes, first = shingles([lists[i] for i in keep])
    sets = [np.unique(h).tobytes() for h in np.split(hashes, first[1:])]
    return pa.RecordBatch.from_arrays(
        [batch.column("block").take(pa.array(keep)), batch.column("size").take(pa.array(keep)),
         batch.column("key").take(pa.array(keep)), pa.array(sets, pa.binary())], ["block", "size", "key", "shingles"])


def true_links(batches, threshold: float):
    """For each tile pair, every text's exact number of links and the root of its links."""
    for group in runs(batches, ["block", "x", "y"]):
        members = dict(zip(group.column("key").to_pylist(), range(group.num_rows), strict=True))
        group = group.take(pa.array(list(members.values())))
        sets = [np.frombuffer(s, np.uint64) for s in group.column("shingles").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        sigs = signatures(np.concatenate(sets), np.cumsum(sizes) - sizes)
        near = pairs_of(group, alike(sigs, sigs, PAIR_CUT))
        near &= np.minimum.outer(sizes, sizes) >= threshold * np.maximum.outer(sizes, sizes)
        linked = np.zeros_like(near)
        for i, j in zip(*np.nonzero(np.triu(near)), strict=True):
            common = np.intersect1d(sets[i], sets[j], assume_unique=True).size
            linked[i, j] = linked[j, i] = common >= threshold * (sizes[i] + sizes[j] - common) - 1e-9
        keys, root = list(members), roots(linked)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(linked.sum(1), pa.int64()),
             pa.array([keys[r] for r in root.tolist()], pa.binary())], ["key", "links", "root"])


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_copies, n_links, kept for each row of ``docs``."""
    length = prefix_length(threshold)
    sketches = stage(sketch(docs, id_col, text_col), "sketches")
    texts = stage(sketches.groupBy("key").agg(
        F.first("signature").alias("signature"), F.count(F.lit(1)).alias("n_copies"),
        F.min("doc_id").alias("first_id")), "texts")

    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    prefixes = texts.filter("signature is not null").select("key", "signature", tree.alias("_tree")).select(
        F.xxhash64("_tree", F.expr(f"substring(signature, _tree * {4 * DEPTH} + 1, {4 * length})")).alias("prefix"), "key")
    shared = stage(prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), "prefixes")
    members = stage(prefixes.join(shared, "prefix"), "members")
    drop_staged(shared)
    met = tiled(members.join(texts.select("key", "signature"), "key"), "prefix", "size", SKETCH_TILE)
    met = met.repartition("prefix", "x", "y").sortWithinPartitions("prefix", "x", "y", "key")
    blocks = components(met.mapInArrow(look_alike, "a binary, b binary"))
    drop_staged(members)

    sizes = stage(blocks.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "blocks")
    wanted = stage(blocks.join(sizes, "label").join(texts.select(F.col("key").alias("node"), "first_id"), "node").select(
        F.col("label").alias("block"), "size", F.col("node").alias("key"), "first_id"), "wanted")
    # Only documents that may be wanted move for the join; most texts have no neighbour.
    known = stage(bitmap(wanted, "_known", "first_id"), "ids")
    read = probe(docs.select(F.col(id_col).alias("first_id"), F.col(text_col).alias("text")), known, "_known", "first_id")
    read = read.filter("_known").withColumnRenamed("first_id", "doc_id").select("doc_id", "text").join(
        wanted, F.col("doc_id").eqNullSafe(F.col("first_id"))).select("block", "size", "key", "text")
    sets = read.mapInArrow(by_pieces(wanted_sets, "text"), "block binary, size long, key binary, shingles binary")
    dealt = tiled(sets, "block", "size", TILE).repartition("block", "x", "y").sortWithinPartitions("block", "x", "y", "key")
    linked = stage(dealt.mapInArrow(lambda batches: true_links(batches, threshold), "key binary, links long, root binary"), "links")
    drop_staged(wanted)
    drop_staged(known)
    drop_staged(sizes)
    drop_staged(blocks)

    joined = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("key").agg(F.sum("links").alias("n_links"))
    found = texts.select("key", "n_copies", "first_id").join(counts, "key", "left").join(
        joined.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    found = stage(found, "found")
    classes = stage(found.groupBy("label").agg(F.min("first_id").alias("class_id")), "classes")
    per_text = stage(found.join(classes, "label").select(
        "key", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "per-text")
    for done in (texts, linked, joined, found, classes):
        drop_staged(done)
    return sketches.select("doc_id", "key").join(per_text, "key").select(
        "doc_id", "class_id", "n_copies", "n_links", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))
