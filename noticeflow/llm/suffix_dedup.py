"""Removal of repeated byte strings: blockwise suffix sorting with a difference cover.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts anywhere else, in any
text. Every start of such a string is a suffix to be ordered. Suffixes are dealt to buckets by
content that equal strings must share, the buckets are sorted one at a time, and equal
strings end up side by side.

Buckets. Of the 32-byte grams of a string, the one with the smallest hash (the leftmost of
equals) is its anchor. Starts in a row with one anchor, in one half of the string, form a
segment; they all contain the same 216 bytes beside the anchor, whose hash is the bucket's
group. Equal strings always have the same group; a collision only puts more into a bucket. A group
with one segment is done: nothing in it repeats. Segments of equal content, told by 16 bytes of
BLAKE2b over all of it, are counted, not sorted: twice the same content means that every start
in it repeats. Only groups with several contents are sorted, one copy of each content.

Sorting a bucket. Suffixes at the positions of a difference cover modulo 31 are ranked first,
by 32 bytes and then by doubling, to a depth of over ``LENGTH``. The starts are sorted by their
first 32 bytes. For any two starts the cover has a shift below 31 that takes both to ranked
positions, so a tie is settled by two ranks however long it is. Neighbours in this order are
compared over all ``LENGTH`` bytes. Memory is bounded by the bucket, ``BUCKET_BYTES``. A group of
more than ``HOT`` contents, which may not fit a task, is split by single starts instead: 16 bytes
of BLAKE2b over their ``LENGTH`` bytes are counted by Spark.

Edge cases. Null counts as empty; texts under ``LENGTH`` bytes lose nothing. Texts that are
equal are one text with several rows. Rows that repeat an id give a row each, null ids too. An
empty table gives no rows; extra columns are not read. A text is worked on whole; one of more than
``LONGEST`` bytes is an error, not cut.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import by_pieces, drop_staged, stage
from noticeflow.llm.membership import bitmap, probe
from noticeflow.llm.ngram_join import POWERS, mixed, runs

LENGTH = 400
GRAM = 32
GRAMS = LENGTH - GRAM + 1
#: Anchors this far from the start of a string, or farther, are in its second half.
HALF = 185
#: Place of a gram in a piece: the low bits beside its hash, so that a minimum has both.
PLACE = np.uint64((1 << 30) - 1)
BUCKET_BYTES = 4 << 20
HOT = 4096
PERIOD, COVER = 31, np.array([1, 5, 11, 24, 25, 27])
LONGEST = 1 << 30


def shifts() -> np.ndarray:
    """For two residues, the smallest shift that takes both into the cover."""
    inside = np.isin(np.arange(PERIOD), COVER)
    out = np.full((PERIOD, PERIOD), -1)
    for d in range(PERIOD - 1, -1, -1):
        own = inside[(np.arange(PERIOD) + d) % PERIOD]
        out[np.outer(own, own)] = d
    assert (out >= 0).all()
    return out


SHIFT = shifts()
NTH = np.searchsorted(COVER, np.arange(PERIOD))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row."""
    n = len(values)
    size = -(-n // width) * width
    full = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = values
    rows = full.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def content_hash(data: memoryview) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def segments(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Segments of the texts data[bounds[i]:bounds[i + 1]]: text, group, content, start (in
    the text), number of starts."""
    hashes = POWERS.ranges(data, np.arange(len(data) - GRAM + 1), np.arange(GRAM, len(data) + 1))
    at = np.arange(len(hashes), dtype=np.uint64)
    anchor = (smallest((hashes & ~PLACE) | at, GRAMS) & PLACE).astype(np.int64)
    start = np.arange(len(anchor))
    late = anchor - start >= HALF
    text = np.searchsorted(bounds, start, "right") - 1
    whole = start + LENGTH <= bounds[text + 1]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (late[1:] != late[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new & whole)
    turn = np.flatnonzero(new | ~whole)
    end = np.append(turn, len(start))[np.searchsorted(turn, first, "right")]
    place, second = anchor[first], late[first]
    common = np.where(second, place - HALF, place)
    group = mixed(POWERS.ranges(data, common, np.where(second, place + GRAM, place + LENGTH - HALF + 1)) * np.uint64(2)
                  + second.astype(np.uint64))
    view = memoryview(data)
    content = np.array([content_hash(view[a:b]) for a, b in zip(first.tolist(), (end - 1 + LENGTH).tolist(), strict=True)], "V16")
    return text[first], group.view(np.int64), content, first - bounds[text[first]], end - first


def find_segments(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The segments of each text, equal contents of a text as one row with all their starts: a
    text that repeats a word over and over has few rows."""
    raw = [t.encode() for t in batch.column("text").to_pylist()]
    sizes = np.array([len(r) for r in raw])
    if sizes.max(initial=0) > LONGEST:
        raise ValueError(f"a text of {sizes.max()} bytes; at most {LONGEST} can be searched for repeats")
    counts = np.zeros(len(raw), np.int64)
    group = start = n = first = np.zeros(0, np.int64)
    content = np.zeros(0, "V16")
    long = np.flatnonzero(sizes >= LENGTH)
    if len(long):
        bounds = np.concatenate([[0], np.cumsum(sizes[long])])
        text, group, content, start, n = segments(np.frombuffer(b"".join(raw[i] for i in long.tolist()), np.uint8), bounds)
        halves = content.view(np.int64).reshape(-1, 2)
        order = np.lexsort((start, halves[:, 0], halves[:, 1], text))
        text, group, content, start, n = (x[order] for x in (text, group, content, start, n))
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (content[1:] != content[:-1])
        first = np.flatnonzero(new)
        counts[long] = np.bincount(text[first], minlength=len(long))
    starts = pa.ListArray.from_arrays(pa.array(np.append(first, len(start)).astype(np.int32)), pa.array(start.astype(np.int32)))
    rows = pa.StructArray.from_arrays(
        [pa.array(group[first]), pa.array(content[first].tolist(), pa.binary()), pa.array(n[first].astype(np.int32)), starts],
        ["group", "content", "n", "starts"])
    ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("key"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, rows)],
        ["doc_id", "key", "n_bytes", "segments"])


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number that sorts like them; ``data`` ends
    with at least eight bytes of padding."""
    out = np.zeros(len(data) - 8, np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | data[k:len(data) - 8 + k]
    return out


def cover_ranks(words: np.ndarray, positions: int) -> np.ndarray:
    """Ranks of the suffixes at the cover's positions, by their first 497 bytes. The cover has
    six places a period, so the suffix 31 bytes on is six entries on."""
    at = (np.arange(0, positions + PERIOD, PERIOD)[:, None] + COVER).ravel()
    prefix = [words[at + k] for k in (24, 16, 8, 0)]
    order = np.lexsort(prefix)
    new = np.zeros(len(at), np.int64)
    for w in prefix:
        new[1:] |= w[order][1:] != w[order][:-1]
    rank = np.empty(len(at), np.int64)
    rank[order] = np.cumsum(new)
    step = len(COVER)
    for _ in range(4):
        after = np.zeros(len(at), np.int64)
        after[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(at) + 2) + after, return_inverse=True)[1]
        step *= 2
    return rank


def repeated_starts(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of the starts have the same LENGTH bytes as another start."""
    padded = np.concatenate([data, np.zeros(640, np.uint8)])
    words = eights(padded)
    ranks = cover_ranks(words, len(data))

    def rank(at: np.ndarray) -> np.ndarray:
        return ranks[at // PERIOD * len(COVER) + NTH[at % PERIOD]]

    prefix = [words[start + k] for k in (24, 16, 8, 0)]
    order = np.lexsort(prefix)
    new = np.ones(len(start), bool)
    new[1:] = False
    for w in prefix:
        new[1:] |= w[order][1:] != w[order][:-1]
    tie = np.cumsum(new) - 1
    pos = start[order]
    live = np.bincount(tie)[tie] > 1
    order, tie, pos = order[live], tie[live], pos[live]

    # Starts of a tie that stand alike to the period: the same rank is the same string.
    residue = pos % PERIOD
    own = rank(pos + SHIFT[residue, residue])
    inner = np.lexsort((own, residue, tie))
    order, tie, pos, residue, own = (x[inner] for x in (order, tie, pos, residue, own))
    same = np.zeros(len(pos), bool)
    same[1:] = (tie[1:] == tie[:-1]) & (residue[1:] == residue[:-1]) & (own[1:] == own[:-1])
    member = np.cumsum(~same) - 1
    rep = np.flatnonzero(~same)
    repeated = np.bincount(member, minlength=len(rep)) > 1
    tie, pos = tie[rep], pos[rep]

    # The others of a tie are put in order by ranks at a shift that suits both.
    def compare(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        d = SHIFT[a % PERIOD, b % PERIOD]
        return np.sign(rank(a + d) - rank(b + d))

    sizes = np.bincount(tie) if len(tie) else np.zeros(0, np.int64)
    below = np.zeros(len(tie), np.int64)
    few = sizes[tie] <= 64 if len(tie) else np.zeros(0, bool)
    for step in range(1, int(sizes[sizes <= 64].max(initial=0))):
        a = np.flatnonzero(few[:-step] & (tie[:-step] == tie[step:]))
        if len(a):
            sign = compare(pos[a], pos[a + step])
            below[a + step] += sign < 0
            below[a] += sign > 0
    for t in np.flatnonzero(sizes > 64):
        own_rows = np.flatnonzero(tie == t)
        by_rank = functools.cmp_to_key(lambda a, b: int(compare(pos[a:a + 1], pos[b:b + 1])[0]))
        below[sorted(own_rows.tolist(), key=by_rank)] = np.arange(len(own_rows))
    final = np.lexsort((below, tie))
    pair = np.flatnonzero(tie[final][1:] == tie[final][:-1])
    a, b = final[pair], final[pair + 1]
    for k in range(0, LENGTH, 8):
        equal = words[pos[a] + k] == words[pos[b] + k]
        a, b = a[equal], b[equal]
    repeated[a] = repeated[b] = True
    out = np.zeros(len(start), bool)
    out[order] = repeated[member]
    return out


def cut_segments(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """The bytes of the wanted segments of each text."""
    rows = [(s["group"], s["content"], s["n"], raw[s["start"]:s["start"] + s["n"] - 1 + LENGTH])
            for raw, wanted in zip((t.encode() for t in batch.column("text").to_pylist()),
                                   batch.column("wanted").to_pylist(), strict=True) for s in wanted]
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                      ["group", "content", "n", "bytes"])


def stretches(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def sort_buckets(batches):
    """For each content: the stretches of starts that repeat. Whole groups are gathered to
    buckets of about BUCKET_BYTES."""
    def result(bucket: list[tuple]) -> pa.RecordBatch:
        counts = np.array([b[2] for b in bucket])
        sizes = np.array([len(b[3]) for b in bucket])
        base = np.repeat(np.cumsum(sizes) - sizes, counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        flags = repeated_starts(np.frombuffer(b"".join(b[3] for b in bucket), np.uint8), base + within)
        rows = [(b[0], b[1], x, y) for b, own in zip(bucket, np.split(flags, np.cumsum(counts)[:-1]), strict=True)
                if own.any() for x, y in stretches(own)]
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          ["group", "content", "first", "last"])

    bucket, size = [], 0
    for group in runs(batches, ["group"]):
        bucket += zip(*(group.column(c).to_pylist() for c in ("group", "content", "n", "bytes")), strict=True)
        size += group.nbytes
        if size > BUCKET_BYTES:
            yield result(bucket)
            bucket, size = [], 0
    if bucket:
        yield result(bucket)


def single_starts(batches):
    """A hash of every start's string, for groups too large to sort in a task."""
    for batch in batches:
        for g, c, n, raw in zip(*(batch.column(x).to_pylist() for x in ("group", "content", "n", "bytes")), strict=True):
            view = memoryview(raw)
            yield pa.RecordBatch.from_arrays(
                [pa.array([content_hash(view[at:at + LENGTH]) for at in range(n)], pa.binary()), pa.array(np.full(n, g)),
                 pa.array([c] * n, pa.binary()), pa.array(np.arange(n, dtype=np.int32))], ["string", "group", "content", "first"])


def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Cut the spans out of each text."""
    keys, removed, joined, digests = batch.column("key"), [], [], []
    for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
        raw, at, own, kept = text.encode(), 0, [], hashlib.sha256()
        for s in sorted(spans, key=lambda s: s["start"]):
            if own and s["start"] <= own[-1]["end"]:
                own[-1]["end"] = max(own[-1]["end"], s["end"])
            else:
                own.append(dict(s))
        for s in own:
            kept.update(raw[at:s["start"]])
            at = s["end"]
        kept.update(raw[at:])
        removed.append(sum(s["end"] - s["start"] for s in own))
        joined.append(own)
        digests.append(kept.hexdigest())
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays([keys, pa.array(removed, pa.int64()), pa.array(joined, kind), pa.array(digests)],
                                      ["key", "n_removed", "spans", "kept_sha256"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, end: maximal removed runs), kept_sha256 (of
    the remaining bytes) for each row of ``docs``."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).withColumn(
        "key", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    kind = base.schema["doc_id"].dataType.simpleString()
    found = stage(base.select("doc_id", "key", "text").mapInArrow(
        by_pieces(find_segments, "text"),
        f"doc_id {kind}, key binary, n_bytes long, segments array<struct<group:long,content:binary,n:int,starts:array<int>>>"), "segments")
    rows = found.select("key", F.explode("segments").alias("s")).select("key", "s.*", F.size("s.starts").alias("_times"))
    shared = stage(rows.groupBy("group").agg(F.sum("_times").alias("_all")).filter("_all > 1").select("group"), "groups")
    kept = stage(rows.join(shared, "group").groupBy("key", "group", "content", "n", "starts").agg(
        F.sum("_times").alias("times")), "shared-segments")
    drop_staged(shared)
    contents = stage(kept.groupBy("group", "content").agg(
        F.sum("times").alias("times"), F.min(F.struct("key", F.col("starts")[0].alias("start"), "n")).alias("at")), "contents")
    several = stage(contents.groupBy("group").agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1"), "variants")

    known = stage(bitmap(kept.select("key"), "_known", "key"), "keys")
    texts = stage(probe(base, known, "_known", "key").filter("_known").groupBy("key").agg(
        F.first("text").alias("text")).join(kept.select("key").distinct(), "key", "left_semi"), "texts")
    wanted = contents.join(several, "group").select("at.key", F.struct(
        "group", "content", "at.start", "at.n").alias("segment"), (F.col("variants") > hot).alias("is_hot"))

    def cut(part: DataFrame) -> DataFrame:
        lists = part.groupBy("key").agg(F.collect_list("segment").alias("wanted"))
        return texts.join(lists, "key").select("text", "wanted").mapInArrow(
            by_pieces(cut_segments, "text"), "group long, content binary, n int, bytes binary")

    ordered = cut(wanted.filter("not is_hot")).repartition("group").sortWithinPartitions("group").mapInArrow(
        sort_buckets, "group long, content binary, first int, last int")
    hits = contents.filter("times > 1").select("group", "content", F.lit(0).alias("first"), F.col("at.n").alias("last"))
    hits = hits.unionByName(ordered)
    if several.filter(F.col("variants") > hot).limit(1).count():
        starts = stage(cut(wanted.filter("is_hot")).mapInArrow(
            single_starts, "string binary, group long, content binary, first int"), "starts")
        twice = stage(starts.groupBy("string").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1"), "twice")
        hits = hits.unionByName(starts.join(twice, "string").select(
            "group", "content", "first", (F.col("first") + 1).alias("last")))
    hits = stage(hits, "hits")
    spans = kept.join(hits, ["group", "content"]).select("key", "first", "last", F.explode("starts").alias("start")).groupBy("key").agg(F.collect_set(F.struct(
        (F.col("start") + F.col("first")).alias("start"),
        (F.col("start") + F.col("last") - 1 + LENGTH).alias("end"))).alias("spans"))
    result = stage(texts.join(spans, "key").mapInArrow(
        by_pieces(remove, "text"), "key binary, n_removed long, spans array<struct<start:int,end:int>>, kept_sha256 string"), "removed")
    for done in (kept, contents, several, known, texts, hits):
        drop_staged(done)
    return found.select("doc_id", "key", "n_bytes").join(result, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("kept_sha256", F.lower(F.hex("key"))).alias("kept_sha256"))
