"""Training-order materialisation: token sequences in a keyed random order, in fixed strides.

Every text is encoded and closed by the end token. Each task of the scan puts its texts end to end and
cuts the stream into sequences of ``SEQUENCE`` ids (16 bits each), so that only its last one is filled
up with end tokens; a sequence knows which tokens of which texts it has. It has an index, counted
through the scan's tasks, and a slot: a keyed Feistel permutation of the numbers below the smallest even
power of two that holds all n sequences, walked on from results of n or more (cycle-walking)
until one is below n. So slots are a permutation of 0 .. n - 1 that can be computed, and
inverted, for any index alone. A shard is a range of ``SHARD_RECORDS`` slots; its records have one
size, so the record of a slot starts at (slot % SHARD_RECORDS) * stride in shard slot //
SHARD_RECORDS, and reading can start or resume at any slot.

Sequences are written once as a table; only one number per task (how many it has) is summed
centrally, a row for each task of the scan, of which 10^5 are a few MB. Each task numbers its own rows in
the scan's order, so a task that is run again gives the same numbers. The order depends on the files
and their splits, the key and n.

Edge cases. Null and empty texts are one end token. Repeated rows and null ids are texts like any
other. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.llm.bpe import encoder, forget, shared
from noticeflow.llm.common import drop_staged, pieces, stage, texts_of

SEQUENCE = 512
SHARD_RECORDS = 8192
END_TOKEN = "<|endoftext|>"
ROUNDS = 6
#: Records that a task deals out at a time.
BLOCK_ROWS = 8192
#: Pieces of text whose ids a worker keeps; nothing else here needs memory that grows.
CACHE_ENTRIES = 550_000
#: Bytes of a row group of the staged sequences, which a writing task holds on the heap.
GROUP_BYTES = 16 << 20
#: Shards that one task writes, where there are more than shuffle partitions.
TASK_SHARDS = 16


class Feistel:
    """A keyed permutation of the numbers below ``n``."""

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = np.random.default_rng(key).integers(0, 2**63, ROUNDS, dtype=np.uint64)

    def mixed(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))) & self.mask

    def once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys[::-1] if back else self.keys:
            if back:
                left, right = right ^ self.mixed(left, key), left
            else:
                left, right = right, left ^ self.mixed(right, key)
        return left << self.half | right

    def walk(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        out = self.once(x.astype(np.uint64), back)
        while (beyond := out >= np.uint64(self.n)).any():
            out[beyond] = self.once(out[beyond], back)
        return out.astype(np.int64)


class Packer:
    """Texts of a task end to end, cut into sequences."""

    def __init__(self, sequence: int, end: int, kind: pa.DataType):
        self.sequence, self.end = sequence, end
        self.docs = pa.array([], kind)
        self.ids = np.zeros(0, "<u2")
        # Of each text in the stream: how many tokens of it are there, and how many went before.
        self.sizes = self.before = np.zeros(0, np.int64)
        self.index = 0

    def add(self, docs: pa.Array, raw: list[bytes]) -> None:
        stop = np.array([self.end], "<u2")
        parts = [x for ids in raw for x in (np.frombuffer(ids, "<u4").astype("<u2"), stop)]
        self.ids = np.concatenate([self.ids, *parts])
        self.docs = pa.concat_arrays([self.docs, docs])
        self.sizes = np.concatenate([self.sizes, [len(ids) // 4 + 1 for ids in raw]]).astype(np.int64)
        self.before = np.concatenate([self.before, np.zeros(len(raw), np.int64)])

    def take(self, part: int, rest: bool = False) -> pa.RecordBatch:
        """The whole sequences of the stream; with ``rest`` also what is left, filled up."""
        size = self.sequence
        count = -(-len(self.ids) // size) if rest else len(self.ids) // size
        used = min(count * size, len(self.ids))
        data = np.concatenate([self.ids[:used], np.full(count * size - used, self.end, "<u2")]).tobytes()
        # Pieces of texts: cut at the bounds of texts and of sequences.
        ends = np.cumsum(self.sizes)
        starts = ends - self.sizes
        cuts = np.unique(np.concatenate([starts[starts < used], np.arange(0, used, size)])) if used else np.zeros(0, np.int64)
        text = np.searchsorted(ends, cuts, "right")
        lengths = np.diff(np.append(cuts, used))
        docs = pa.StructArray.from_arrays(
            [self.docs.take(pa.array(text)), pa.array(self.before[text] + cuts - starts[text]), pa.array(lengths)],
            ["doc_id", "from_token", "n_tokens"])
        bounds = np.append(np.searchsorted(cuts, np.arange(count) * size), len(cuts))
        out = pa.RecordBatch.from_arrays(
            [pa.array([part] * count, pa.int32()), pa.array(self.index + np.arange(count), pa.int64()),
             pa.array(np.minimum(size, used - np.arange(count) * size), pa.int32()),
             pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), docs),
             pa.array([data[at:at + 2 * size] for at in range(0, len(data), 2 * size)], pa.binary())],
            ["part", "index", "n_tokens", "docs", "record"])
        left = np.searchsorted(ends, used, "right")
        gone = used - starts[left:left + 1]
        self.ids, self.docs, self.index = self.ids[used:], self.docs.slice(left), self.index + count
        self.sizes, self.before = self.sizes[left:].copy(), self.before[left:].copy()
        self.sizes[:1] -= gone
        self.before[:1] += gone
        return out


def sequences(docs: DataFrame, path: str, id_col: str, text_col: str, sequence: int) -> DataFrame:
    """part (task), index (in the task), n_tokens (without filling), docs, record."""
    vocabulary = shared(docs.sparkSession, path)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        part, packer, encode = TaskContext.get().partitionId(), None, encoder(vocabulary.value, CACHE_ENTRIES).encode
        for batch in batches:
            if packer is None:
                packer = Packer(sequence, vocabulary.value.specials[END_TOKEN], batch.schema.field("doc_id").type)
            for piece in pieces(batch, "text"):
                packer.add(piece.column("doc_id"), encode(texts_of(piece, "text")))
                yield packer.take(part)
        if packer is not None:
            yield packer.take(part, rest=True)

    return rows.mapInArrow(run, f"part int, index long, n_tokens int, docs array<struct<doc_id: {kind}, "
                                "from_token: bigint, n_tokens: bigint>>, record binary")


class Sequences:
    """The sequences, staged, and their order."""

    def __init__(self, docs: DataFrame, path: str, id_col: str, text_col: str, key: int, sequence: int, shard_records: int):
        spark, self.stride, self.shard_records = docs.sparkSession, 2 * sequence, shard_records
        self.staged = stage(sequences(docs, path, id_col, text_col, sequence), "sequences", compression="zstd",
                            **{"parquet.block.size": str(GROUP_BYTES)})
        parts = sorted(self.staged.groupBy("part").agg(F.max("index").alias("last")).collect())
        bases, self.total = [], 0
        for part, last in parts:
            bases.append((part, self.total))
            self.total += last + 1
        self.key, self.bases = key, spark.createDataFrame(bases, "part int, base long")

    def rows(self, *wanted: str) -> DataFrame:
        """Those of shard, slot, byte_offset, n_tokens, docs, record that are wanted, a row for each sequence."""
        order, stride = Feistel(self.total, self.key), self.stride

        @F.pandas_udf("long")
        def slot_of(index: pd.Series) -> pd.Series:
            return pd.Series(order.walk(index.to_numpy()))

        rows = self.staged.join(F.broadcast(self.bases), "part").withColumn("slot", slot_of(F.col("base") + F.col("index")))
        return rows.withColumns({"shard": F.floor(F.col("slot") / self.shard_records),
                                 "byte_offset": F.col("slot") % self.shard_records * stride}).select(*wanted)


    def write(self, path: str) -> None:
        """Write one file per shard. Records go to the task of their range of shards in compressed blocks,
        each with its slots; a task has at most ``TASK_SHARDS`` shards, or a few if there are few in all."""
        order, stride, shard_records = Feistel(self.total, self.key), self.stride, self.shard_records
        shards = max(1, -(-self.total // shard_records))
        least = int(self.staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = min(shards, max(least, -(-shards // TASK_SHARDS)))

        def pack(batches):
            forget()
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                    yield packed(held)
                    held = []
            if held:
                yield packed(held)

        def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            slots = order.walk(np.concatenate([b.column("index").to_numpy() for b in held]))
            rows = np.frombuffer(b"".join(x for b in held for x in b.column("record").to_pylist()), np.uint8).reshape(-1, stride)
            by_slot = np.argsort(slots)
            slots, zip_up = slots[by_slot], zstandard.ZstdCompressor(level=4).compress
            target = slots // shard_records * tasks // shards
            cuts = np.flatnonzero(np.diff(target, prepend=-1, append=tasks))
            parts = [(int(target[a]), slots[a:b].tobytes(), zip_up(rows[by_slot[a:b]].tobytes())) for a, b in zip(cuts, cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*parts, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["target", "slots", "block"])

        def unpack(batches):
            slots, rows, unzip = [], [], zstandard.ZstdDecompressor().decompress
            for batch in batches:
                slots += [np.frombuffer(x, np.int64) for x in batch.column("slots").to_pylist()]
                rows += [np.frombuffer(unzip(x), np.uint8).reshape(-1, stride) for x in batch.column("block").to_pylist()]
            if not slots:
                return
            slot, data = np.concatenate(slots), np.concatenate(rows)
            by_slot = np.argsort(slot)
            shard = slot[by_slot] // shard_records
            cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
            for a, b in zip(cuts, cuts[1:]):
                yield whole(int(shard[a]), [data[by_slot[a:b]].tobytes()])

        rows = self.staged.join(F.broadcast(self.bases), "part").select((F.col("base") + F.col("index")).alias("index"), "record")
        dealt = rows.mapInArrow(pack, "target int, slots binary, block binary").repartitionById(tasks, "target")
        blobs = dealt.select("slots", "block").mapInArrow(unpack, "shard long, value binary")
        write_blobs(blobs, path)


def training_order(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, key: int = 0,
                   sequence: int = SEQUENCE, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """A row for each sequence, dealt to partitions by shard and sorted by slot: shard, slot, byte_offset,
    n_tokens (without filling), docs (which tokens of which texts: doc_id, from_token, n_tokens; the end
    token is the text's last), record (the ids, little-endian)."""
    found = Sequences(docs, path, id_col, text_col, key, sequence, shard_records)
    return found.rows("shard", "slot", "byte_offset", "n_tokens", "docs", "record").repartition(
        "shard").sortWithinPartitions("shard", "slot")


def joined(batches):
    """The records of each shard, which come in order, as one value."""
    held, mark = [], None
    for batch in batches:
        shards = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and shards[a] != mark:
                yield whole(mark, held)
                held = []
            mark = int(shards[a])
            held.append(b"".join(batch.column("record").slice(a, b - a).to_pylist()))
    if held:
        yield whole(mark, held)


def whole(shard: int, held: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([b"".join(held)], pa.binary())], ["shard", "value"])


def write_shards(rows: DataFrame, path: str, total: int | None = None, shard_records: int = SHARD_RECORDS) -> None:
    """Write one file per shard of any rows in this form. With the number of records, the shards are dealt
    to ranges of slots as numbered, without a sample; else by a range of the rows given."""
    wanted = rows.select("shard", "slot", "record")
    if total is None:
        ranges = wanted.repartitionByRange("shard")
    else:
        shards = max(1, -(-total // shard_records))
        least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = min(shards, max(least, -(-shards // TASK_SHARDS)))
        ranges = wanted.repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int"))
    blobs = ranges.sortWithinPartitions("shard", "slot").select("shard", "record").mapInArrow(joined, "shard long, value binary")
    write_blobs(blobs, path)


def write_blobs(blobs: DataFrame, path: str) -> None:
    """Spark's text writer puts the bytes as they are; it also commits whole tasks only."""
    blobs.select("shard", F.col("value").cast("string")).write.partitionBy("shard").option("compression", "none").text(path)


def digests(spark: SparkSession, path: str, stride: int, shard_records: int) -> DataFrame:
    """slot and record_sha256 of each record in the files of ``path``."""
    def work(batches):
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                data = memoryview(content.as_buffer())
                n = len(data) // stride
                sums = [hashlib.sha256(data[at:at + stride]).digest() for at in range(0, n * stride, stride)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(n) + shard * shard_records, pa.int64()), pa.array(sums, pa.binary())], ["slot", "record_sha256"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    shard = F.regexp_extract("path", r"/shard=(\d+)/[^/]*$", 1).cast("long")
    # Whole files go to Python once; cut by an expression, a file would be copied for each record.
    return files.select(shard.alias("shard"), "content").mapInArrow(work, "slot long, record_sha256 binary")


def write_order(docs: DataFrame, path: str, out: str, id_col: str = "doc_id", text_col: str = "text", *, key: int = 0,
                sequence: int = SEQUENCE, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """Write the shards to ``out``. A row for each sequence: shard, slot, byte_offset, n_tokens, docs, and
    record_sha256 of what the file of the shard has there (null: nothing; a record too many has no docs)."""
    found = Sequences(docs, path, id_col, text_col, key, sequence, shard_records)
    found.write(out)
    index = stage(found.rows("slot", "n_tokens", "docs"), "order", compression="zstd")
    drop_staged(found.staged)
    both = index.join(digests(docs.sparkSession, out, 2 * sequence, shard_records), "slot", "full")
    return both.select(F.floor(F.col("slot") / shard_records).alias("shard"), "slot",
                       (F.col("slot") % shard_records * 2 * sequence).alias("byte_offset"),
                       "n_tokens", "docs", F.lower(F.hex("record_sha256")).alias("record_sha256"))


def read_shard(spark: SparkSession, path: str, shard: int, record_bytes: int, start: int = 0,
               count: int | None = None) -> list[np.ndarray]:
    """``count`` sequences (or all) of a shard from its record ``start`` on; only they are read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    [file] = [f for f in files.listStatus(folder) if f.getPath().getName().startswith("part-")]
    left = max(0, file.getLen() // record_bytes - start)
    stream = files.open(file.getPath())
    try:
        stream.seek(min(start * record_bytes, file.getLen()))
        data = bytes(stream.readNBytes(record_bytes * (left if count is None else min(left, count))))
    finally:
        stream.close()
    return [np.frombuffer(data[at:at + record_bytes], "<u2") for at in range(0, len(data), record_bytes)]
