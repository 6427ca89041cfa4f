"""Conversation prefix trie: adaptive radix trees over fixed-width big-endian turn ids.

A turn's id has ``TURN`` (16) bytes: twelve of the SHA-256 of its role and text, then the length of
the text in UTF-8 bytes, big-endian. A conversation's key is the ids of its turns in order, so
conversations that share their first d turns share the first 16 * d bytes of their keys.

The keys are cut into ordered ranges of bounded size, by (key, conv_id), so that a third of all
conversations being alike fills many ranges and not one. In each range a task builds an adaptive
radix tree: nodes of 4, 16, 48 and 256 places that grow as children come, single paths kept as
one compressed edge. A walk of the tree gives a trie node for each turn-aligned depth and for
no other. Nodes on the paths of a range's first and last key may continue in its neighbours; the
task gives their partial figures. Ranges are then put together ``FAN`` neighbours at a time, in as
many rounds as it takes; each round settles the nodes that lie inside a group of ranges.

Result of ``prefix_trie``, a row for each distinct sequence of first turns: conv_id (the smallest
member), depth, parent_conv_id (of the parent; null for the root), turn_id (of the last turn; null
for the root), n_convs (members), n_children, n_leaves (childless nodes in its subtree), saved_bytes
(over its subtree, (n_convs - 1) * bytes of the last text) and ends_sha256 (of the decimal ids of the
conversations that end there, ascending, joined by commas).

Edge cases. A null role or text is empty. Rows without a conv_id belong to no conversation. Turns
are ordered by turn, null first; of equal turns the smaller id comes first, and a repeated row is a
turn of its own. A conversation without turns ends at the root. No conversation gives no row. Extra
columns are not read. The ids of one conversation (16 bytes a turn) must fit in a task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import drop_staged, stage

TURN = 16
RANGE_BYTES = 4 << 20
RANGE_ROWS = 20_000
FAN = 64
ROOT = bytes(TURN)


class Few:
    """Up to 4 or 16 children: sorted bytes beside their nodes."""

    __slots__ = ("most", "keys", "kids")

    def __init__(self, most: int = 4, keys: bytes = b"", kids: Iterable[Node] = ()):
        self.most, self.keys, self.kids = most, bytearray(keys), list(kids)

    def get(self, byte: int) -> Node | None:
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> Few | Indexed:
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.kids[at] = node
            return self
        if len(self.keys) == self.most:
            grown = Few(16, self.keys, self.kids) if self.most == 4 else Indexed(self.keys, self.kids)
            return grown.put(byte, node)
        self.keys.insert(at, byte)
        self.kids.insert(at, node)
        return self

    def in_order(self) -> Iterator[Node]:
        return iter(self.kids)


class Indexed:
    """Up to 48 children: a place for each byte value that tells where its node is."""

    __slots__ = ("at", "kids")

    def __init__(self, keys: bytes, kids: Iterable[Node]):
        self.at, self.kids = bytearray(256), list(kids)
        for place, byte in enumerate(keys, 1):
            self.at[byte] = place

    def get(self, byte: int) -> Node | None:
        place = self.at[byte]
        return self.kids[place - 1] if place else None

    def put(self, byte: int, node: Node) -> Indexed | Direct:
        if place := self.at[byte]:
            self.kids[place - 1] = node
        elif len(self.kids) == 48:
            return Direct(self).put(byte, node)
        else:
            self.kids.append(node)
            self.at[byte] = len(self.kids)
        return self

    def in_order(self) -> Iterator[Node]:
        return (self.kids[place - 1] for place in self.at if place)


class Direct:
    """A place for each of the 256 byte values."""

    __slots__ = ("kids",)

    def __init__(self, smaller: Indexed):
        self.kids = [smaller.get(byte) for byte in range(256)]

    def get(self, byte: int) -> Node | None:
        return self.kids[byte]

    def put(self, byte: int, node: Node) -> Direct:
        self.kids[byte] = node
        return self

    def in_order(self) -> Iterator[Node]:
        return (kid for kid in self.kids if kid is not None)


class Node:
    """``path``: the bytes from the parent's end to this node's end, its first one the parent's
    branch. ``ends``: the conversations whose keys stop here."""

    __slots__ = ("path", "kids", "ends")

    def __init__(self, path: bytes):
        self.path, self.kids, self.ends = path, None, []

    def add(self, node: Node) -> None:
        self.kids = (self.kids or Few()).put(node.path[0], node)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def insert(root: Node, key: bytes, conv_id: int) -> None:
    node, at = root, 0
    while at < len(key):
        kid = node.kids and node.kids.get(key[at])
        if kid is None:
            kid = Node(key[at:])
            node.add(kid)
            node, at = kid, len(key)
            continue
        same = common(kid.path, key[at:at + len(kid.path)])
        if same < len(kid.path):  # the edge parts here: a node in its midst takes the old one as child
            upper = Node(kid.path[:same])
            kid.path = kid.path[same:]
            upper.add(kid)
            node.add(upper)
            kid = upper
        node, at = kid, at + same
    node.ends.append(conv_id)


def digest(conv_ids: Iterable[int]) -> str:
    return hashlib.sha256(",".join(map(str, conv_ids)).encode()).hexdigest()


def chain(key: bytes) -> list[bytes]:
    """Identity of the trie node at each depth of a key: a hash over that of its parent."""
    out = [ROOT]
    for at in range(0, len(key), TURN):
        out.append(hashlib.sha256(out[-1] + key[at:at + TURN]).digest()[:TURN])
    return out


class Seen:
    """What a walk knows of the keys below a point: members, their smallest id, and of the settled
    trie nodes there the topmost ones, the leaves and the bytes saved."""

    __slots__ = ("members", "smallest", "tops", "leaves", "saved")

    def __init__(self, ends: list[int]):
        self.members, self.smallest = len(ends), min(ends, default=None)
        self.tops, self.leaves, self.saved = [], 0, 0

    def join(self, other: Seen) -> None:
        self.members += other.members
        self.smallest = other.smallest if self.smallest is None else min(self.smallest, other.smallest)
        more, less = (self.tops, other.tops) if len(self.tops) >= len(other.tops) else (other.tops, self.tops)
        more.extend(less)
        self.tops = more
        self.leaves += other.leaves
        self.saved += other.saved


def saved(members: int, turn: bytes | None) -> int:
    return (members - 1) * int.from_bytes(turn[-4:], "big") if turn else 0


def walk(root: Node, first: bytes, last: bytes) -> tuple[list[dict], list[dict]]:
    """The settled nodes of a range, and the partial ones, which lie on the paths of its first and
    last key. Those count of what is below them only what is settled and not below another partial
    node; their ``ends`` are the ids themselves."""
    settled, partial = [], []
    ids = {True: chain(first), False: chain(last)}
    stack: list[tuple] = [(root, 0, b"", True, True, None)]
    results: list[Seen] = []
    while stack:
        node, start, carry, on_first, on_last, mark = stack.pop()
        end, data = start + len(node.path), carry + node.path
        if mark is None:  # on the way down; the node comes again after its children
            same = [common(node.path, key[start:end]) if on else -1
                    for key, on in ((first, on_first), (last, on_last))]
            stack.append((node, start, carry, *same, len(results)))
            rest = data[len(data) - end % TURN:]
            for kid in node.kids.in_order() if node.kids else ():
                stack.append((kid, end, rest, *(n == len(node.path) for n in same), None))
            continue
        here = Seen(node.ends)
        for below in results[mark:]:
            here.join(below)
        del results[mark:]
        for depth in range(end // TURN, start // TURN - (node is root), -1):
            at = depth * TURN - start
            turn = data[len(carry) + at - TURN:len(carry) + at] or None
            ends = node.ends if depth * TURN == end else []
            row = {"conv_id": here.smallest, "depth": depth, "turn_id": turn, "n_convs": here.members,
                   "n_children": len(here.tops), "n_leaves": here.leaves, "saved_bytes": here.saved}
            if at <= max(on_first, on_last):
                path = ids[at <= on_first]
                row |= {"node": path[depth], "parent": path[depth - 1] if depth else None, "ends": ends,
                        "on_first": at <= on_first, "on_last": at <= on_last}
                for kid in here.tops:
                    kid["parent"] = path[depth]
                partial.append(row)
                here.tops, here.leaves, here.saved = [], 0, 0
                continue
            row["n_leaves"] += not here.tops
            row["saved_bytes"] += saved(here.members, turn)
            row["ends_sha256"] = digest(ends)
            for kid in here.tops:
                kid["parent_conv_id"] = here.smallest
            settled.append(row)
            here.tops, here.leaves, here.saved = [row], row["n_leaves"], row["saved_bytes"]
        results.append(here)
    return settled, partial


ROWS = ("part int, conv_id bigint, depth bigint, parent_conv_id bigint, turn_id binary, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_bytes bigint, ends_sha256 string, node binary, parent binary, on_first boolean, "
        "on_last boolean, ends string")
ARROW = pa.schema([
    ("part", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("turn_id", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_bytes", pa.int64()), ("ends_sha256", pa.string()), ("node", pa.binary()), ("parent", pa.binary()),
    ("on_first", pa.bool_()), ("on_last", pa.bool_()), ("ends", pa.string())])


def in_batches(rows: list[dict], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), size):
        yield pa.RecordBatch.from_pylist(rows[at:at + size], schema=ARROW)


def range_tries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: its keys, in order, into a tree and out as rows."""
    root, first, last, part = Node(b""), None, b"", None
    for batch in batches:
        keys = batch.column("key").to_pylist()
        for key, conv_id in zip(keys, batch.column("conv_id").to_pylist(), strict=True):
            insert(root, key, conv_id)
        if keys:
            first, last, part = keys[0] if first is None else first, keys[-1], batch.column("part")[0].as_py()
    if first is None:
        return
    settled, partial = walk(root, first, last)
    for row in partial:
        row["ends"] = ",".join(map(str, row["ends"])) or None
    for row in settled + partial:
        row["part"] = part
    yield from in_batches(settled)
    yield from in_batches(partial)


def merged(rows: list[dict], closing: bool) -> tuple[list[dict], list[dict]]:
    """The partial nodes of neighbouring ranges put together: those settled now, and those still
    open, which lie on the path of the first range's first key or the last range's last key. With
    ``closing`` none stays open."""
    low, high = min(r["part"] for r in rows), max(r["part"] for r in rows)
    nodes: dict[bytes, dict] = {}
    for r in rows:
        into = nodes.get(r["node"])
        r["on_first"], r["on_last"] = r["on_first"] and r["part"] == low, r["on_last"] and r["part"] == high
        if into is None:
            nodes[r["node"]] = dict(r)
            continue
        into["conv_id"] = min(into["conv_id"], r["conv_id"])
        for name in ("n_convs", "n_children", "n_leaves", "saved_bytes"):
            into[name] += r[name]
        for name in ("on_first", "on_last"):
            into[name] |= r[name]
    settled, still = [], []
    for row in sorted(nodes.values(), key=lambda r: -r["depth"]):
        if not closing and (row["on_first"] or row["on_last"]):
            still.append(row)
            continue
        row["n_leaves"] += not row["n_children"]
        row["saved_bytes"] += saved(row["n_convs"], row["turn_id"])
        above = nodes.get(row["parent"])
        if above is not None:
            above["n_children"] += 1
            above["n_leaves"] += row["n_leaves"]
            above["saved_bytes"] += row["saved_bytes"]
        settled.append(row)
    return settled, still


def group_merge(closing: bool):
    def work(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py() // FAN
        settled, still = merged(table.to_pylist(), closing)
        return pa.Table.from_pylist([r | {"part": part, "ends": None, "open": is_open}
                                     for found, is_open in ((settled, False), (still, True)) for r in found],
                                    schema=ARROW.append(pa.field("open", pa.bool_())))
    return work


def ends_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node, of lists that come in order and piece by piece."""
    node, state = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])],
                                          ["node", "ends_sha256"])

    for batch in batches:
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if key != node:
                if state is not None:
                    yield out()
                node, state = key, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if state is not None:
        yield out()


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn, in hex."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    hashed = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(hashed, 1, 24), F.lpad(F.lower(F.hex(F.octet_length(text))), 8, "0"))


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and ids: those of the conversation's turns, in order."""
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct("turn", turn_id(F.col("role"), F.col("text")).alias("id")).alias("_turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_turn"))["id"].alias("ids"))


def key_of(ids: Column) -> Column:
    return F.unhex(F.array_join(ids, ""))


def prefix_trie(keys: DataFrame, range_bytes: int = RANGE_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The trie of the conversations in ``keys`` (conv_id, key)."""
    keys = stage(keys.select("conv_id", "key"), "trie-keys")
    n, size = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("key")), F.lit(0))).first()
    parts = 1 + max(n // range_rows, size // range_bytes)
    ranges = keys.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = stage(ranges.withColumn("part", F.spark_partition_id()).mapInArrow(range_tries, ROWS), "trie-ranges")
    drop_staged(keys)
    inner, partial = found.filter("node is null"), found.filter("node is not null")
    closed, still, groups = [], partial, parts
    while not closed or groups > 1:
        groups = -(-groups // FAN)
        done = stage(still.drop("open").groupBy(F.floor(F.col("part") / FAN).alias("_group")).applyInArrow(
            group_merge(groups == 1), f"{ROWS}, open boolean"), "trie-groups")
        closed.append(done.filter("not open"))
        still = done.filter("open")
    spine = closed[0]
    for more in closed[1:]:
        spine = spine.unionByName(more)
    ends = partial.filter("ends is not null").select("node", "part", "ends")
    digests = ends.repartition("node").sortWithinPartitions("node", "part").select("node", "ends").mapInArrow(
        ends_digests, "node binary, ends_sha256 string")
    smallest = spine.select(F.col("node").alias("parent"), F.col("conv_id").alias("_parent_conv"))
    nodes = spine.drop("ends_sha256", "part").join(smallest, "parent", "left").join(digests, "node", "left")
    # A node that all ranges share, as the root, is looked up in each range on its own.
    per_range = partial.select("part", F.col("node").alias("parent")).join(smallest, "parent")
    below = inner.join(per_range, ["part", "parent"], "left")
    names = ["conv_id", "depth", F.coalesce("parent_conv_id", "_parent_conv").alias("parent_conv_id"), "turn_id",
             "n_convs", "n_children", "n_leaves", "saved_bytes",
             F.coalesce("ends_sha256", F.lit(digest([]))).alias("ends_sha256")]
    return below.select(*names).unionByName(nodes.select(*names))
