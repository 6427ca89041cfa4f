"""The prefix trie against a plain dictionary of prefixes, and the trees themselves."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
from noticeflow.llm import prefix_trie as pt
from noticeflow.llm.queries import ORACLES, REGISTRY, shared_starts

TURNS = "conv_id long, turn long, role string, text string, key string, part int, ids string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "k", 3, "i") for r in rows], TURNS)


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + t[h:]
    return out


def brute(convs):
    """{(conv_id, depth): the other columns} from all prefixes of all conversations."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        path = tuple(convs[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    own = {p: (len(m) - 1) * len(p[-1][1].encode()) if p else 0 for p, m in members.items()}
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in members:
        for d in range(len(p) + 1):
            saved[p[:d]] += own[p]
            leaves[p[:d]] += p not in kids
    return {(m[0], len(p)): (members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                             hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
            for p, m in members.items()}


def found(nodes):
    rows = nodes.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_bytes, r.ends_sha256)
           for r in rows}
    assert len(out) == len(rows)
    return out


def sample(seed=1, convs=150):
    """Shared starts, whole copies, long ones, null fields, equal turns, rows without an id."""
    r = random.Random(seed)
    texts = ["", "a", "é" * 3, "x" * 50, None, *(f"t{i}" for i in range(30))]
    out = []
    for c in range(convs):
        kind = r.random()
        if kind < 0.35:
            path = [("user", "hot"), ("assistant", "copy"), ("user", "z")]
        elif kind < 0.4:
            path = [("user", "hot")] * r.randint(20, 60)
        else:
            path = [(r.choice(["user", "assistant", None]), r.choice(texts[:r.choice([2, 36])])) for _ in range(r.randint(1, 9))]
        out += [(c, None if i == 0 and r.random() < 0.2 else i, *t) for i, t in enumerate(path)]
    return out + [(None, 0, "user", "lost"), (7, 2, "user", "again"), (7, 2, "user", "again")]


@pytest.mark.parametrize(("rows_a_range", "bytes_a_range", "fan"), [(10**6, 10**9, 64), (7, 10**9, 64), (3, 600, 2), (1, 64, 3)])
def test_any_cut_into_ranges(spark, monkeypatch, rows_a_range, bytes_a_range, fan):
    """However the keys are cut, and through however many rounds: the same trie. A group of copies fills many ranges."""
    monkeypatch.setattr(pt, "FAN", fan)
    rows = sample(convs=150 if rows_a_range > 1 else 40)
    keys = shared_starts(turns(spark, rows))
    assert found(pt.prefix_trie(keys, bytes_a_range, rows_a_range)) == brute(rebuilt(rows))


def test_plain_keys(spark):
    """The operator's own interface: keys as they are, a conversation without turns among them."""
    convs = {5: [("u", "a")], 6: [("u", "a"), ("u", "b")], 9: [], 11: [("u", "a")], -3: [("u", "bb")]}
    rows = [(c, i, *t) for c, path in convs.items() for i, t in enumerate(path)]
    own = pt.conversations(turns(spark, rows)).select("conv_id", pt.key_of(pt.F.col("ids")).alias("key"))
    keys = own.unionByName(spark.createDataFrame([(9, b"")], "conv_id long, key binary"))
    nodes = pt.prefix_trie(keys)
    assert found(nodes) == brute(convs)
    assert {r.depth: r.turn_id for r in nodes.collect()}[0] is None


def test_no_rows(spark):
    assert pt.prefix_trie(shared_starts(turns(spark, []))).collect() == []
    assert pt.prefix_trie(shared_starts(turns(spark, [(None, 1, "a", "b")]))).collect() == []


def test_node_layouts_grow_and_keep_order():
    root = pt.Node(b"")
    bytes_ = list(range(256))
    random.Random(4).shuffle(bytes_)
    kinds = []
    for n, b in enumerate(bytes_, 1):
        pt.insert(root, bytes([b]) * pt.TURN, b)
        kinds.append((type(root.kids).__name__, getattr(root.kids, "most", None)))
        assert [k.path[0] for k in root.kids.in_order()] == sorted(bytes_[:n])
    assert [kinds[i] for i in (0, 3, 4, 15, 16, 47, 48, 255)] == [
        ("Few", 4), ("Few", 4), ("Few", 16), ("Few", 16), ("Indexed", None), ("Indexed", None), ("Direct", None), ("Direct", None)]
    assert all(root.kids.get(b).ends == [b] for b in range(256))


def test_paths_are_compressed_and_parted():
    root, key = pt.Node(b""), bytes(range(48))
    pt.insert(root, key, 1)
    assert [k.path for k in root.kids.in_order()] == [key]
    pt.insert(root, key[:20] + b"\xff" * 12, 2)
    (upper,) = root.kids.in_order()
    assert upper.path == key[:20] and sorted(k.path for k in upper.kids.in_order()) == [key[20:], b"\xff" * 12]
    pt.insert(root, key[:16], 3)
    (top,) = root.kids.in_order()
    assert top.path == key[:16] and top.ends == [3]


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{entry.SMOKE_DIR}/conversations.parquet'")
    want = con.execute(ORACLES["op13_prefix_trie"])
    names = [d[0] for d in want.description]
    df = REGISTRY["op13_prefix_trie"](spark, entry.SMOKE_DIR)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*names).collect())


def test_sql_on_odd_rows(spark):
    """The SQL itself against the plain dictionary; of equal turns it takes the smaller text first."""
    rows = [r for r in sample(3) if not (r[0] == 7 and r[1] == 2)]
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    cols = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    got = con.execute(f"select {cols} from ({ORACLES['op13_prefix_trie']})").fetchall()
    assert {(r[0], r[1]): tuple(r[2:]) for r in got} == brute(rebuilt(rows))
