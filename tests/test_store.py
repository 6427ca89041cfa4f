"""The store: repeats that die, the link index, the table of people, compaction."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from noticeflow.operators.ingest import LINK_KEY, first_new, wanted_links
from noticeflow.plans.compaction import compact, vacuum
from noticeflow.plans.daily import due, mark, run_day
from noticeflow.plans.manifest import Manifest
from noticeflow.plans.store import FILLED, NUMBERED, Store
from noticeflow.schemas import OBITS

from .samples import BASE, listing
from .test_runs import DAY1, DAY2, FIRST, SECOND, by_url, details, item, markets, pages  # noqa: F401

NAMES = ["id", "legacy_url", "first_name", "last_name", "city", "state", "death_date", "obit_text", "scraped_at"]


def records(spark, rows):
    """Records of (id, first, last, city, state, death date, text)."""
    full = [(i, f"https://x/{i}", f, n, c, s, d, t, dt.datetime(2026, 1, 1)) for i, f, n, c, s, d, t in rows]
    df = spark.createDataFrame(full, ", ".join(f"{n} {OBITS[n].dataType.simpleString()}" for n in NAMES))
    return df.select(*[F.col(f.name) if f.name in NAMES else F.lit(None).cast(f.dataType).alias(f.name) for f in OBITS])


def store_day(spark, store, rows, batch):
    store.take(batch)
    store.append_records(records(spark, rows), batch)
    mark(store, batch)
    store.complete(NUMBERED, batch, batch)


class Plain:
    """Every run marks among all unmarked records."""

    def __init__(self):
        self.rows, self.marks = {}, {}

    def day(self, rows, marking=True):
        for r in rows:
            self.rows[r[0]] = list(r)
        groups = {}
        for i, first, last, city, state, death, text in self.rows.values():
            if first and last and i not in self.marks:
                key = tuple((v or "").lower() for v in (first, last, city, state))
                groups.setdefault(key, []).append((death is None, -len(text or ""), i))
        for members in groups.values() if marking else ():
            best = min(members)[2]
            self.marks |= {i: best for _, _, i in members if i != best}

    def fill(self, values):
        for i, city, death in values:
            if not self.rows[i][3]:
                self.rows[i][3] = city or self.rows[i][3]
            self.rows[i][5] = self.rows[i][5] or death


def random_rows(r, first, n):
    return [(first + k, r.choice(["Jo", "JO", "Al", ""]), r.choice(["X", "Y", "Z"]), r.choice([None, "", "Town", "town"]),
             r.choice([None, "OH"]), r.choice([None, dt.date(2020, 1, 1)]), "t" * r.randint(0, 3)) for k in range(n)]


def marks_in(store):
    return {r.id: r.duplicate_of for r in store.obits().where("duplicate_of is not null").collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_marks_over_days_loads_fills_and_generations(spark, tmp_path, seed):
    """The table of people gives the marks of runs that look at everything."""
    r, plain, store = random.Random(seed), Plain(), Store(spark, str(tmp_path / "store"), buckets=2)
    steps = ["day", "load", "day", "fill", "compact", "day", "fill", "day", "load", "compact", "day", "compact", "day"]
    last = 0
    for step in steps:
        if step == "compact":
            before = {x.id: tuple(x) for x in store.obits().collect()}
            assert compact(store) and {x.id: tuple(x) for x in store.obits().collect()} == before
        elif step == "fill":
            values = [(i, r.choice([None, "Town", "Else"]), r.choice([None, dt.date(2021, 1, 1)])) for i in range(1, last + 1, 3)]
            batch, _ = store.claim("backfill", last)
            fills = spark.createDataFrame(values, "id long, city string, death_date date")
            missing = [OBITS[c] for c in FILLED if c not in ("city", "death_date")]
            store.append_fills(fills.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select("id", *FILLED), batch)
            store.complete("backfill", last, batch)
            plain.fill(values)
        else:
            rows = random_rows(r, last + 1, 12)
            last += 12
            (store_day if step == "day" else lambda _, s, x, b: s.load(records(spark, x), b))(spark, store, rows, store.newest() + 1)
            plain.day(rows, step == "day")
        assert marks_in(store) == plain.marks, step
    got = {x.id: (x.city, x.death_date) for x in store.obits().collect()}
    assert got == {i: (x[3], x[5]) for i, x in plain.rows.items()}
    assert store.snapshot().last_id() == last


def test_a_day_reads_neither_stored_records_nor_shuffles_the_index(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    store_day(spark, store, random_rows(random.Random(3), 1, 40), 0)
    day = spark.createDataFrame([(0, 0, "https://x/5"), (0, 1, "https://X/999")], "market_seq int, pos int, url string")
    store.take(1)
    store.append_records(records(spark, random_rows(random.Random(4), 41, 9)), 1)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df, column in ((store.snapshot().stored_among(wanted_links(day)), "link_key"), (due(store, 1), "person")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "ingest_batch=0" not in plan and "obit_text" not in plan
            scans = [line for line in plan.splitlines() if "FileScan" in line]
            bucketed = [line for line in scans if ".noticeflow_" in line and f"[{column}#" in line]
            assert len(bucketed) == 1 and "Bucketed: true" in bucketed[0]
            # Nothing is exchanged between the scan of the buckets and the join by their key.
            at = plan.splitlines().index(bucketed[0])
            depth = re.search(r"FileScan", bucketed[0]).start()
            for line in reversed(plan.splitlines()[:at]):
                here = re.search(r"[A-Z]", line).start()
                if here < depth:
                    depth = here
                    assert "Exchange" not in line
                    if "Join" in line:
                        break
        assert store.snapshot().stored_among(wanted_links(day)).count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_link_index_equals_the_records(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=4)
    for batch in range(3):
        store_day(spark, store, random_rows(random.Random(batch), 1 + 30 * batch, 30), batch)
    day = spark.createDataFrame([(0, i, f"https://x/{i}") for i in range(0, 200, 7)], "market_seq int, pos int, url string")
    for _ in range(2):
        known = store.snapshot().stored_among(wanted_links(day)).distinct()
        assert known.columns == [LINK_KEY] and known.count() == 12
        new = [sorted(r.url for r in first_new(day, stored).collect()) for stored in (known, store.records(), store.snapshot().links())]
        assert new[0] == new[1] == new[2] and len(new[0]) == 29 - 12
        compact(store)


class Died(Exception):
    pass


@pytest.mark.parametrize("place", ["obits", "links", "run_log", "marks", "people", "manifest"])
def test_a_repeat_that_dies_leaves_the_old_batch(spark, markets, details, tmp_path, monkeypatch, place):  # noqa: F811
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    run_day(store, pages(spark, DAY1, **FIRST), details, markets, DAY1, 0, BASE)
    old = {u: tuple(r) for u, r in by_url(store).items()}
    log = sorted(map(repr, store.log().collect()))
    other = pages(spark, DAY1, a=listing([item("Other Name", "/other")]))
    write, append, commit = Store._write, Store._append, Manifest.commit

    def dies(real):
        def run(self, *args):
            real(self, *args)
            if place in args:
                raise Died
        return run

    def stops(self, entries):
        if entries[-1].done:  # the version that would show the attempt is not completed
            self.spark.range(1).write.parquet(f"{self.folder}/v={self.newest()[0] + 1:012d}/partial")
            raise Died
        commit(self, entries)

    if place == "manifest":
        monkeypatch.setattr(Manifest, "commit", stops)
    monkeypatch.setattr(Store, "_write", dies(write))
    monkeypatch.setattr(Store, "_append", dies(append))
    with pytest.raises(Died):
        run_day(store, other, details, markets, DAY1, 0, BASE)
    monkeypatch.undo()
    for reader in (store, Store(spark, store.root)):
        assert {u: tuple(r) for u, r in by_url(reader).items()} == old
        assert sorted(map(repr, reader.log().collect())) == log
        assert reader.marks_of(0).count() == 1
    # The repeat is run again, to its end, and replaces the batch; what died leaves no trace.
    run_day(store, other, details, markets, DAY1, 0, BASE)
    assert set(by_url(store)) == {"/other"} and store.marks_of(0).count() == 0
    run_day(store, pages(spark, DAY2, **SECOND), details, markets, DAY2, 1, BASE)
    assert set(by_url(store)) == {"/other", "/1", "/3", "/4"}
    assert vacuum(store) >= 3
    assert set(by_url(store)) == {"/other", "/1", "/3", "/4"} and vacuum(store) == 0


def test_generations(spark, markets, details, tmp_path):  # noqa: F811
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    assert not compact(store)
    run_day(store, pages(spark, DAY1, **FIRST), details, markets, DAY1, 0, BASE)
    assert not compact(store)  # the newest batch may be run again
    run_day(store, pages(spark, DAY2, **SECOND), details, markets, DAY2, 1, BASE)
    rows, log = sorted(map(repr, store.obits().collect())), sorted(map(repr, store.log().collect()))
    opened = store.snapshot()
    assert compact(store) and not compact(store)
    assert store.snapshot().generation.batch == 0 and list(store.snapshot().batches) == [1]
    for snapshot in (opened, store.snapshot()):
        assert sorted(map(repr, snapshot.obits().collect())) == rows and sorted(map(repr, snapshot.log().collect())) == log
    plan = store.obits()._jdf.queryExecution().executedPlan().toString()
    assert "ingest_batch=0" not in plan
    assert store.marks_of(0).count() == 1 and store.marks_of(1).count() == 1
    # The batch that is not folded is run again, and one after it.
    run_day(store, pages(spark, DAY2, **SECOND), details, markets, DAY2, 1, BASE)
    assert sorted(map(repr, store.obits().collect())) == rows
    run_day(store, pages(spark, DAY2, c=listing([item("Ann Lee", "/1"), item("New Person", "/9")])), details, markets, DAY2, 2, BASE)
    with pytest.raises(ValueError):
        run_day(store, pages(spark, DAY1), details, markets, DAY1, 0, BASE)
    assert compact(store) and store.snapshot().generation.batch == 1
    assert set(by_url(store)) == {"/1", "/2", "/3", "/4", "/thin", "/9"}
    assert vacuum(store) > 0
    assert set(by_url(store)) == {"/1", "/2", "/3", "/4", "/thin", "/9"} and store.log().count() == 15


def test_a_state_names_the_folders_that_are_read(spark, tmp_path):
    """Also where states are blank or missing, or given by a fill after the fold."""
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    states = ["OH", "oh", "", None, "PA", None]
    rows = [(i, "Jo", f"N{i}", "C", states[i % 6], None, "t") for i in range(1, 31)]
    store_day(spark, store, rows[:24], 0)
    store_day(spark, store, rows[24:], 1)
    compact(store)

    def ids(**request):
        return sorted(r.id for r in store.report(**request).collect())

    def plan(**request):
        return store.report(**request)._jdf.queryExecution().executedPlan().toString()

    assert ids(state="oh") == ids(state=" OH ") == [i for i in range(1, 31) if i % 6 < 2]
    assert ids() == list(range(1, 31)) and ids(state="zz") == []
    pruned = re.compile(r"PartitionFilters: \[[^\]]*state_part")
    assert pruned.search(plan(state="Oh")) and not pruned.search(plan())
    folders = {f.split("state_part=")[1].split("/")[0] for f in store.report(state="oh").inputFiles() if "state_part=" in f}
    assert {"OH"} <= folders <= {"OH", "PA", "none"}
    batch, _ = store.claim("backfill", 7)
    fills = spark.createDataFrame([(3, "PA"), (5, "PA")], "id long, state string")
    store.append_fills(fills.withColumns({c: F.lit(None).cast(OBITS[c].dataType) for c in FILLED if c != "state"}).select("id", *FILLED), batch)
    store.complete("backfill", 7, batch)
    assert ids(state="pa") == sorted([3, 5, *(i for i in range(1, 31) if i % 6 == 4)])


def test_a_folded_epoch_stays_complete(spark, markets, details, tmp_path):  # noqa: F811
    from noticeflow.plans.daily import run_epoch
    store = Store(spark, str(tmp_path / "store"), buckets=2)
    page = pages(spark, DAY1, **FIRST)
    for epoch in range(2):
        assert run_epoch(store, page, details, markets, DAY1, "feed", epoch, BASE) == epoch
    compact(store)
    before = store.obits().count()
    assert run_epoch(store, page, details, markets, DAY1, "feed", 0, BASE) == 0
    assert store.obits().count() == before


def test_manifest_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    for batch in range(6):
        store.take(batch)
        store.complete(NUMBERED, batch, batch)
    assert len(store.manifest.versions()) <= 6 and store.newest() == 5
    assert Store(spark, store.root, buckets=99).snapshot().buckets == 3
    numbers = [e.attempt for e in store.entries() if e.source == NUMBERED]
    assert len(set(numbers)) == 6


def test_many_marks_are_not_broadcast(spark, tmp_path, monkeypatch, capsys):
    """A reader joins many marks by a shuffle, few by a broadcast, with the same rows."""
    store = Store(spark, str(tmp_path))
    store_day(spark, store, [(i, "Ann", "Lee", "Rome", "oh", None, "x") for i in range(1, 5)], 0)
    few, planned = store.report(state="OH"), []
    monkeypatch.setattr("noticeflow.operators.keyed.BROADCAST_ROWS", 2)
    many = store.report(state="OH")
    for df in (few, many):
        assert [r.id for r in df.collect()] == [1]
        df.explain()
        planned.append(capsys.readouterr().out)
    assert "BroadcastHashJoin" in planned[0] and "BroadcastHashJoin" not in planned[1]
