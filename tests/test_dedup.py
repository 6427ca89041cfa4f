"""Person-level duplicates against a plain loop over groups."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from noticeflow.operators.dedup import (
    duplicate_groups, duplicate_marks, mark_duplicates, with_primary,
)
from noticeflow.operators.keyed import attach, keep_first, number_rows

SCHEMA = ("id bigint, first_name string, last_name string, city string, state string, "
          "death_date date, obit_text string, scraped_at timestamp_ntz, duplicate_of bigint")
T0 = dt.datetime(2026, 3, 1, 8)
DAY = dt.date(2026, 3, 1)


def row(i, first="John", last="Smith", city="Columbus", state="OH", died=None, text="", hours=0, dup=None):
    return (i, first, last, city, state, died, text, T0 + dt.timedelta(hours=hours), dup)


def plain_marks(rows):
    groups = defaultdict(list)
    for r in rows:
        if r[1] and r[2] and r[8] is None:
            groups[r[1].lower(), r[2].lower(), (r[3] or "").lower(), (r[4] or "").lower()].append(r)
    marks = {}
    for members in groups.values():
        members.sort(key=lambda r: (r[5] is None, -len(r[6] or ""), r[7], r[0]))
        marks |= {r[0]: members[0][0] for r in members[1:]}
    return marks


def marks_of(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r.id: r.duplicate_of for r in duplicate_marks(df, **kw).collect()}


@pytest.mark.parametrize("rows, want", [
    ([], {}),
    ([row(10, died=DAY), row(20, text="x" * 200)], {20: 10}),
    ([row(1, text="x" * 8), row(2, text="x" * 3), row(3, text="x" * 2)], {2: 1, 3: 1}),
    ([row(1), row(2, last="Other")], {}),
    ([row(5, hours=2), row(6, hours=1)], {5: 6}),
    ([row(5), row(4)], {5: 4}),
    ([row(1, first="JOHN", city="columbus"), row(2)], {2: 1}),
    ([row(1, city=None), row(2, city=""), row(3, state=None)], {2: 1}),
    ([row(1, first=""), row(2, first=""), row(3, last=None), row(4, last=None)], {}),
    ([row(1), row(2, dup=1), row(3)], {3: 1}),
])
def test_cases(spark, rows, want):
    assert marks_of(spark, rows) == want


def random_rows(n, seed):
    rng = random.Random(seed)
    return [row(i, *("Hot", "Key", "A", "B") if rng.random() < .4 else (
        rng.choice(["Ann", "ANN", "Bo", "", None]), rng.choice(["Lee", "lee", "Kay"]),
        rng.choice(["X", "x", "", None]), rng.choice(["OH", "", None])),
        died=rng.choice([None, DAY]), text="t" * rng.randint(0, 4), hours=rng.randint(0, 3),
        dup=rng.choice([None] * 6 + [1])) for i in range(n)]


@pytest.mark.parametrize("hot_rows", [1, 20, 10**6])
def test_random_rows_with_a_hot_person(spark, hot_rows):
    rows = random_rows(1500, 11)
    want = plain_marks(rows)
    assert marks_of(spark, rows, hot_rows=hot_rows) == want
    table = mark_duplicates(spark.createDataFrame(rows, SCHEMA), hot_rows=hot_rows)
    assert table.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    got = {r.id: r.duplicate_of for r in table.collect()}
    assert got == {r[0]: want.get(r[0], r[8]) for r in rows}


def test_groups(spark):
    df = spark.createDataFrame([row(1), row(2, first="JOHN"), row(3, last="Kay")], SCHEMA)
    assert [(r.given, r.family, r.town, r.region, r.cnt) for r in duplicate_groups(df).collect()] == [
        ("john", "smith", "columbus", "oh", 2)]


def test_runs_repeat_and_chain(spark):
    first = mark_duplicates(spark.createDataFrame([row(1), row(2)], SCHEMA))
    assert duplicate_marks(first).count() == 0
    # A better late row takes over; rows already pointing to the old one stay.
    later = first.unionByName(spark.createDataFrame([row(3, died=DAY)], SCHEMA))
    second = mark_duplicates(later)
    assert {r.id: r.duplicate_of for r in second.collect()} == {1: 3, 2: 1, 3: None}


def test_accent_insensitive_option(spark):
    rows = [row(1, first="José"), row(2, first="jose")]
    assert marks_of(spark, rows) == {}
    assert marks_of(spark, rows, accent=True) == {2: 1}


def test_stored_length_replaces_text(spark):
    df = spark.createDataFrame([row(1), row(2)], SCHEMA)
    sized = df.withColumn("obit_text_len", F.when(F.col("id") == 2, 9).otherwise(1)).drop("obit_text")
    assert {r.id: r.duplicate_of for r in duplicate_marks(sized).collect()} == {1: 2}


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_with_primary(spark, hot_rows):
    df = spark.createDataFrame(
        [(1, None, "u1", "A"), (2, 1, "u2", "B"), (3, 1, "u3", "C"), (4, None, "u4", "D"), (5, 4, "u5", "E")],
        "id bigint, duplicate_of bigint, legacy_url string, deceased_name string")
    got = sorted((r.id, r.duplicate_of, r.duplicate_url, r.primary_url, r.primary_name)
                 for r in with_primary(df, hot_rows=hot_rows).collect())
    assert got == [(2, 1, "u2", "u1", "A"), (3, 1, "u3", "u1", "A"), (5, 4, "u5", "u4", "D")]


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_attach_is_a_left_join(spark, hot_rows):
    rows = spark.createDataFrame(
        [(i, None if i % 7 == 0 else "hot" if i % 3 else f"k{i % 40}") for i in range(900)], "id bigint, k string")
    look = spark.createDataFrame([("hot", 500, "H"), *[(f"k{i}", 20, f"v{i}") for i in range(0, 40, 2)]],
                                 "k string, n bigint, v string")
    got = attach(rows, look, ["k"], weight="n", spread=F.col("id"), hot_rows=hot_rows)
    want = rows.join(look.drop("n"), "k", "left")
    key = lambda r: (r.id, r.k or "", r.v or "")
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


def test_keep_first_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    kept = keep_first(df, [F.col("k")], [F.col("o").desc()])
    assert sorted((r.k, r.o) for r in kept.collect()) == [(0, 999), (1, 997), (2, 998)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_number_rows(spark):
    rows = [(i * 7919 % 5000, f"n{i % 3}") for i in range(5000)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(5)
    got = number_rows(df, ["b", "a"], "seq", F.lit(10).cast("bigint")).orderBy("seq").collect()
    assert [r.seq for r in got] == list(range(10, 5010))
    assert [(r.b, r.a) for r in got] == sorted((b, a) for a, b in rows)


def test_number_rows_are_sorted_where_they_are_cut(spark):
    """Places come from the cut itself: the numbered rows are neither shuffled nor sorted again. Equal, null and empty ranges."""
    rows = [(None if i % 7 == 0 else i % 40, i) for i in range(900)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(6)
    numbered = number_rows(df, ["a"], "seq", F.lit(1).cast("bigint"))
    got = numbered.orderBy("seq").collect()
    assert [r.seq for r in got] == list(range(1, 901)) and sorted(r.b for r in got) == list(range(900))
    assert [r.a for r in got] == sorted((a for a, _ in rows), key=lambda a: (a is not None, a or 0))
    assert numbered.columns == ["a", "b", "seq"]
    assert "row_number" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert number_rows(df.where("b < 0"), ["a"], "seq", F.lit(0)).count() == 0
