"""Folders of the record store.

``obits`` and ``run_log`` hold what an ingest batch appended, ``marks`` its duplicate marks and
``fills`` what a backfill found for columns of stored records; reading puts a fill where the record
lacks a value. Each attempt at a batch has folders of its own, and the manifest names the attempt
that readers see (see ``manifest``): a batch appears, or is replaced by a repeat of it, in one step,
and nothing already stored is rewritten by another batch.

Two narrow tables, bucketed by their key, keep a day's cost from following the store: ``links`` has
the key of every stored link, ``people`` the records that may still be duplicated (named and not
marked), by a key of the person. Both only grow: a record that leaves ``people`` gets a row with -1.

``compact`` (see ``compaction``) folds batches, marks and fills into a generation; readers then join
only what is newer. A ``Snapshot`` is what one version of the manifest shows.

Batch numbers are never shared between sources, so a stream and daily runs can feed one store. A
batch that was taken but not completed is not visible, and its epoch takes a new number when it
is run again; a completed epoch keeps its number. The store has one writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.dedup import RANK, live, ranked_people
from ..operators.ingest import LINK_KEY, link_key
from ..operators.keyed import shuffled_if_many
from ..operators.report import report_filter
from ..schemas import OBITS, RUN_LOG
from ..sources.tables import NO_STATE, state_part, with_text_length
from .bucketed import BucketTable
from .manifest import GENERATION, SETTINGS, Entry, Manifest

_BATCH, _MARKED = T.StructField("ingest_batch", T.LongType()), T.StructField("marked_in", T.LongType())
_MARKS = T.StructType([OBITS["id"], OBITS["duplicate_of"]])
#: Columns a backfill may fill. In the city a blank counts as missing, elsewhere it is a value.
FILLED = ["birth_date", "death_date", "city", "state", "county"]
_FILLS = T.StructType([OBITS["id"], *[OBITS[c] for c in FILLED]])
_STORED = T.StructType([*OBITS.fields, T.StructField("obit_text_len", T.IntegerType())])
#: Records of a generation.
FOLDED = T.StructType([*_STORED.fields, _BATCH, _MARKED])
#: Ledger source of batches whose number the caller gives.
NUMBERED = "numbered"
_LINKS = f"{LINK_KEY} BINARY"
_PEOPLE = "person BINARY, id BIGINT, undated BOOLEAN, shortness INT, seen TIMESTAMP_NTZ, op INT"


def missing(column: str) -> Column:
    value = F.col(column)
    return value.isNull() | (value == "") if column == "city" else value.isNull()


def filled(rows: DataFrame, fills: DataFrame, how: str = "left") -> DataFrame:
    """``rows`` with the values of ``fills`` (id, _<column>) where they lack their own."""
    return rows.join(fills, "id", how).withColumns({
        c: F.when(missing(c), F.coalesce(f"_{c}", c)).otherwise(F.col(c)) for c in FILLED}).drop(*[f"_{c}" for c in FILLED])


@dataclass(frozen=True)
class Snapshot:
    """The store as one version of its manifest shows it."""

    spark: SparkSession
    root: str
    buckets: int
    #: Visible batches that are not folded, by number, and the generation of the others.
    batches: dict[int, Entry]
    generation: Entry | None

    @property
    def base(self) -> str:
        return f"{self.root}/generations/g={self.generation.epoch:012d}" if self.generation else ""

    def without(self, batch: int | None) -> Snapshot:
        """The same but for one batch."""
        return self._with({b: e for b, e in self.batches.items() if b != batch})

    def upto(self, batch: int) -> Snapshot:
        return self._with({b: e for b, e in self.batches.items() if b <= batch})

    def _with(self, batches: dict[int, Entry]) -> Snapshot:
        return Snapshot(self.spark, self.root, self.buckets, batches, self.generation)

    def _read(self, name: str, layout: T.StructType, only: int | None = None) -> DataFrame:
        """What the visible attempts wrote to a table."""
        layout = T.StructType([*layout.fields, _BATCH, T.StructField("attempt", T.LongType())])
        paths = [f"{self.root}/{name}/ingest_batch={e.batch}/attempt={e.attempt}" for e in self.batches.values()
                 if name in e.tables and only in (None, e.batch)]
        if not paths:
            return self.spark.createDataFrame([], layout).drop("attempt")
        return self.spark.read.schema(layout).option("basePath", f"{self.root}/{name}").parquet(*paths).drop("attempt")

    def _folded(self, name: str, layout: T.StructType) -> DataFrame:
        return self.spark.read.schema(layout).parquet(f"{self.base}/{name}")

    def _attempts(self) -> list[int]:
        return [e.attempt for e in self._visible()]

    def _visible(self) -> list[Entry]:
        return [*self.batches.values(), *([self.generation] if self.generation else [])]

    def _bucketed(self, name: str, columns: str, key: str) -> BucketTable:
        number = self.generation.epoch if self.generation else 0
        return BucketTable(self.spark, f"{self.root}/{name}/generation={number}", columns, key, self.buckets)

    @property
    def link_table(self) -> BucketTable:
        return self._bucketed("links", _LINKS, LINK_KEY)

    @property
    def people_table(self) -> BucketTable:
        return self._bucketed("people", _PEOPLE, "person")

    def links(self) -> DataFrame:
        """Key of every stored link. A join by it reads the buckets as they are."""
        return self.link_table.read(self._attempts()).select(LINK_KEY)

    def stored_among(self, keys: DataFrame) -> DataFrame:
        """The keys (link_key) that are stored."""
        return self.link_table.among(self._attempts(), keys).select(LINK_KEY)

    def people_among(self, persons: DataFrame) -> DataFrame:
        return self.people_table.among(self._attempts(), persons).drop("attempt")

    def people(self) -> DataFrame:
        """What entered (1) and left (-1) the records that may still be duplicated."""
        return self.people_table.read(self._attempts()).drop("attempt")

    @property
    def unchecked(self) -> bool:
        """Whether records came, or changed, after the last marks: persons may then have several unmarked ones."""
        marked = max([b for b, e in self.batches.items() if "marks" in e.tables], default=-1)
        if any("people" in e.tables and b > marked for b, e in self.batches.items()):
            return True
        return marked < 0 and self.generation is not None and "unchecked" in self.generation.tables

    def last_id(self) -> int:
        return max([0, *(e.last_id for e in self._visible())])

    def records(self, only: int | None = None) -> DataFrame:
        """Records with their batch, without what later batches marked or filled."""
        new = self._read("obits", _STORED, only)
        if self.generation is None or only is not None:
            return new
        return self._folded("obits", FOLDED).select(*new.columns).unionByName(new)

    def marks(self, before: int | None = None) -> DataFrame:
        """One mark per id, the earliest, of what is not folded."""
        table = self._read("marks", _MARKS)
        if before is not None:
            table = table.where(F.col("ingest_batch") < before)
        return table.groupBy("id").agg(F.min(F.struct("ingest_batch", "duplicate_of")).alias("_m")).select(
            "id", "_m.duplicate_of", F.col("_m.ingest_batch").alias(_MARKED.name))

    def marks_of(self, batch: int) -> DataFrame:
        """The marks that one batch set."""
        if self.generation is not None and batch <= self.generation.batch:
            return self._folded("obits", FOLDED).where(F.col(_MARKED.name) == batch).select("id", "duplicate_of")
        return self._read("marks", _MARKS, batch).drop("ingest_batch")

    def fills(self) -> DataFrame:
        """One row per filled record. A column is filled once: the first value counts."""
        return self._read("fills", _FILLS).groupBy("id").agg(*[
            F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ingest_batch"))).alias(f"_{c}") for c in FILLED])

    def _side(self, side: DataFrame, name: str) -> DataFrame:
        """``side``, made of what the visible batches wrote to a table, for a join by id. A day's few rows are
        broadcast and the store stays where it is; many would not fit the driver, once per reader. Counting
        reads no column."""
        return shuffled_if_many(side, self._read(name, {"marks": _MARKS, "fills": _FILLS}[name]).count())

    def _has(self, name: str) -> bool:
        return any(name in e.tables for e in self.batches.values())

    def _folded_records(self, state: str | None = None) -> DataFrame:
        """Records of the generation; with a state only the folders that may have it. Where a later fill may
        give a record its state, the folder of those without one is among them."""
        rows = self._folded("obits", T.StructType([*FOLDED.fields, T.StructField("state_part", T.StringType())]))
        if (state or "").strip():
            folders = [state_part(F.lit(state.strip())), *([F.lit(NO_STATE)] if self._has("fills") else [])]
            rows = rows.where(F.col("state_part").isin(*folders))
        return rows.select(*FOLDED.names)

    def joined(self, marks_before: int | None = None, state: str | None = None) -> DataFrame:
        """Records with their marks and fills, which are narrow and have one row per id, and with
        the batches that stored and marked them. With a state: of the folded ones those that may have it."""
        rows = self._read("obits", _STORED).withColumn(_MARKED.name, F.lit(None).cast("bigint"))
        if self.generation is not None:
            rows = self._folded_records(state).unionByName(rows)
        if self._has("marks"):
            marks = self._side(self.marks(marks_before).select(
                "id", F.col("duplicate_of").alias("_mark"), F.col(_MARKED.name).alias("_by")), "marks")
            rows = rows.join(marks, "id", "left").withColumns({
                _MARKED.name: F.when(F.col("duplicate_of").isNull(), F.col("_by")).otherwise(F.col(_MARKED.name)),
                "duplicate_of": F.coalesce("duplicate_of", "_mark")}).drop("_mark", "_by")
        if self._has("fills"):
            rows = filled(rows, self._side(self.fills(), "fills"))
        return rows.select(*FOLDED.names)

    def obits(self, marks_before: int | None = None) -> DataFrame:
        return self.joined(marks_before).drop(_BATCH.name, _MARKED.name)

    def report(self, **filters) -> DataFrame:
        """Records that a report request matches; a state in it says which folders are read."""
        rows = self.joined(state=filters.get("state")).drop(_BATCH.name, _MARKED.name)
        return report_filter(rows, **filters)

    def log(self) -> DataFrame:
        new = self._read("run_log", RUN_LOG)
        if self.generation is None:
            return new
        return self._folded("run_log", T.StructType([*RUN_LOG.fields, _BATCH])).unionByName(new)


@dataclass
class Store:
    """``buckets``: of the narrow tables, about one per 100 MB of keys; settled by the first batch."""

    spark: SparkSession
    root: str
    buckets: int = 16
    _wrote: dict[int, set[str]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.manifest = Manifest(self.spark, f"{self.root}/manifest")

    def entries(self) -> tuple[Entry, ...]:
        return self.manifest.newest()[1]

    def snapshot(self, own: int | None = None) -> Snapshot:
        """What readers see; with ``own`` the open attempt at that batch in place of a complete one."""
        generation, buckets, batches = None, self.buckets, {}
        for e in self.entries():
            if e.source == GENERATION:
                generation = e
            elif e.source == SETTINGS:
                buckets = e.epoch
            elif e.done:
                batches[e.batch] = e
            elif e.batch == own:
                batches[e.batch] = e._replace(tables=tuple(sorted(self._wrote.get(e.attempt, ()))))
        if generation:
            batches = {b: e for b, e in batches.items() if b > generation.batch}
        return Snapshot(self.spark, self.root, buckets, batches, generation)

    # --- batches -----------------------------------------------------------------------------

    def _taken(self) -> list[Entry]:
        return [e for e in self.entries() if e.source not in (GENERATION, SETTINGS)]

    def newest(self) -> int:
        """The highest number taken; -1 for an empty store."""
        return max([-1, *(e.batch for e in self._taken())])

    def _begin(self, source: str, epoch: int, batch: int) -> None:
        version, entries = self.manifest.newest()
        kept = [e for e in entries if e.done or e.batch != batch]
        settings = [] if any(e.source == SETTINGS for e in entries) else [Entry(SETTINGS, self.buckets, -1, 0, True)]
        self.manifest.commit([*settings, *kept, Entry(source, epoch, batch, version + 1, False)])

    def claim(self, source: str, epoch: int) -> tuple[int, bool]:
        """The batch number of an epoch, and whether it is complete already."""
        done = [e.batch for e in self._taken() if (e.source, e.epoch) == (source, epoch) and e.done]
        if done:
            return done[0], True
        batch = self.newest() + 1
        self._begin(source, epoch, batch)
        return batch, False

    def take(self, batch: int) -> None:
        """Begin an attempt at a given number. The newest batch may be run again, but none below it:
        later records and ids depend on what it stored."""
        if batch < self.newest():
            raise ValueError(f"batch {batch} is older than the newest, {self.newest()}")
        known = [e for e in self._taken() if e.batch == batch]
        if any(e.source != NUMBERED for e in known):
            raise ValueError(f"batch {batch} belongs to {known[0].source!r}")
        self._begin(NUMBERED, batch, batch)

    def _open(self, batch: int) -> Entry:
        found = [e for e in self._taken() if e.batch == batch and not e.done]
        if not found:
            raise ValueError(f"no attempt at batch {batch} is open")
        return found[-1]

    def complete(self, source: str, epoch: int, batch: int) -> None:
        """Make the open attempt the visible one."""
        known = self._taken()
        if any(e[:3] == (source, epoch, batch) and e.done for e in known) and all(e.done for e in known if e.batch == batch):
            return
        entry = self._open(batch)
        tables, last_id = tuple(sorted(self._wrote.pop(entry.attempt, ()))), 0
        own = entry._replace(done=True, tables=tables)
        if "obits" in tables:
            written = self.snapshot()._with({batch: own}).records(only=batch)
            last_id = written.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        self.manifest.commit([*(e for e in self.entries() if e.batch != batch or e.source in (GENERATION, SETTINGS)),
                              own._replace(last_id=last_id)])

    # --- readers -----------------------------------------------------------------------------

    def records(self, other_than: int | None = None) -> DataFrame:
        return self.snapshot().without(other_than).records()

    def marks_of(self, batch: int) -> DataFrame:
        return self.snapshot().marks_of(batch)

    def obits(self) -> DataFrame:
        return self.snapshot().obits()

    def report(self, **filters) -> DataFrame:
        return self.snapshot().report(**filters)

    def log(self, own: int | None = None) -> DataFrame:
        return self.snapshot(own).log()

    # --- writers of an open attempt -------------------------------------------------------------

    def _write(self, df: DataFrame, name: str, batch: int) -> None:
        attempt = self._open(batch).attempt
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/ingest_batch={batch}/attempt={attempt}")
        self._wrote.setdefault(attempt, set()).add(name)

    def _append(self, df: DataFrame, table: BucketTable, name: str, batch: int) -> None:
        attempt = self._open(batch).attempt
        table.append(df, attempt)
        self._wrote.setdefault(attempt, set()).add(name)

    def append_records(self, records: DataFrame, batch: int) -> None:
        """Records and the keys of their links, which are read back from what was written."""
        self._write(with_text_length(records), "obits", batch)
        snapshot = self.snapshot(own=batch)
        keys = snapshot.records(only=batch).select(link_key(F.col("legacy_url")).alias(LINK_KEY))
        self._append(keys, snapshot.link_table, "links", batch)

    def append_marks(self, marks: DataFrame, batch: int) -> None:
        self._write(marks, "marks", batch)

    def append_people(self, changes: DataFrame, batch: int) -> None:
        self._append(changes, self.snapshot().people_table, "people", batch)

    def append_fills(self, fills: DataFrame, batch: int) -> None:
        """What a backfill found, and what that changes for the records that may be duplicated:
        the person, or the place among the person's records."""
        self._write(fills, "fills", batch)
        own = self.snapshot(own=batch)
        before = own.without(batch).obits().where("duplicate_of is null")
        found = own._with({batch: own.batches[batch]}).fills()
        narrow = ["id", "first_name", "last_name", "duplicate_of", "obit_text_len", "scraped_at", *FILLED]
        before = before.select(*narrow).join(found.select("id"), "id", "left_semi")
        was, now = ranked_people(before), ranked_people(filled(before, found))
        changes = live(was.withColumn("op", F.lit(-1)).unionByName(now.withColumn("op", F.lit(1))), every=True)
        self._append(changes, own.people_table, "people", batch)

    def append_log(self, log: DataFrame, batch: int) -> None:
        self._write(log, "run_log", batch)

    def load(self, records: DataFrame, batch: int) -> None:
        """Store records as a batch of its own, not marked; the next run looks at all of their persons."""
        self.take(batch)
        self.append_records(records, batch)
        stored = self.snapshot(own=batch).records(only=batch)
        self.append_people(ranked_people(stored).withColumn("op", F.lit(1)), batch)
        self.complete(NUMBERED, batch, batch)


__all__ = ["FILLED", "NUMBERED", "RANK", "Snapshot", "Store", "filled", "missing"]
