"""What a reader of the store sees: which attempt of which batch counts.

A batch may be run more than once; each run is an attempt with a number of its own and writes
to folders of its own. The manifest has a row for each batch and names the attempt that is
visible. It is written as a whole under the next version number, and a version counts once Spark
has put its ``_SUCCESS`` file there. So a batch changes from one attempt to the next in one step,
and an attempt that dies leaves what readers saw before.

Versions are small: a row per batch that is not yet folded into a generation, one per folded epoch
(so that the epoch is known to be complete), and one for the store's settings.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import types as T

#: Versions that are kept for readers who opened them.
KEPT = 5
#: Sources of rows that are no batches.
GENERATION, SETTINGS = "generation", "settings"


class Entry(NamedTuple):
    """A batch of an epoch of a source. ``attempt`` is the manifest version that began it, so no two
    attempts share a number. ``tables``: what the attempt wrote; none for a folded batch. For a
    generation, ``epoch`` and ``attempt`` are its number and ``batch`` the last one folded into it."""

    source: str
    epoch: int
    batch: int
    attempt: int
    done: bool
    last_id: int = 0
    tables: tuple[str, ...] = ()


_LAYOUT = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("epoch", T.LongType()), T.StructField("batch", T.LongType()),
    T.StructField("attempt", T.LongType()), T.StructField("done", T.BooleanType()), T.StructField("last_id", T.LongType()),
    T.StructField("tables", T.ArrayType(T.StringType()))])


@dataclass
class Manifest:
    spark: SparkSession
    folder: str
    _read: dict[int, tuple[Entry, ...]] = field(default_factory=dict)

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def versions(self) -> list[int]:
        """The complete versions, oldest first."""
        files = self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(self._path()):
            return []
        found = files.globStatus(self._path("v=*/_SUCCESS"))
        return sorted(int(f.getPath().getParent().getName()[2:]) for f in found)

    def newest(self) -> tuple[int, tuple[Entry, ...]]:
        """The newest version and its rows; a version is read once, as it never changes."""
        known = self.versions()
        if not known:
            return 0, ()
        version = known[-1]
        if version not in self._read:
            rows = self.spark.read.schema(_LAYOUT).parquet(f"{self.folder}/v={version:012d}").collect()
            self._read.clear()
            self._read[version] = tuple(sorted(
                (Entry(r.source, r.epoch, r.batch, r.attempt, r.done, r.last_id, tuple(r.tables)) for r in rows),
                key=lambda e: (e.batch, e.attempt)))
        return version, self._read[version]

    def commit(self, entries: list[Entry]) -> None:
        """Write the next version. What stands there without ``_SUCCESS`` is an attempt to write it."""
        version = self.newest()[0] + 1
        rows = self.spark.createDataFrame([e._replace(tables=list(e.tables)) for e in entries], _LAYOUT)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/v={version:012d}")
        files = self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())
        for old in self.versions()[:-KEPT]:
            files.delete(self._path(f"v={old:012d}"), True)
