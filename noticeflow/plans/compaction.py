"""Folding of batches into a generation, and removal of what no reader can see any more.

A generation holds the records of all batches up to one with their marks and fills in place, the run
log of these batches, the keys of their links, and of the people only those records that may still be
duplicated. It is written next to what it replaces and becomes visible with one manifest version; an
attempt that dies leaves folders that nobody reads. The newest batch is never folded, as it may be
run again. Readers who opened the store before go on with what they opened until ``vacuum``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import live
from ..sources.tables import cluster_by_state
from .manifest import GENERATION, SETTINGS, Entry
from .store import Snapshot, Store


def compact(store: Store) -> bool:
    """Fold all complete batches but the newest number; returns whether there were any."""
    now = store.snapshot()
    folded = now.upto(store.newest() - 1)
    if not folded.batches:
        return False
    version, entries = store.manifest.newest()
    last = max(folded.batches)
    unchecked = folded.unchecked
    generation = Entry(GENERATION, version + 1, last, version + 1, True, folded.last_id(), ("unchecked",) if unchecked else ())
    new = Snapshot(store.spark, store.root, now.buckets, {}, generation)
    cluster_by_state(folded.joined()).write.mode("overwrite").partitionBy("state_part").parquet(f"{new.base}/obits")
    folded.log().coalesce(1 + len(folded.batches) // 100).write.mode("overwrite").parquet(f"{new.base}/run_log")
    new.link_table.append(folded.links(), generation.attempt)
    new.people_table.append(live(folded.people()).withColumn("op", F.lit(1)), generation.attempt)
    rest = now._with({b: e for b, e in now.batches.items() if b > last})
    for e in rest.batches.values():  # rows of the newest batch move to the new tables as they are
        own = rest._with({e.batch: e})
        own = Snapshot(own.spark, own.root, own.buckets, own.batches, now.generation)
        if "links" in e.tables:
            new.link_table.append(own.link_table.read([e.attempt]), e.attempt)
        if "people" in e.tables:
            new.people_table.append(own.people_table.read([e.attempt]), e.attempt)
    kept = [e._replace(tables=()) if e.batch <= last else e for e in entries
            if e.source not in (GENERATION, SETTINGS) and (e.done or e.batch > last)]
    store.manifest.commit([*(e for e in entries if e.source == SETTINGS), generation, *kept])
    return True


def vacuum(store: Store) -> int:
    """Delete the folders of attempts and generations that the newest manifest does not name; returns
    how many. To be run when no reader uses an older version and no batch is being written."""
    now = store.snapshot()
    spark = store.spark
    files = spark._jvm.org.apache.hadoop.fs.Path(store.root).getFileSystem(spark._jsc.hadoopConfiguration())
    used = {f"attempt={e.attempt}" for e in now.batches.values()}
    number = now.generation.epoch if now.generation else 0
    used |= {f"generation={number}", f"g={number:012d}"}
    gone = 0
    for pattern in ("obits/*/*", "run_log/*/*", "marks/*/*", "fills/*/*", "generations/*", "links/*", "people/*"):
        for found in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{store.root}/{pattern}")) or []:
            if found.getPath().getName() not in used:
                files.delete(found.getPath(), True)
                gone += 1
    return gone
