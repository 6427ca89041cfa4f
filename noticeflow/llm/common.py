"""Helpers shared by the operators: staged tables, batches of bounded size, word shingles."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeflow.session import stage
from noticeflow.session import unstage as drop_staged

#: Bytes of text that one step of a Python task works on, beside a single longer text.
BATCH_BYTES = 2 << 20

WORD = re.compile(r"\w+")


def pieces(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts in a piece have at most ``limit`` bytes together; a
    longer text is a piece of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield batch.slice(start)


def by_pieces(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str,
              limit: int = BATCH_BYTES):
    """A function for ``mapInArrow`` that hands ``work`` pieces of bounded size."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, column, limit):
                out = work(piece)
                if out is not None:
                    yield out
    return run


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def held_out(id_col: Column, folds: int, fold: int) -> Column:
    """True for the rows whose crc32 of the id as text falls in the fold; a null id is
    never held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def among_lowest(hashed: Column, wanted: int, total: Column) -> Column:
    """True for hashes low enough that about four times ``wanted`` of ``total`` rows pass. A
    sample of the lowest ``wanted`` is then taken from a few rows, however many tasks there are."""
    return (hashed.cast("double") + 2.0 ** 63) / 2.0 ** 64 < F.lit(4.0 * wanted) / total


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, as ``--py-files`` would, once per application. The
    operators' functions are imported there, whatever the folder the driver was started in."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(context, "_noticeflow_sent", False):
        return
    path = Path(tempfile.mkdtemp(prefix="noticeflow-")) / "noticeflow.zip"
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f.relative_to(package.parent))
    context.addPyFile(str(path))
    context._noticeflow_sent = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = ["BATCH_BYTES", "among_lowest", "by_pieces", "drop_staged", "held_out", "pieces", "ship", "stage", "table",
           "texts_of", "words"]
