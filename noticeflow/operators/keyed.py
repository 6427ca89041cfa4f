"""Keyed building blocks that stay balanced when one key holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

#: Rows of one key from which the key is handled apart. A table of N rows has at most
#: N / HOT_ROWS such keys, which bounds what is broadcast.
HOT_ROWS = 1_000_000

#: Hot keys beyond this number are not broadcast; those over it stay in the shuffle join.
HOT_KEYS = 100_000

#: Rows up to which a table may be broadcast. Spark decides by bytes on disk, and sorted numbers shrink there
#: to a few bytes a row, while the driver holds each row in full.
BROADCAST_ROWS = 200_000

_SPREAD = 4096


def keep_first(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    Comparing the row number with 1 lets Spark cut every input partition down to one row
    per key before the shuffle, so a key with many copies does not load one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def shuffled_if_many(side: DataFrame, rows: int) -> DataFrame:
    """A side of a join that is shuffled and not broadcast where ``rows`` is over ``BROADCAST_ROWS``."""
    return side.hint("merge") if rows > BROADCAST_ROWS else side


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    weight: str,
    spread: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join ``rows`` with ``lookup``, which has one row per key.

    ``weight`` is the lookup column telling how many rows share the key. Keys at or over
    ``hot_rows`` are joined by broadcast, all others by shuffle. Rows already served, and
    rows with a null key, get a salt from ``spread`` and scatter over all tasks instead of
    meeting in one; the others share salt zero with the lookup.
    """
    payload = [c for c in lookup.columns if c not in keys and c != weight]
    usable = reduce(and_, [F.col(k).isNotNull() for k in keys])
    # Stated here, as the join implies it: both uses of the lookup then are the same plan
    # up to its shuffle, which Spark runs once.
    lookup = lookup.where(usable)
    heavy = (
        lookup.where(F.col(weight) >= hot_rows)
        .orderBy(F.col(weight).desc(), *keys).limit(HOT_KEYS)
        .select(*keys, F.struct(*payload).alias("_hot"))
    )
    salt = F.when(F.col("_hot").isNull() & usable, F.lit(0)) \
        .otherwise(1 + F.pmod(F.xxhash64(spread), F.lit(_SPREAD)))
    tagged = rows.join(F.broadcast(heavy), list(keys), "left").withColumn("_salt", salt)
    light = lookup.select(*keys, F.lit(0).cast("bigint").alias("_salt"),
                          F.struct(*payload).alias("_light"))
    joined = tagged.withColumn("_salt", F.col("_salt").cast("bigint")) \
        .join(light, [*keys, "_salt"], "left")
    found = F.coalesce("_hot", "_light")
    return joined.select(*[F.col(c) for c in rows.columns],
                         *[found[c].alias(c) for c in payload])


def number_rows(df: DataFrame, order: Sequence[str], name: str, start: Column) -> DataFrame:
    """Number rows 0, 1, 2 … from ``start`` in ``order``, without sorting in one task.

    The rows are cut into ordered ranges and sorted there, written once with their range and their
    place in it, so that neither can change; only one count per range is summed up centrally.
    """
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stage(cut.withColumns({
        "_range": F.spark_partition_id(),
        # The id counts the rows of a partition in its low 33 bits.
        "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "ranges")
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(name, start + F.col("_ahead") + F.col("_place"))
        .drop("_range", "_place", "_ahead")
    )
