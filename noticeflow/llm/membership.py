"""A set of keys as a bitmap of fixed size, to let most other rows go before a join.

Two keys may share a bit, so a row that passes has to be settled exactly by what follows. The
bitmap has ``BITS`` bits (256 rows of 4 KB) however many keys there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def _slot(*cols: str) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(BITS))


def bitmap(keys: DataFrame, name: str, *cols: str) -> DataFrame:
    """The keys as at most BITS / 32768 rows (block number, bits)."""
    slot = _slot(*cols)
    return keys.groupBy(F.bitmap_bucket_number(slot).alias(f"{name}_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias(f"{name}_bits"))


def probe(df: DataFrame, bits: DataFrame, name: str, *cols: str) -> DataFrame:
    """Add the boolean column ``name``, which ``df`` lacks: the row's bit is set. Its other columns may have any name."""
    slot = _slot(*cols)
    slots = df.withColumn(name, F.struct(F.bitmap_bucket_number(slot).alias("block"), F.bitmap_bit_position(slot).alias("place")))
    held = bits.select(F.struct(F.col(f"{name}_block").alias("block"), F.col(f"{name}_bits").alias("bits")).alias(f"{name}_held"))
    joined = slots.join(F.broadcast(held), F.col(f"{name}.block") == F.col(f"{name}_held.block"), "left")
    bit = F.expr(f"shiftright(cast(conv(hex(substring(`{name}_held`.bits, cast(`{name}`.place div 8 as int) + 1, 1)),"
                 f" 16, 10) as int), cast(`{name}`.place % 8 as int)) & 1 = 1")
    return joined.withColumn(name, F.coalesce(bit, F.lit(False))).select(*df.columns, name)
