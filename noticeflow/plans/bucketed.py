"""Narrow side tables of the store, bucketed by their key.

Rows are appended to one bucketed table, each with the attempt that wrote it; a reader takes the
rows of the attempts it sees. A join or an aggregate by the key reads the buckets as they are: only
the other side of the join is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F


def dealt(keys: DataFrame, key: str, buckets: int) -> DataFrame:
    """The different keys, reduced first, in as many partitions as there are buckets."""
    return keys.select(key).distinct().repartition(buckets, key)


@dataclass(frozen=True)
class BucketTable:
    """``columns`` is the layout without the attempt; ``key`` the column that decides the bucket."""

    spark: SparkSession
    path: str
    columns: str
    key: str
    buckets: int

    @property
    def _name(self) -> str:
        """Name in the session's catalog, which only holds the definition; the data are in the folder."""
        return "noticeflow_" + hashlib.sha256(self.path.encode()).hexdigest()[:24]

    def _define(self) -> None:
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._name} ({self.columns}, attempt BIGINT) USING parquet "
                       f"CLUSTERED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        self.spark.catalog.refreshTable(self._name)

    def append(self, rows: DataFrame, attempt: int) -> None:
        """One file per bucket, as the rows are dealt like the buckets."""
        self._define()
        names = self.spark.table(self._name).columns
        (
            rows.withColumn("attempt", F.lit(attempt).cast("bigint")).select(*names).repartition(self.buckets, self.key)
            .write.format("parquet").bucketBy(self.buckets, self.key).mode("append")
            .option("path", self.path).saveAsTable(self._name)
        )

    def among(self, attempts: Iterable[int], keys: DataFrame) -> DataFrame:
        """The rows whose key is among ``keys``. These are dealt like the buckets, which stay where they are
        whatever the session's number of shuffle partitions; where they are few Spark broadcasts them."""
        return self.read(attempts).join(dealt(keys, self.key, self.buckets), self.key, "left_semi")

    def read(self, attempts: Iterable[int]) -> DataFrame:
        self._define()
        return self.spark.table(self._name).where(F.col("attempt").isin(sorted(attempts)))
