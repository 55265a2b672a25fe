"""Tables that grow by batches and are merged by level, so that no batch reads what is older than its level."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.session import even_join

#: Runs of this many batches, or of this many runs, are merged into one.
FAN = 4


@dataclass
class Runs:
    """Mergeable rows below ``base``. A batch adds its own as a run; ``merge`` makes one run of several.

    ``FAN`` runs of a level are merged into one of the next, so a row is written
    again once per level, and after n batches there are at most ``FAN - 1`` runs
    per level. A batch owns the runs it writes and may run again.

    With ``keys``, rows lie in ``buckets`` folders by a hash of them, and ``read``
    can be told the keys that are wanted: it opens their folders only.
    """

    base: str
    schema: str
    merge: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...] = ()
    buckets: int = 64

    def add(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
        self._write(rows, 0, batch_id)
        level, size = 1, FAN
        while (batch_id + 1) % size == 0:
            last = (batch_id + 1) // size
            parts = [self._read(spark, level - 1, last * FAN - 1 - i) for i in range(FAN)]
            self._write(self.merge(reduce(DataFrame.unionByName, parts)), level, last - 1)
            level, size = level + 1, size * FAN

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, level: int, number: int) -> None:
        if not self.keys:
            rows.write.mode("overwrite").parquet(self._path(level, number))
            return
        # a bucket is one file while it is small; adaptive execution splits those that are not
        placed = rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(self._path(level, number))

    def _path(self, level: int, number: int) -> str:
        return f"{self.base}/runs/level={level}/run={number}"

    def _read(self, spark: SparkSession, level: int, number: int) -> DataFrame:
        schema = f"{self.schema}, bucket int" if self.keys else self.schema
        return spark.read.schema(schema).parquet(self._path(level, number))

    def live(self, version: int) -> list[tuple[int, int]]:
        """(level, number) of the runs that together hold the batches up to ``version``, the largest first."""
        out, start, left, level = [], 0, version + 1, 0
        while FAN ** (level + 1) <= left:
            level += 1
        while left:
            size = FAN**level
            while left >= size:
                out.append((level, start // size))
                start, left = start + size, left - size
            level -= 1
        return out

    def read(self, spark: SparkSession, version: int, wanted: DataFrame | None = None) -> DataFrame:
        """All rows up to a batch, merged; with ``wanted`` (a table of ``keys``, each once) those of its keys."""
        return self.merge(self.parts(spark, version, wanted))

    def parts(self, spark: SparkSession, version: int, wanted: DataFrame | None = None) -> DataFrame:
        """The rows of the runs that ``read`` merges. At most ``buckets`` folder numbers come to the driver."""
        runs = [self._read(spark, *run) for run in self.live(version)]
        if wanted is not None:
            folders = [r.bucket for r in wanted.select(self._bucket().alias("bucket")).distinct().collect()]
            runs = [even_join(r.where(F.col("bucket").isin(folders)), wanted, list(self.keys), "left_semi") for r in runs]
        return reduce(DataFrame.unionByName, runs)
