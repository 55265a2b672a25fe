"""Mutations of stored tables that rewrite only the files they touch (M3, M5, M6)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.operators.mutate import upsert_rows
from driftwell.operators.query import where_condition
from driftwell.session import materialize, owned_tables


class FileTable:
    """A Parquet table whose versions are lists of files.

    A version is a manifest with one row per file: its path, and the least and
    greatest key of its rows (both null where all keys are null). A mutation
    writes the files that hold touched rows anew and carries the others over by
    name, so unchanged files keep name and time stamp; readers of an older
    version keep it. The key is one column. Rows are laid out by ranges of the
    key, so that few files meet a range of keys. A manifest has a row per file
    and is read by the driver. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path, key

    def create(self, rows: DataFrame, files: int = 8) -> FileTable:
        self._publish(0, self._write(rows, files))
        return self

    def versions(self) -> list[int]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        system = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath() for s in system.listStatus(folder)]
        done = [p.getName() for p in names if system.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(n[1:]) for n in done)

    def manifest(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/manifest/v{self.versions()[-1] if version is None else version}")

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows([r.file for r in self.manifest(version).select("file").collect()])

    def update(self, where: dict, data: dict) -> list[str]:
        """Set fields where the condition holds (M3); the files rewritten."""
        if not data:
            raise ValueError("data must be a non-empty record")
        unknown = set(data) - set(self.read().columns)
        if unknown or self.key in data:
            raise ValueError(f"cannot set {sorted(unknown or {self.key})}")
        hit = self._hit(where)
        change = lambda rows: rows.select(*[
            F.when(hit, F.lit(data[c]).cast(rows.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in data else F.col(c)
            for c in rows.columns
        ])
        return self._rewrite(self._holding(hit, where), change)

    def delete(self, where: dict) -> list[str]:
        """Remove the rows where the condition holds (M6); the files rewritten."""
        hit = self._hit(where)
        return self._rewrite(self._holding(hit, where), lambda rows: rows.where(~hit))

    def upsert(self, incoming: DataFrame, order: str | None = None) -> list[str]:
        """Bulk upsert by key (M5); the files rewritten.

        Files are chosen by a join of the incoming keys with the rows of the
        files whose range meets them; new keys go to files of their own. Null
        keys match no row and are added.
        """
        with owned_tables(self.spark):
            incoming = materialize(incoming)
            span = incoming.agg(F.min(self.key).alias("low"), F.max(self.key).alias("high")).first()
            if span.low is None:
                old = []
            else:
                near = self.manifest().where((F.col("high") >= F.lit(span.low)) & (F.col("low") <= F.lit(span.high)))
                keys = incoming.select(self.key)
                old = self._names(near, lambda rows: rows.join(keys, self.key, "left_semi"))
            return self._rewrite(old, lambda rows: upsert_rows(rows, incoming, [self.key], order), True)

    def _hit(self, where: dict) -> Column:
        if not where:
            raise ValueError("where must be a non-empty condition")
        return F.coalesce(where_condition(where, document=True), F.lit(False))

    def _holding(self, hit: Column, where: dict) -> list[str]:
        """The files with a row that the condition holds for; conditions on the key drop files unread."""
        near = self.manifest()
        wanted = where.get(self.key)
        for op, value in (wanted if isinstance(wanted, dict) else {"=": wanted}).items():
            if value is None or self.key not in where:
                continue
            if op in ("=", "$gt", "$gte"):
                near = near.where(F.col("high") >= F.lit(value))
            if op in ("=", "$lt", "$lte"):
                near = near.where(F.col("low") <= F.lit(value))
        return self._names(near, lambda rows: rows.where(hit))

    def _names(self, near: DataFrame, choose) -> list[str]:
        """Those of the files ``near`` that hold rows which ``choose`` leaves."""
        files = [r.file for r in near.select("file").collect()]
        if not files:
            return []
        rows = self._rows(files).withColumn("_file", F.col("_metadata.file_path"))
        return [r["_file"] for r in choose(rows).select("_file").distinct().collect()]

    def _rows(self, files: list[str]) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/data/*").schema
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*files)

    def _rewrite(self, old: list[str], change, always: bool = False) -> list[str]:
        """A new version without the files ``old``, whose changed rows are in new files."""
        if not old and not always:
            return []
        kept = self.manifest().where(~F.col("file").isin(old)) if old else self.manifest()
        new = self._write(change(self._rows(old)), max(1, len(old)))
        self._publish(self.versions()[-1] + 1, kept.unionByName(new))
        return old

    def _write(self, rows: DataFrame, files: int) -> DataFrame:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        rows.repartitionByRange(files, self.key).write.parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder)
        return written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"))

    def _publish(self, version: int, manifest: DataFrame) -> None:
        """The manifest counts once its folder is complete; a version is written only once."""
        manifest.coalesce(1).write.mode("error").parquet(f"{self.path}/manifest/v{version}")
