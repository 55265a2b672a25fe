"""Distinct counts and placements that are kept while records arrive.

Each part owns a folder; a micro-batch writes below its own id and reads only
the versions before it, so it may run again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.functions.payload import fixed_width, identity
from driftwell.operators import profiling as pr
from driftwell.session import materialize
from driftwell.sinks import reports
from driftwell.streaming.incremental import profile_step
from driftwell.streaming.runs import Runs

#: Buckets of a sketch, as a power of two; the standard error is about 1.04 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 12
VALUES = "field string, listed boolean, h1 bigint, h2 bigint, seen bigint"
SKETCHES = "field string, total_seen bigint, sketch binary"


@dataclass
class DistinctValues:
    """How many distinct values each field has, by sketch at every batch and exactly on demand, below ``base``.

    A batch adds its own distinct values as a run and never reads older ones
    but to merge runs by level (see ``Runs``).
    """

    base: str

    def step(self, spark: SparkSession, records: DataFrame, seq: str, payload: str, batch_id: int) -> None:
        cells = pr.record_cells(records.select(seq, payload), seq, payload).where(~F.col("nested"))
        shown = F.when(~F.col("is_list"), identity(F.col("value")))
        cells = cells.select("field", F.col("is_list").alias("listed"), shown.alias("shown"))
        h1, h2 = fixed_width(F.col("shown"))
        own = materialize(cells.select("field", "listed", "shown", h1.alias("h1"), h2.alias("h2")).groupBy(
            "field", "listed", F.when(~F.col("listed"), F.col("h1")).alias("h1"), F.when(~F.col("listed"), F.col("h2")).alias("h2")
        ).agg(F.count(F.lit(1)).alias("seen")))
        self.runs.add(spark, own, batch_id)
        sketched = own.groupBy("field").agg(
            F.sum("seen").alias("total_seen"),
            F.hll_sketch_agg(F.when(~F.col("listed"), F.concat_ws(",", F.col("h1").cast("string"), F.col("h2").cast("string"))), F.lit(SKETCH_BITS)).alias("sketch"),
        )
        if batch_id:
            kept = reports.load_state(spark, f"{self.base}/sketches", batch_id - 1)
            sketched = kept.unionByName(sketched).groupBy("field").agg(F.sum("total_seen").alias("total_seen"), F.hll_union_agg("sketch").alias("sketch"))
        reports.save_state(sketched, f"{self.base}/sketches", batch_id)

    @property
    def runs(self) -> Runs:
        return Runs(self.base, VALUES, merged)

    def estimated(self, spark: SparkSession, version: int) -> DataFrame:
        """field, total_seen, unique_estimate, cardinality_ratio after a batch: one row per field is read."""
        kept = reports.load_state(spark, f"{self.base}/sketches", version)
        estimate = F.hll_sketch_estimate("sketch")
        return kept.select("field", "total_seen", estimate.alias("unique_estimate"), (estimate / F.col("total_seen")).alias("cardinality_ratio"))

    def exact(self, spark: SparkSession, version: int) -> DataFrame:
        """field, total_seen, unique_count, cardinality_ratio, is_unique after a batch.

        Values are told apart by 128 bits of hash, and spread over all tasks
        before they are counted per field.
        """
        values = self.runs.read(spark, version)
        counted = values.groupBy("field").agg(F.sum("seen").alias("total_seen"), F.count_if(~F.col("listed")).alias("unique_count"))
        return counted.select(
            "field", "total_seen", "unique_count", (F.col("unique_count") / F.col("total_seen")).alias("cardinality_ratio"),
            (F.col("unique_count") == F.col("total_seen")).alias("is_unique"),
        )


def merged(values: DataFrame) -> DataFrame:
    """Runs as one: each value of a field once."""
    return values.groupBy("field", "listed", "h1", "h2").agg(F.sum("seen").alias("seen"))


@dataclass
class PlacementLog:
    """The store each value goes to when its record arrives, and the changes of store, below ``base``.

    Running figures of a batch start from the profile kept before it, so the
    decision on record n rests on all records up to n, those of earlier batches
    included, of which none is read again.
    """

    base: str

    def step(self, spark: SparkSession, records: DataFrame, seq: str, payload: str, batch_id: int) -> None:
        profile = last = None
        if batch_id:
            profile = reports.load_state(spark, f"{self.base}/profile", batch_id - 1)
            last = reports.load_state(spark, f"{self.base}/last", batch_id - 1)
        replay = materialize(pr.placement_replay(records, seq, payload, carried=profile))
        changes = pr.reclassified(replay, seq, last)
        changes.write.mode("overwrite").parquet(f"{self.base}/changes/batch_id={batch_id}")
        now = pr.last_decisions(replay, seq)
        if last is not None:
            now = now.unionByName(last.join(now, "field", "left_anti"))
        reports.save_state(now, f"{self.base}/last", batch_id)
        reports.save_state(profile_step(profile, records, seq, payload), f"{self.base}/profile", batch_id)

    def changes(self, spark: SparkSession) -> DataFrame:
        """Changes of store of all batches: field, seq column, old_dest, new_dest, batch_id."""
        return spark.read.parquet(f"{self.base}/changes")

    def placement(self, spark: SparkSession, version: int) -> DataFrame:
        """field and dest after a batch."""
        return reports.load_state(spark, f"{self.base}/last", version)
