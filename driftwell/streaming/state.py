"""The current state of the entity tables, kept while operations arrive (C7), and gets answered from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.operators.oplog import answer_gets, living_cells, state_partials
from driftwell.session import even_join, materialize
from driftwell.streaming.runs import Runs

PARTIALS = "table_name string, pk_id string, column string, at bigint, value string, born bigint, died bigint"


def merged(partials: DataFrame) -> DataFrame:
    """Partials as one: of each cell the last write, of each row its last INSERT and DELETE."""
    return partials.groupBy("table_name", "pk_id", "column").agg(
        F.max("at").alias("at"), F.max_by("value", "at").alias("value"), F.max("born").alias("born"), F.max("died").alias("died")
    )


@dataclass
class KeptState:
    """State below ``base``: what each batch did to rows and cells, in runs merged by level.

    A batch aggregates its own operations and reads none of those before it.
    """

    base: str
    buckets: int = 64

    @property
    def runs(self) -> Runs:
        return Runs(self.base, PARTIALS, merged, ("table_name", "pk_id"), self.buckets)

    def step(self, spark: SparkSession, operations: DataFrame, batch_id: int) -> None:
        self.runs.add(spark, state_partials(operations), batch_id)

    def state(self, spark: SparkSession, version: int) -> DataFrame:
        """table_name, pk_id, column, value after a batch, as ``current_state`` of the whole log up to it."""
        return living_cells(self.runs.read(spark, version))

    def answers(self, spark: SparkSession, operations: DataFrame, batch_id: int) -> DataFrame:
        """The SELECTs of a batch answered as ``answer_gets`` of the whole log would.

        The state before the batch is the snapshot and the batch the log after it.
        Of both only the rows that the batch asks for are scanned, so the cost goes
        with gets and batch, not with the log. Asked before or after ``step``.
        """
        keys = list(self.runs.keys)
        asked = materialize(operations.where("type = 'SELECT' and pk_id is not null").select(*keys).distinct())
        tail = even_join(operations, asked, keys, "left_semi")
        if batch_id == 0:
            return answer_gets(tail)
        return answer_gets(tail, materialize(self.runs.read(spark, batch_id - 1, asked)))
