"""The ingest stream: landed SSE files to an event table and both stores.

Everything a micro-batch writes lives in directories named after its batch id
and depends only on that batch and the state version before it. A batch that is
run again after a failure therefore writes the same thing in the same place.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftwell.operators import oplog
from driftwell.operators.clock import event_time
from driftwell.operators.profiling import final_placement
from driftwell.session import materialize, owned_tables, spread
from driftwell.sinks import reports, stores
from driftwell.sources import sse
from driftwell.streaming.children import ChildTables
from driftwell.streaming.incremental import profile_step
from driftwell.streaming.kept import LearnedSchema, build_operations, keep_first_seen, keep_schema, learn_schema
from driftwell.streaming.second_stage import SecondStage

__all__ = ["Ingest", "LearnedSchema", "build_operations", "keep_first_seen", "keep_schema", "learn_schema"]

EVENTS = (
    "seq bigint, event string, record_text string, record variant, sys_ingested_us bigint, t_stamp double"
)


@dataclass
class Ingest:
    """Paths of one ingest job below ``base``.

    With ``learn`` the second stage runs along: every micro-batch learns the
    schema and writes its operations (see ``second_stage``). With ``children``
    nested objects become rows of their own tables (see ``children``).
    """

    base: str
    learn: bool = False
    children: bool = False

    @property
    def events(self) -> str:
        return f"{self.base}/events"

    @property
    def profile(self) -> str:
        return f"{self.base}/profile"

    @property
    def clock(self) -> str:
        return f"{self.base}/clock"

    def start(
        self, spark: SparkSession, landing: str, max_files: int = 100, available_now: bool = True
    ) -> StreamingQuery:
        """Start, or resume from the checkpoint, reading ``landing``."""
        lines = sse.stream_lines(spark, landing, max_files)
        writer = lines.writeStream.foreachBatch(self.batch).option("checkpointLocation", f"{self.base}/checkpoint")
        if available_now:
            writer = writer.trigger(availableNow=True)
        return writer.start()

    def batch(self, lines: DataFrame, batch_id: int) -> None:
        """One micro-batch: number, stamp, normalise, keep, profile, place, flush."""
        spark = lines.sparkSession
        with owned_tables(spark):
            self._keep_events(lines, batch_id)
            events = self.read_events(spark, batch_id)
            records = sse.forwarded(events)
            previous = reports.load_state(spark, self.profile, batch_id - 1) if batch_id else None
            reports.save_state(profile_step(previous, records, "seq", "record", distinct=True), self.profile, batch_id)
            state = reports.load_state(spark, self.profile, batch_id)
            placement = final_placement(state)
            stores.flush(
                records.select("seq", "sys_ingested_us", "t_stamp", "record"), "record", placement,
                state.select("field", "final_type"), f"{self.base}/stores", batch_id,
                ["seq", "sys_ingested_us", "t_stamp"],
            )
            if self.children:
                ChildTables(f"{self.base}/tables").step(spark, records, batch_id)
            if self.learn:
                self.second_stage.step(spark, self.read_events, batch_id)

    @property
    def second_stage(self) -> SecondStage:
        return SecondStage(f"{self.base}/learned")

    def _keep_events(self, lines: DataFrame, batch_id: int) -> None:
        """Number and stamp the records of the batch in arrival order, and write them down.

        Numbers and stamps go on where the batch before ended. All records of a
        batch share its clock, so each is stamped one microsecond after the one
        before it, and none before the last of the batch before.
        """
        spark = lines.sparkSession
        last = reports.load_state(spark, self.clock, batch_id - 1).first() if batch_id else None
        last_seq, last_us = (last.seq, last.us) if last else (0, 0)
        events = sse.normalise_pairs(spread(sse.split_records(lines, F.lit(last_seq).cast("bigint")), "seq"))
        clock = F.greatest(F.unix_micros(F.current_timestamp()), F.lit(last_us + 1))
        given = F.try_variant_get("record", "$.t_stamp", "double")
        events.select(
            "seq", "event", "record_text", "record", (clock + F.col("seq") - F.lit(last_seq + 1)).alias("sys_ingested_us"),
            event_time(given).alias("t_stamp"),
        ).write.mode("overwrite").parquet(f"{self.events}/batch_id={batch_id}")
        ends = self.read_events(spark, batch_id).agg(
            F.coalesce(F.max("seq"), F.lit(last_seq)).alias("seq"), F.coalesce(F.max("sys_ingested_us"), F.lit(last_us)).alias("us")
        )
        reports.save_state(ends, self.clock, batch_id)

    def conclude(self, spark: SparkSession, version: int) -> None:
        """Second stage over the event table: schema, operation log and schema documents.

        The key configuration is that of the latest ``init`` event of any batch.
        A version owns its directories: concluding it again replaces them.
        """
        with owned_tables(spark):
            events = self.read_events(spark)
            config = sse.init_config(events).first()
            learned = learn_schema(events, config.unique_fields, config.global_key)
            # the log and the documents read the schema several times; it is mined once
            learned = replace(learned, tables=materialize(learned.tables), junctions=materialize(learned.junctions), foreign=materialize(learned.foreign))
            operations = oplog.number_operations(build_operations(events, learned, config.global_key))
            reports.write_operation_log(operations, f"{self.base}/operations", config.global_key or "username", version)
            reports.write_schema(learned.tables, learned.foreign, f"{self.base}/schema/version={version}")

    def read_events(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        """The event table, or one batch of it."""
        path = self.events if batch_id is None else f"{self.events}/batch_id={batch_id}"
        return spark.read.schema(EVENTS).parquet(path)

    def placement(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return final_placement(reports.load_state(spark, self.profile, batch_id))
