"""What a stream keeps between batches: first-seen flags, schema columns; and the batch form of the second stage."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.operators import dependencies as dep
from driftwell.operators import oplog, schema
from driftwell.operators.scan import dense_number
from driftwell.session import even_join, materialize
from driftwell.sinks import reports
from driftwell.sources import sse
from driftwell.streaming.incremental import first_seen_step, latest_flags, schema_step


@dataclass
class LearnedSchema:
    """Tables, junctions, foreign keys, dependencies of an event table."""

    tables: DataFrame
    junctions: DataFrame
    foreign: DataFrame
    dependencies: DataFrame
    lists: DataFrame


def learn_schema(events: DataFrame, keys: list[str], global_key: str | None) -> LearnedSchema:
    """Schema of the create/add events, in batches of 400 and 1000 records."""
    written = events.where(F.col("event").isin("create", "add") & F.col("record").isNotNull()).select("seq", "record")
    # every miner reads the numbered records
    records = materialize(even_join(written, dense_number(written.select("seq"), "no", "seq"), ["seq"]))
    small = records.withColumn("batch", dep.batch_number(F.col("no"), dep.ENTITY_BATCH))
    large = records.withColumn("batch", dep.batch_number(F.col("no"), dep.RELATION_BATCH))
    attributes = dep.ever(dep.window_dependencies(small, "batch", "record", keys, global_key))
    found = dep.ever(dep.window_dependencies(large, "batch", "record", keys, global_key))
    inclusions = dep.ever(dep.window_inclusions(large, "batch", "record", keys, global_key))
    lists = dep.list_columns(records, "record", global_key)
    tables = schema.entity_tables(attributes, keys)
    owners = schema.list_owners(records, "record", keys, lists, attributes.union(found))
    return LearnedSchema(
        tables, schema.junction_tables(owners), schema.foreign_keys(tables, inclusions), found, lists
    )


def build_operations(events: DataFrame, learned: LearnedSchema, global_key: str | None) -> DataFrame:
    """Second pass over the event table: the operation log in event order."""
    return oplog.operation_log(sse.forwarded(events), learned.tables, learned.junctions, global_key=global_key)


#: Batches after which first-seen deltas are merged.
COMPACT_EVERY = 16
SEEN = "table_name string, pk_id string, seen boolean, batch_id bigint"


def keep_first_seen(spark: SparkSession, base: str, batch: DataFrame, batch_id: int) -> DataFrame:
    """First-seen decisions of one micro-batch over kept flags.

    Deltas hold one flag per key a batch touched. Every ``COMPACT_EVERY`` batches
    they are merged with the flags merged before, so that a batch reads the
    merged flags and a bounded number of deltas. Only flags of this batch's keys
    are read into the join.
    """
    start = batch_id // COMPACT_EVERY * COMPACT_EVERY
    if start and start == batch_id:
        _merge_seen(spark, base, start)
    previous = latest_flags(_seen(spark, base, start, batch_id), batch) if batch_id else None
    typed, touched = first_seen_step(previous, batch)
    touched.write.mode("overwrite").parquet(f"{base}/seen/batch_id={batch_id}")
    typed.write.mode("overwrite").parquet(f"{base}/typed/batch_id={batch_id}")
    return spark.read.parquet(f"{base}/typed/batch_id={batch_id}")


def _seen(spark: SparkSession, base: str, start: int, stop: int) -> DataFrame:
    """Flags merged up to ``start`` and the deltas from there to before ``stop``."""
    deltas = spark.read.schema(SEEN).option("basePath", f"{base}/seen")
    parts = [deltas.parquet(f"{base}/seen/batch_id={i}") for i in range(start, stop)]
    if start:
        parts.append(spark.read.schema(SEEN).parquet(f"{base}/merged/{start}"))
    return reduce(DataFrame.unionByName, parts)


def _merge_seen(spark: SparkSession, base: str, start: int) -> None:
    """Write the latest flag of every key as of batch ``start``."""
    flags = _seen(spark, base, start - COMPACT_EVERY, start)
    latest = flags.groupBy("table_name", "pk_id").agg(F.max(F.struct("batch_id", "seen")).alias("l"))
    latest.select("table_name", "pk_id", "l.seen", "l.batch_id").write.mode("overwrite").parquet(f"{base}/merged/{start}")


def keep_schema(spark: SparkSession, base: str, batch: DataFrame, batch_id: int) -> DataFrame:
    """CREATE and ALTER changes of one micro-batch against the columns kept before.

    ``batch`` has (table_name, column_name). A batch writes its changes and the
    columns known after it under its own id.
    """
    now = batch.select("table_name", "column_name").distinct()
    previous = reports.load_state(spark, f"{base}/columns", batch_id - 1) if batch_id else now.limit(0)
    known = previous.unionByName(now).distinct()
    reports.save_state(known, f"{base}/columns", batch_id)
    known = reports.load_state(spark, f"{base}/columns", batch_id).select("table_name", "column_name")
    schema_step(previous.select("table_name", "column_name"), known).write.mode("overwrite").parquet(f"{base}/changes/batch_id={batch_id}")
    return spark.read.parquet(f"{base}/changes/batch_id={batch_id}")
