"""The second stage as a stream: dependencies, schema and operations that grow with the events.

Count windows of 400 and 1000 records do not end where micro-batches end. An
open window is carried from batch to batch as mergeable partials; when its last
record has come it is closed, its facts are kept, and it is never computed
again. Windows that lie inside one micro-batch are learned without partials. So the facts after any split of the events into batches are those of one
batch over all of them. Everything a batch writes lies below its own id and
depends on that batch and the version before it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from driftwell.operators import dependencies as dep
from driftwell.operators import oplog, schema
from driftwell.operators.scan import dense_number
from driftwell.session import even_join, materialize
from driftwell.sinks import reports
from driftwell.sources import sse
from driftwell.streaming.kept import LearnedSchema, keep_first_seen, keep_schema

COUNTER = "records bigint, operations bigint, steps bigint, epoch bigint, waiting_from bigint, global_key string, unique_fields array<string>"
FACTS = "kind string, a string, b string"
#: Kinds of facts: what dependencies of 400 and of 1000 records say, inclusions, list columns, keys beside a list.
ATTRIBUTE, DETERMINES, INCLUDED, LISTED, BESIDE = "attribute", "determines", "included", "listed", "beside"
SIZES = {ATTRIBUTE: dep.ENTITY_BATCH, DETERMINES: dep.RELATION_BATCH, INCLUDED: dep.RELATION_BATCH}


@dataclass
class SecondStage:
    """Paths of one second stage below ``base``, and its step; without ``log`` it learns only."""

    base: str
    log: bool = True

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def step(self, spark: SparkSession, read_events, batch_id: int) -> None:
        """Learn from one micro-batch and write its operations.

        ``read_events(spark, batch_id)`` gives the events of one batch. Until the
        first ``init`` event, batches wait, since no key is known. An ``init``
        that names other keys than before makes all that was learned void: the
        kept events are then learned once more, from the first batch. Otherwise
        a batch reads its own events only.
        """
        before = self._counter(spark, batch_id - 1)
        own = events = read_events(spark, batch_id)
        config = self._config(events, before)
        if config is None:
            self._save_counter(spark, batch_id, before, waiting_from=before.waiting_from)
            return
        fresh = before.unique_fields is None
        changed = not fresh and config != (before.global_key, list(before.unique_fields))
        first = 0 if changed else before.waiting_from if fresh else batch_id
        if first < batch_id:
            events = reduce(DataFrame.unionByName, [read_events(spark, i) for i in range(first, batch_id + 1)])
        epoch, steps = (batch_id, 0) if changed or fresh else (before.epoch, before.steps)
        events = sse.forwarded(events)
        records = self._learn(spark, events, config, before.records if steps else 0, batch_id, not steps)
        learned = self.learned(spark, batch_id)
        keep_schema(spark, self.path(f"schema_state/{epoch}"), schema_columns(learned), steps)
        since = own.agg(F.coalesce(F.min("seq"), F.lit(0))).first()[0] if changed else 0
        operations = before.operations if not self.log else self._operations(spark, events, learned, config[0], before.operations, since, batch_id, f"keys_seen/{epoch}", steps)
        now = Row(records=records, operations=operations, steps=steps + 1, epoch=epoch, global_key=config[0], unique_fields=config[1])
        self._save_counter(spark, batch_id, now)
        reports.write_schema(learned.tables, learned.foreign, f"{self.path('schema')}/version={batch_id}")

    def _counter(self, spark: SparkSession, version: int) -> Row:
        if version < 0:
            return Row(records=0, operations=0, steps=0, epoch=0, waiting_from=0, global_key=None, unique_fields=None)
        return reports.load_state(spark, self.path("counter"), version).first()

    def _save_counter(self, spark: SparkSession, version: int, c: Row, waiting_from: int | None = None) -> None:
        row = (c.records, c.operations, c.steps, c.epoch, waiting_from, c.global_key, c.unique_fields)
        reports.save_state(spark.createDataFrame([row], COUNTER), self.path("counter"), version)

    def changes(self, spark: SparkSession, epoch: int = 0) -> DataFrame:
        """CREATE and ALTER_TABLE changes of the batches since a key configuration came: type, table_name, columns, batch_id."""
        return spark.read.parquet(f"{self.path(f'schema_state/{epoch}')}/changes")

    @staticmethod
    def _config(events: DataFrame, before: Row) -> tuple[str | None, list[str]] | None:
        """The key configuration of the latest ``init`` so far."""
        inits = events.where((F.col("event") == "init") & F.col("record").isNotNull())
        if not inits.isEmpty():
            found = sse.init_config(inits).first()
            return found.global_key, list(found.unique_fields)
        return None if before.unique_fields is None else (before.global_key, list(before.unique_fields))

    def _learn(self, spark: SparkSession, events: DataFrame, config: tuple, counted: int, batch_id: int, fresh: bool) -> int:
        """Facts of the windows that end in this batch, and the partials of those that stay open. Returns the records so far."""
        global_key, keys = config
        written = events.where(F.col("event").isin("create", "add")).select("seq", "record")
        numbers = dense_number(written.select("seq"), "no", "seq").select("seq", (F.col("no") + counted).alias("no"))
        records = materialize(even_join(written, numbers, ["seq"]))
        total = records.agg(F.coalesce(F.max("no"), F.lit(counted))).first()[0]

        def windows(part: DataFrame, kind: str) -> DataFrame:
            return part.withColumn("batch", dep.batch_number(F.col("no"), SIZES[kind]))

        # only windows open before or after this batch need partials
        longest = max(SIZES.values())
        edges = materialize(records.where((F.col("no") <= counted + longest) | (F.col("no") > total - longest)))
        nothing = spark.createDataFrame([], FACTS)
        facts = [nothing if fresh else reports.load_state(spark, self.path("facts"), batch_id - 1)]
        for kind, size in SIZES.items():
            opened, ended = F.col("batch") == counted // size, F.col("batch") < total // size
            if counted % size == 0:
                opened = F.lit(False)
            facts.append(whole_facts(kind, windows(records, kind).where(ended & ~opened), keys, global_key))
            edge = windows(edges, kind).where(~ended | opened)
            if kind == INCLUDED:
                partials, merge = dep.inclusion_partials(edge, "batch", "record", global_key), dep.merged_inclusions
            else:
                partials, merge = dep.dependency_partials(edge, "batch", "record", keys, global_key), dep.merged_dependencies
            if not fresh:
                partials = merge(partials.unionByName(reports.load_state(spark, self.path(f"open/{kind}"), batch_id - 1)))
            partials = materialize(partials)
            reports.save_state(partials.where(~ended), self.path(f"open/{kind}"), batch_id)
            facts.append(window_facts(kind, partials.where(ended), keys))
        facts.append(dep.list_columns(records, "record", global_key).select(F.lit(LISTED).alias("kind"), F.col("column").alias("a"), F.lit("").alias("b")))
        beside = schema.list_pairs(records, "record", keys)
        facts.append(beside.select(F.lit(BESIDE).alias("kind"), F.col("list_column").alias("a"), F.col("owner").alias("b")))
        # as many rows as pairs of columns, whatever was read
        reports.save_state(reduce(DataFrame.unionByName, facts).distinct(), self.path("facts"), batch_id)
        # the keys this version was learned with
        reports.save_state(spark.createDataFrame([(global_key, keys)], "global_key string, unique_fields array<string>"), self.path("keys"), batch_id)
        return total

    def _keys(self, spark: SparkSession, version: int) -> list[str]:
        return list(reports.load_state(spark, self.path("keys"), version).first().unique_fields)

    def facts(self, spark: SparkSession, version: int) -> DataFrame:
        """kind, a, b after a batch: of closed windows, and of open ones as if they ended here."""
        keys = self._keys(spark, version)
        parts = [reports.load_state(spark, self.path("facts"), version)]
        parts += [window_facts(kind, reports.load_state(spark, self.path(f"open/{kind}"), version), keys) for kind in SIZES]
        return reduce(DataFrame.unionByName, parts).distinct()

    def learned(self, spark: SparkSession, version: int) -> LearnedSchema:
        """Schema after a batch, from its facts."""
        keys, facts = self._keys(spark, version), materialize(self.facts(spark, version))
        pick = lambda kind, a, b: facts.where(F.col("kind") == kind).select(F.col("a").alias(a), F.col("b").alias(b))
        attributes, found = pick(ATTRIBUTE, "key", "column"), pick(DETERMINES, "key", "column")
        lists = pick(LISTED, "column", "_").select("column")
        tables = schema.entity_tables(attributes, keys)
        owners = schema.owners_of_lists(pick(BESIDE, "list_column", "owner"), lists, attributes.union(found))
        return LearnedSchema(
            tables, schema.junction_tables(owners), schema.foreign_keys(tables, pick(INCLUDED, "column", "references")), found, lists
        )

    def _operations(
        self, spark: SparkSession, events: DataFrame, learned: LearnedSchema, global_key: str | None, counted: int,
        since: int, batch_id: int, seen: str, steps: int,
    ) -> int:
        """Write the operations of the events from ``since`` on, numbered on from those before. Returns how many there are so far."""
        rows = materialize(oplog.entity_events(events, learned.tables, global_key=global_key))
        typed = oplog.typed_operations(keep_first_seen(spark, self.path(seen), rows, steps))
        pairs = oplog.junction_operations(events, learned.junctions, global_key=global_key)
        log = typed.unionByName(pairs).where(F.col("seq") >= since)
        numbered = materialize(oplog.number_operations(log, counted))
        reports.write_operation_log(numbered, self.path("operations"), global_key or "username", batch_id)
        return numbered.agg(F.coalesce(F.max("op_seq"), F.lit(counted))).first()[0]


def whole_facts(kind: str, records: DataFrame, keys: list[str], global_key: str | None) -> DataFrame:
    """What windows bear out of which all records are at hand, without partials of them."""
    if kind == INCLUDED:
        held = dep.window_inclusions(records, "batch", "record", keys, global_key).select(F.col("column").alias("a"), F.col("references").alias("b"))
    else:
        held = dep.window_dependencies(records, "batch", "record", keys, global_key).select(F.col("key").alias("a"), F.col("column").alias("b"))
    return held.distinct().select(F.lit(kind).alias("kind"), "a", "b")


def window_facts(kind: str, partials: DataFrame, keys: list[str]) -> DataFrame:
    """What the windows of some partials bear out."""
    if kind == INCLUDED:
        held = dep.held_inclusions(partials, keys).select(F.col("column").alias("a"), F.col("references").alias("b"))
    else:
        held = dep.held_dependencies(partials).select(F.col("key").alias("a"), F.col("column").alias("b"))
    return held.distinct().select(F.lit(kind).alias("kind"), "a", "b")


def schema_columns(learned: LearnedSchema) -> DataFrame:
    """table_name and column_name of entity and junction tables."""
    pairs = learned.junctions.select("table_name", F.explode(F.array("owner", "list_column")).alias("column_name"))
    return learned.tables.select("table_name", "column_name").unionByName(pairs)
