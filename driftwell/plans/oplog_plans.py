"""Registered queries: change events to operations and state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions import render
from driftwell.operators import oplog
from driftwell.plans.common import CHANGE_SQL, change_events, registry, scratch, table
from driftwell.session import even_join, materialize
from driftwell.streaming.state import KeptState

PLANS, plan = registry()


def user_tables(spark):
    """The schema of the change events: one entity table, known beforehand."""
    return spark.createDataFrame([("user", "user_id", c) for c in ("user_id", "k", "note", "value")], "table_name string, primary_key string, column_name string")


def log(spark, sf):
    return oplog.operation_log(change_events(spark, sf), user_tables(spark), global_key="agent")


OPS = CHANGE_SQL + """,
tr AS (SELECT *, lag(event) OVER (PARTITION BY user_id ORDER BY seq) AS prev FROM ev WHERE event IN ('add', 'remove')),
ops AS (
  SELECT seq, user_id, value, k, event_type, CASE WHEN coalesce(prev, 'remove') = 'add' THEN 'UPDATE' ELSE 'INSERT' END AS type,
    CASE WHEN event_type = 'purchase' THEN 'user_id,k,note,value' ELSE 'user_id,k,value' END AS columns FROM tr WHERE event = 'add'
  UNION ALL SELECT seq, user_id, value, k, event_type, 'UPDATE', 'value' FROM ev WHERE event = 'change'
  UNION ALL SELECT seq, user_id, value, k, event_type, 'DELETE', '' FROM ev WHERE event = 'remove'
  UNION ALL SELECT seq, user_id, value, k, event_type, 'SELECT', 'value,note' FROM ev WHERE event = 'get')"""


def uneven_batches(operations):
    """The operations in five batches that follow each other in the log, each in a folder, so that a batch reads its own only."""
    spark = operations.sparkSession
    last = operations.agg(F.max("seq")).first()[0]
    inner = [int(last * share) for share in (0.03, 0.3, 0.31, 0.8)]
    number = reduce(Column.__add__, [(F.col("seq") > end).cast("int") for end in inner])
    folder = scratch(spark)
    operations.where("seq > -1").withColumn("batch", number).write.partitionBy("batch").parquet(folder)
    stored = spark.read.schema(operations.withColumn("batch", F.lit(0)).schema).parquet(folder)
    return [stored.where(F.col("batch") == i).drop("batch") for i in range(len(inner) + 1)]


def shown(ops):
    key = F.try_variant_get(F.try_element_at("where", F.lit("user_id")), "$", "bigint")
    return ops.select("seq", "type", F.array_join("columns", ",").alias("columns"), key.alias("where_user"))


def from_event(spark, sf, event):
    """The operations that one kind of event gives, out of the log of all events."""
    kind = change_events(spark, sf).select("seq", "event").where(F.col("event") == event)
    return even_join(log(spark, sf), kind, ["seq"], "left_semi")


@plan("c1_insert_or_update", f"WITH {OPS} SELECT seq, type, columns, CASE WHEN type = 'UPDATE' THEN user_id END AS where_user FROM ops WHERE event_type IN ('signup', 'purchase')")
def _(spark, sf):
    return shown(from_event(spark, sf, "add"))


@plan(
    "c2_junction_inserts",
    "SELECT l_orderkey AS seq, 'INSERT INTO order_part (order_id, part_id) VALUES (' || l_orderkey || ', ' || l_partkey || ');' AS sql "
    "FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)",
)
def _(spark, sf):
    from driftwell.plans.inference_plans import basket_records

    events = basket_records(spark, sf).withColumn("event", F.lit("create"))
    junctions = spark.createDataFrame([("order_part", "order_id", "part_id")], "table_name string, owner string, list_column string")
    return oplog.with_statements(oplog.junction_operations(events, junctions)).select("seq", "sql")


@plan("c3_change_updates", f"WITH {OPS} SELECT seq, type, columns, user_id AS where_user FROM ops WHERE event_type = 'click'")
def _(spark, sf):
    return shown(from_event(spark, sf, "change"))


@plan("c4_remove_deletes", f"WITH {OPS} SELECT seq, type, columns, user_id AS where_user FROM ops WHERE event_type = 'error'")
def _(spark, sf):
    return shown(from_event(spark, sf, "remove"))


LIFE = f"""{OPS},
life AS (SELECT *, max(CASE WHEN type = 'INSERT' THEN seq END) OVER w AS born, max(CASE WHEN type = 'DELETE' THEN seq END) OVER w AS died,
  arg_max(CASE WHEN type IN ('INSERT', 'UPDATE') THEN value END, CASE WHEN type IN ('INSERT', 'UPDATE') THEN seq END) OVER w AS last_value,
  max(CASE WHEN type IN ('INSERT', 'UPDATE') THEN seq END) OVER w AS value_at,
  arg_max(CASE WHEN event_type = 'purchase' THEN k END, CASE WHEN event_type = 'purchase' THEN seq END) OVER w AS last_note,
  max(CASE WHEN event_type = 'purchase' THEN seq END) OVER w AS note_at
  FROM ops WINDOW w AS (PARTITION BY user_id ORDER BY seq))"""


ANSWERS = f"""WITH {LIFE} SELECT seq, 'value' AS "column", CASE WHEN value_at >= born THEN last_value END AS number, CAST(NULL AS VARCHAR) AS text
      FROM life WHERE type = 'SELECT' AND born IS NOT NULL AND (died IS NULL OR born > died)
    UNION ALL SELECT seq, 'note', NULL, CASE WHEN note_at >= born THEN 'it''s ' || last_note END
      FROM life WHERE type = 'SELECT' AND born IS NOT NULL AND (died IS NULL OR born > died)"""


def answer_rows(answered):
    v = F.try_parse_json("value")
    return answered.select(
        "seq", "column", F.when(F.col("column") == "value", F.try_variant_get(v, "$", "double")).alias("number"),
        F.when(F.col("column") == "note", F.try_variant_get(v, "$", "string")).alias("text"),
    )


@plan("c5_answered_gets", ANSWERS)
def _(spark, sf):
    return answer_rows(oplog.answer_gets(log(spark, sf)))


@plan("c5_answered_from_snapshots", ANSWERS)
def _(spark, sf):
    """The same batch by batch: each batch's gets from the state before it and its own operations."""
    kept, answers = KeptState(scratch(spark), buckets=16), []
    for number, batch in enumerate(uneven_batches(materialize(log(spark, sf)))):
        answers.append(kept.answers(spark, batch, number))
        kept.step(spark, batch, number)
    return answer_rows(reduce(DataFrame.unionByName, answers))


@plan("c6_operation_log", f"WITH {OPS} SELECT row_number() OVER (ORDER BY seq) AS op_seq, seq, type, columns, CASE WHEN event_type = 'error' THEN NULL ELSE 'agent' || (seq % 7) END AS actor FROM ops")
def _(spark, sf):
    numbered = oplog.number_operations(log(spark, sf))
    return numbered.select("op_seq", "seq", "type", F.array_join("columns", ",").alias("columns"), "actor")


STATE = f"""WITH {OPS}, b AS (SELECT user_id, max(seq) FILTER (type = 'INSERT') AS born, max(seq) FILTER (type = 'DELETE') AS died FROM ops GROUP BY user_id),
    alive AS (SELECT * FROM b WHERE born IS NOT NULL AND (died IS NULL OR born > died))
    SELECT alive.user_id, arg_max(value, seq) FILTER (type IN ('INSERT', 'UPDATE')) AS value,
      arg_max(k, seq) FILTER (event_type IN ('signup', 'purchase')) AS k, 'it''s ' || arg_max(k, seq) FILTER (event_type = 'purchase') AS note
    FROM alive JOIN ops ON ops.user_id = alive.user_id AND ops.seq >= born GROUP BY alive.user_id"""


def state_rows(cells):
    pick = lambda c, t: F.max(F.when(F.col("column") == c, F.try_variant_get(F.try_parse_json("value"), "$", t))).alias(c)
    return cells.groupBy("table_name", "pk_id").agg(pick("user_id", "bigint"), pick("value", "double"), pick("k", "int"), pick("note", "string")).drop("table_name", "pk_id")


@plan("c7_current_state", STATE)
def _(spark, sf):
    return state_rows(oplog.current_state(log(spark, sf)))


@plan("c7_kept_state", STATE)
def _(spark, sf):
    """The same from operations that arrive in five uneven batches, each aggregated by itself and merged by level."""
    kept = KeptState(scratch(spark), buckets=16)
    for number, batch in enumerate(uneven_batches(materialize(log(spark, sf)))):
        kept.step(spark, batch, number)
    return state_rows(kept.state(spark, 4))


@plan(
    "c8_document_actions",
    f"""WITH {OPS} SELECT seq, CASE type WHEN 'INSERT' THEN 'add' WHEN 'UPDATE' THEN 'change' WHEN 'DELETE' THEN 'remove' ELSE 'get' END AS action,
    'user' AS entity, CASE WHEN type = 'SELECT' THEN columns END AS fields, CASE WHEN type IN ('INSERT', 'UPDATE') THEN value END AS value,
    CASE WHEN type <> 'INSERT' THEN user_id END AS where_user FROM ops""",
)
def _(spark, sf):
    a = oplog.document_actions(log(spark, sf))
    return a.select(
        "seq", "action", "entity", F.array_join("fields", ",").alias("fields"),
        F.try_variant_get(F.try_element_at("data", F.lit("value")), "$", "double").alias("value"),
        F.try_variant_get(F.try_element_at("where", F.lit("user_id")), "$", "bigint").alias("where_user"),
    )


@plan("c9_counts_by_type", f"WITH {OPS} SELECT type, count(*) AS n FROM ops GROUP BY type")
def _(spark, sf):
    return oplog.counts_by_type(log(spark, sf))


@plan(
    "c10_statements",
    f"""WITH {OPS} SELECT seq, CASE type
      WHEN 'DELETE' THEN 'DELETE FROM user WHERE user_id = ' || user_id || ';'
      WHEN 'SELECT' THEN 'SELECT value, note FROM user WHERE user_id = ' || user_id || ';'
      WHEN 'INSERT' THEN 'INSERT INTO user (' || replace(columns, ',', ', ') || ') VALUES (' || user_id || ', ' || k || ', '
        || CASE WHEN event_type = 'purchase' THEN '''it''''s ' || k || ''', ' ELSE '' END || value || ');'
      ELSE 'UPDATE user SET ' || CASE WHEN event_type <> 'click' THEN 'user_id = ' || user_id || ', k = ' || k || ', ' ELSE '' END
        || CASE WHEN event_type = 'purchase' THEN 'note = ''it''''s ' || k || ''', ' ELSE '' END || 'value = ' || value || ' WHERE user_id = ' || user_id || ';'
      END AS sql FROM ops""",
)
def _(spark, sf):
    return oplog.with_statements(log(spark, sf)).select("seq", "sql")


@plan(
    "c10_document_inserts",
    """SELECT event_id AS seq, 'db.' || event_type || '.insertOne({id: ' || event_id || ', name: "say \\"' || user_id || '\\"", ok: ' ||
    CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'null' END || ', tags: [1,"' || event_type || '"]});' AS text FROM events""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    v = lambda c: F.variant_get(F.to_variant_object(F.array(c)), "$[0]", "variant")
    values = F.array(
        v(F.col("event_id")), v(F.concat(F.lit('say "'), F.col("user_id").cast("string"), F.lit('"'))),
        v(F.when(F.col("event_id") % 2 == 0, F.lit(True))),
        F.parse_json(F.concat(F.lit('[1,"'), F.col("event_type"), F.lit('"]'))),
    )
    names = F.array(*[F.lit(c) for c in ("id", "name", "ok", "tags")])
    return e.select(F.col("event_id").alias("seq"), render.document_insert(F.col("event_type"), names, values).alias("text"))


@plan(
    "c10_create_tables",
    "SELECT DISTINCT 't' || event_type AS table_name, 'CREATE TABLE IF NOT EXISTS t' || event_type || ' (' || chr(10) || 'a VARCHAR(255),' || chr(10) || "
    "event_type || ' VARCHAR(255) PRIMARY KEY' || chr(10) || ');' AS sql FROM events",
)
def _(spark, sf):
    kinds = table(spark, sf, "events").select("event_type").distinct()
    tables = kinds.select(
        F.concat(F.lit("t"), "event_type").alias("table_name"), F.col("event_type").alias("primary_key"),
        F.explode(F.array(F.lit("a"), "event_type")).alias("column_name"),
    )
    return oplog.create_operations(tables).select("table_name", "sql")
