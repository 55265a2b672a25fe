"""Registered queries: what the sinks write, read back (K1–K8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwell.functions.payload import strict_json
from driftwell.operators import oplog
from driftwell.operators import profiling as pr
from driftwell.operators.widening import type_history
from driftwell.plans.common import registry, scratch, table
from driftwell.plans.oplog_plans import OPS, log
from driftwell.session import materialize
from driftwell.sinks import reports, stores
from driftwell.sources.logs import read_operation_log

PLANS, plan = registry()


def records(spark, sf):
    """Events as open records; ``amount`` is whole in the first half and fractional in the second."""
    half = table(spark, sf, "events").agg((F.max("event_id") / 2).cast("bigint").alias("h")).scalar()
    e = table(spark, sf, "events").withColumn("early", F.col("event_id") < half)
    first = F.col("early")
    raw = F.to_json(
        F.struct(
            "user_id", "event_type", F.when(first, F.col("user_id").cast("double").cast("int")).alias("whole"),
            F.when(~first, F.col("value") + 0.001).alias("part"),
            F.from_json("props", "k int").alias("props"), F.when(F.col("event_id") % 2 == 0, F.lit("even")).alias("rare"),
        )
    )
    # one field whose type differs between the halves
    drift = F.concat(F.substring(raw, F.lit(1), F.length(raw) - 1), F.lit(',"amount":'), F.when(first, F.col("user_id").cast("string")).otherwise(F.lit('"x"')), F.lit("}"))
    return e.select(F.col("event_id").alias("seq"), "early", strict_json(drift).alias("record"))


def batches(spark, sf):
    """Both halves flushed as two batches, each with the placement and types of its own records."""
    path = scratch(spark)
    everything = materialize(records(spark, sf))
    for number, early in enumerate((True, False)):
        part = everything.where(F.col("early") == early).select("seq", "record")
        cells = pr.described_cells(part, "seq", "record")
        history = type_history(cells, ["field"], "seq", "value")
        placement = materialize(pr.final_placement(pr.profile_sums(part, "seq", "record", cells), history))
        stores.flush(part, "record", placement, history.select("field", "final_type"), path, number, ["seq"])
    return path


HALF = "h AS (SELECT CAST(floor(max(event_id) / 2) AS BIGINT) AS h FROM events)"


@plan(
    "k1_relational_sink",
    f"WITH {HALF} SELECT event_id AS seq, user_id, event_type, CASE WHEN event_id < h THEN user_id END AS whole, "
    "CASE WHEN event_id < h THEN CAST(user_id AS VARCHAR) ELSE 'x' END AS amount, CASE WHEN event_id >= h THEN round(value + 0.001, 4) END AS part FROM events, h",
)
def _(spark, sf):
    t = stores.read_relational(spark, f"{batches(spark, sf)}/relational", "root")
    return t.select("seq", "user_id", "event_type", "whole", "amount", F.round("part", 4).alias("part"))


@plan(
    "k2_document_sink",
    "SELECT event_id AS seq, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 2 = 0 THEN 'even' END AS rare FROM events",
)
def _(spark, sf):
    docs = stores.read_documents(spark, f"{batches(spark, sf)}/documents", "root", "seq bigint, document string")
    return docs.select(
        "seq", F.get_json_object("document", "$.props.k").cast("bigint").alias("k"), F.get_json_object("document", "$.rare").alias("rare")
    )


@plan(
    "k3_dual_flush_counts",
    f"WITH {HALF} SELECT CAST(event_id >= h AS INTEGER) AS batch_id, count(*) AS relational_rows, count(*) AS document_rows FROM events, h GROUP BY 1",
)
def _(spark, sf):
    path = batches(spark, sf)
    r = spark.read.option("mergeSchema", "true").parquet(f"{path}/relational/root").groupBy("batch_id").agg(F.count(F.lit(1)).alias("relational_rows"))
    d = spark.read.schema("seq bigint, document string, batch_id int").json(f"{path}/documents/root").groupBy("batch_id").agg(F.count(F.lit(1)).alias("document_rows"))
    return r.join(d, "batch_id")


@plan(
    "k3_no_value_lost",
    "SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN CAST(CAST(10000000000000000000 AS HUGEINT) + event_id AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END AS big, "
    "CASE event_id % 3 WHEN 0 THEN user_id || ',1' WHEN 1 THEN '1,2' ELSE '7' END AS listed, event_type AS upper_name, 'n' || user_id AS lower_name FROM events",
)
def _(spark, sf):
    """Integers beyond 64 bits, lists spelled as text, scalars in a list column, keys that differ in case: what one half lacks the other holds."""
    e = table(spark, sf, "events")
    number = F.col("event_id").cast("string")
    big = F.when(F.col("event_id") % 2 == 0, (F.expr("CAST('10000000000000000000' AS DECIMAL(38,0))") + F.col("event_id")).cast("string")).otherwise(number)
    listed = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), F.col("user_id").cast("string"), F.lit(",1]"))).when(F.col("event_id") % 3 == 1, F.lit('"[1, 2]"')).otherwise(F.lit("7"))
    raw = F.concat(
        F.lit('{"big":'), big, F.lit(',"listed":'), listed, F.lit(',"Name":"'), F.col("event_type"), F.lit('","name":"n'), F.col("user_id").cast("string"), F.lit('"}')
    )
    kept = e.select(F.col("event_id").alias("seq"), strict_json(raw).alias("record"))
    types = {"big": "int", "listed": "list<int>", "Name": "str", "name": "str"}
    placement = spark.createDataFrame([(f, pr.RELATIONAL) for f in types], "field string, dest string")
    path = scratch(spark)
    stores.flush(kept, "record", placement, spark.createDataFrame(list(types.items()), "field string, final_type string"), path, 0, ["seq"])
    relational = stores.read_relational(spark, f"{path}/relational", "root")
    relational = relational.toDF(*[{"Name": "upper_name", "name": "lower_name"}.get(c, c) for c in relational.columns])
    documents = stores.read_documents(spark, f"{path}/documents", "root", "seq bigint, document string")
    return relational.join(documents, "seq", "full_outer").select(
        "seq", F.coalesce(F.col("big").cast("string"), F.get_json_object("document", "$.big")).alias("big"),
        F.coalesce(F.array_join("listed", ","), F.get_json_object("document", "$.listed")).alias("listed"), "upper_name", "lower_name",
    )


@plan("k4_operation_log_sink", f"WITH {OPS} SELECT type, columns, CASE WHEN type NOT IN ('DELETE', 'SELECT') THEN value END AS value FROM ops")
def _(spark, sf):
    path = scratch(spark)
    reports.write_operation_log(oplog.number_operations(log(spark, sf)), path)
    back = read_operation_log(spark, path, "username")
    data = F.map_from_arrays("columns", "values")
    value = F.when(F.size("values") > 0, F.try_variant_get(F.try_element_at(data, F.lit("value")), "$", "double"))
    # the log holds what an operation carries; DELETE and SELECT carry no value
    return back.select("type", F.array_join("columns", ",").alias("columns"), value.alias("value"))


@plan(
    "k5_operation_report",
    f"WITH {OPS}, c AS (SELECT type, count(*) AS n FROM ops GROUP BY type) SELECT type AS name, n FROM c UNION ALL SELECT 'total_queries', CAST(sum(n) AS BIGINT) FROM c",
)
def _(spark, sf):
    path = scratch(spark)
    reports.write_report(oplog.number_operations(log(spark, sf)), path)
    return spark.read.schema("name string, n bigint").json(f"{path}/metadata")


@plan(
    "k5_numbered_statements",
    f"WITH {OPS} SELECT row_number() OVER (ORDER BY seq) AS query_index, lower(type) AS type, upper(type[1]) || lower(type[2:]) || ' on user' AS description FROM ops",
)
def _(spark, sf):
    return reports.operation_report(oplog.number_operations(log(spark, sf))).select("query_index", "type", "description")


@plan(
    "k6_schema_documents",
    "SELECT DISTINCT 't' || event_type AS table_name, event_type AS primary_key, least(event_type, 'value') || ',' || greatest(event_type, 'value') AS columns, 1 AS n_keys FROM events",
)
def _(spark, sf):
    kinds = table(spark, sf, "events").select("event_type").distinct()
    name = F.concat(F.lit("t"), "event_type").alias("table_name")
    tables = kinds.select(name, F.col("event_type").alias("primary_key"), F.explode(F.array(F.lit("value"), "event_type")).alias("column_name"))
    foreign = kinds.select(name, F.lit("value").alias("column_name"), F.lit("other").alias("references_table"), F.lit("id").alias("references_column"))
    path = scratch(spark)
    reports.write_schema(tables, foreign, path)
    schema = "table_name string, primary_key string, columns array<string>, foreign_keys array<struct<column_name:string>>"
    return spark.read.schema(schema).json(path).select(
        "table_name", "primary_key", F.array_join("columns", ",").alias("columns"), F.size("foreign_keys").alias("n_keys")
    )


def executed(spark, sf):
    """An execution log over the orders: selects and updates, some of which failed."""
    o = table(spark, sf, "orders")
    failed = F.col("o_orderstatus") == "P"
    return o.select(
        F.col("o_orderkey").alias("index"), F.when(F.col("o_orderkey") % 3 == 0, "select").otherwise("update").alias("type"),
        F.col("o_orderpriority").alias("entity"), F.when(failed, "failed").otherwise("success").alias("status"),
        (F.col("o_orderkey") % 7).alias("rows_affected"),
    )


@plan(
    "k7_execution_summary",
    "SELECT o_orderpriority AS entity, count(*) AS total_queries, count(*) FILTER (o_orderstatus <> 'P') AS succeeded, "
    "count(*) FILTER (o_orderstatus = 'P') AS failed, count(*) FILTER (o_orderkey % 3 = 0) AS selects, "
    "CAST(sum(o_orderkey % 7) FILTER (o_orderstatus <> 'P') AS BIGINT) AS rows_affected FROM orders GROUP BY 1",
)
def _(spark, sf):
    return reports.execution_summary(executed(spark, sf))


@plan(
    "k7_results_by_entity",
    "SELECT o_orderkey AS index, o_orderpriority AS entity, CASE WHEN o_orderkey % 3 = 0 THEN 'select_results' ELSE 'other_operations' END AS kind FROM orders",
)
def _(spark, sf):
    path = scratch(spark)
    reports.write_results_by_entity(executed(spark, sf), path)
    return spark.read.schema("index bigint, entity string, kind string").json(path)


@plan("k8_state_round_trip", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def _(spark, sf):
    path = scratch(spark)
    state = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
    reports.save_state(state, path, 1)
    return reports.load_state(spark, path, 1)
