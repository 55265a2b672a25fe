"""Change events to an ordered operation log, and back to state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions import render
from driftwell.functions.payload import each, fields, identity, is_list, text
from driftwell.operators.scan import Running, dense_number, running_scan
from driftwell.session import even_join, lookup_join, materialize

DDL_SEQ = -1
LOG_COLUMNS = ["seq", "type", "table_name", "columns", "values", "where", "pk_id", "actor"]


def table_definitions(tables: DataFrame) -> DataFrame:
    """One row per entity table: table_name, primary_key, table_columns (key first)."""
    others = F.array_sort(F.collect_set(F.when(F.col("column_name") != F.col("primary_key"), F.col("column_name"))))
    return tables.groupBy("table_name", "primary_key").agg(others.alias("o")).select(
        "table_name", "primary_key", F.array_prepend("o", F.col("primary_key")).alias("table_columns")
    )


def _none(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def create_operations(tables: DataFrame, foreign: DataFrame | None = None) -> DataFrame:
    """CREATE operations of all entity tables with their text."""
    defs = table_definitions(tables)
    keys = None
    if foreign is not None:
        per_table = foreign.groupBy("table_name").agg(
            F.array_sort(F.collect_set(F.struct(F.col("column_name").alias("column"), "references_table", "references_column"))).alias("fk")
        )
        defs = defs.join(per_table, "table_name", "left").withColumn(
            "fk", F.coalesce("fk", F.array().cast("array<struct<column:string,references_table:string,references_column:string>>"))
        )
        keys = F.col("fk")
    return defs.select(
        F.lit(DDL_SEQ).cast("bigint").alias("seq"), F.lit("CREATE").alias("type"), "table_name",
        F.col("table_columns").alias("columns"),
        render.create_table(F.col("table_name"), F.col("table_columns"), F.col("primary_key"), keys).alias("sql"),
    )


def entity_events(
    events: DataFrame, tables: DataFrame, seq: str = "seq", record: str = "record", global_key: str | None = None
) -> DataFrame:
    """One row per event and table whose key it carries, with what the event writes, asks or names there."""
    defs = table_definitions(tables)
    skip = [k for k in (global_key, "COLUMNS") if k]
    prepared = events.select(
        F.col(seq).cast("bigint").alias("seq"), "event", fields(F.col(record)).alias("r")
    ).withColumn(
        "scalars",
        F.map_keys(F.map_filter("r", lambda k, v: ~k.isin(skip) & ~F.coalesce(is_list(v), F.lit(False)))),
    )
    # only the fields that are keys are worth a row
    keys = defs.agg(F.collect_set("primary_key").alias("k")).scalar()
    keyed = lookup_join(
        each(prepared, F.array_intersect("scalars", keys), "primary_key"),
        defs, ["primary_key"], "inner",
    )
    empty = F.array().cast("array<string>")
    present = F.array_intersect("table_columns", "scalars")
    hint = F.try_variant_get(F.try_element_at("r", F.lit("COLUMNS")), "$", "array<string>")
    known = F.filter(hint, lambda c: F.array_contains("table_columns", c))
    is_write = F.col("event").isin("create", "add")
    columns = (
        F.when(is_write, present)
        .when(F.col("event") == "change", F.array_remove(present, F.col("primary_key")))
        .when(F.col("event") == "get", F.when(F.size(hint) > 0, known).otherwise(F.col("table_columns")))
        .otherwise(empty)
    )
    key_value = F.try_element_at("r", F.col("primary_key"))
    named = keyed.withColumn("columns", columns)
    values = F.when(
        F.col("event").isin("create", "add", "change"), F.transform("columns", lambda c: F.try_element_at("r", c))
    ).otherwise(F.array().cast("array<variant>"))
    return named.select(
        "seq", "event", "table_name", "columns", values.alias("values"),
        F.map_from_arrays(F.array("primary_key"), F.array(key_value)).alias("where"),
        identity(key_value).alias("pk_id"),
        (text(F.try_element_at("r", F.lit(global_key))) if global_key else _none("string")).alias("actor"),
    ).where((F.col("event") != "change") | (F.size("columns") > 0))


def entity_operations(
    events: DataFrame, tables: DataFrame, seq: str = "seq", record: str = "record", global_key: str | None = None
) -> DataFrame:
    """Operations on entity tables, one per event and table whose key it carries.

    create/add give INSERT for a key not seen, or seen again after a remove, and
    UPDATE otherwise; change, remove and get give UPDATE, DELETE and SELECT.
    Whether a key is seen follows from its previous create, add or remove, which
    an ordered scan finds, so a key with very many events is still split.
    """
    # the scan reads its input twice; parsing and joining happen once
    rows = materialize(entity_events(events, tables, seq, record, global_key))
    is_write = F.col("event").isin("create", "add")
    trace = F.when(is_write, "seen").when(F.col("event") == "remove", "gone")
    scanned = running_scan(rows, ["table_name", "pk_id"], "seq", {"_was": Running("last", trace, inclusive=False)})
    kind = (
        F.when(is_write, F.when(F.coalesce("_was", F.lit("gone")) == "seen", "UPDATE").otherwise("INSERT"))
        .when(F.col("event") == "change", "UPDATE")
        .when(F.col("event") == "remove", "DELETE")
        .when(F.col("event") == "get", "SELECT")
    )
    return typed_operations(scanned.withColumn("type", kind))


def typed_operations(rows: DataFrame) -> DataFrame:
    """Entity events with their ``type`` as operations: an INSERT names no row."""
    where = F.when(F.col("type") != "INSERT", F.col("where"))
    return rows.where(F.col("type").isNotNull()).select(
        "seq", "type", "table_name", "columns", "values", where.alias("where"), "pk_id", "actor"
    )


def junction_operations(
    events: DataFrame, junctions: DataFrame, seq: str = "seq", record: str = "record", global_key: str | None = None
) -> DataFrame:
    """One INSERT per list element of a junction table."""
    prepared = events.where(F.col("event").isin("create", "add")).select(
        F.col(seq).cast("bigint").alias("seq"), fields(F.col(record)).alias("r")
    ).withColumn(
        "list_column", F.explode(F.map_keys(F.map_filter("r", lambda k, v: F.coalesce(is_list(v), F.lit(False)))))
    )
    rows = lookup_join(
        prepared, junctions.select("table_name", "owner", "list_column"), ["list_column"], "inner"
    )
    owner = F.try_element_at("r", F.col("owner"))
    items = F.try_variant_get(F.try_element_at("r", F.col("list_column")), "$", "array<variant>")
    usable = rows.where(owner.isNotNull() & (F.schema_of_variant(owner) != "VOID") & ~is_list(owner))
    return usable.select("*", F.explode(items).alias("item")).select(
        "seq", F.lit("INSERT").alias("type"), "table_name",
        F.array("owner", "list_column").alias("columns"), F.array(owner, F.col("item")).alias("values"),
        _none("map<string,variant>").alias("where"), _none("string").alias("pk_id"),
        (text(F.try_element_at("r", F.lit(global_key))) if global_key else _none("string")).alias("actor"),
    )


def operation_log(
    events: DataFrame,
    tables: DataFrame,
    junctions: DataFrame | None = None,
    seq: str = "seq",
    record: str = "record",
    global_key: str | None = None,
) -> DataFrame:
    """The whole log in event order; operations of one event in table order."""
    log = entity_operations(events, tables, seq, record, global_key)
    if junctions is not None:
        log = log.unionByName(junction_operations(events, junctions, seq, record, global_key))
    return log.select(*LOG_COLUMNS)


def number_operations(log: DataFrame, after: int = 0) -> DataFrame:
    """Add ``op_seq`` 1, 2, … (or on from ``after``) and the statement text ``sql``."""
    shown = log.withColumn("_shown", F.to_json("values"))
    numbered = dense_number(shown, "op_seq", "seq", tie=["table_name", "_shown"]).drop("_shown")
    return with_statements(numbered.withColumn("op_seq", F.col("op_seq") + after))


def with_statements(log: DataFrame) -> DataFrame:
    text_of = render.statement(*[F.col(c) for c in ("type", "table_name", "columns", "values", "where")])
    return log.withColumn("sql", text_of)


def counts_by_type(log: DataFrame) -> DataFrame:
    """Operations per type."""
    return log.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def document_actions(log: DataFrame) -> DataFrame:
    """The log as document-store actions (C8): seq, action, entity, fields, data, where."""
    action = (
        F.when(F.col("type") == "INSERT", "add").when(F.col("type") == "UPDATE", "change")
        .when(F.col("type") == "DELETE", "remove").when(F.col("type") == "SELECT", "get")
    )
    writes = F.col("type").isin("INSERT", "UPDATE")
    return log.where(action.isNotNull()).select(
        "seq", action.alias("action"), F.col("table_name").alias("entity"),
        F.when(F.col("type") == "SELECT", F.col("columns")).alias("fields"),
        F.when(writes, F.map_from_arrays("columns", "values")).alias("data"),
        F.col("where"),
    )


def current_state(log: DataFrame) -> DataFrame:
    """State after the whole log: table_name, pk_id, column, value (JSON text).

    A row lives when its last INSERT is later than its last DELETE, and only
    writes since that INSERT count. Both steps are plain aggregations that
    combine before the shuffle, whatever the number of events per key.
    """
    keyed = log.where(F.col("pk_id").isNotNull())
    life = keyed.groupBy("table_name", "pk_id").agg(
        F.max(F.when(F.col("type") == "INSERT", F.col("seq"))).alias("born"),
        F.max(F.when(F.col("type") == "DELETE", F.col("seq"))).alias("died"),
    ).where("born is not null and (died is null or born > died)").drop("died")
    written = _written_cells(keyed)
    last = written.groupBy("table_name", "pk_id", "column").agg(
        F.max("seq").alias("at"), F.max_by("value", "seq").alias("value")
    )
    return even_join(last, life, ["table_name", "pk_id"]).where("at >= born").select("table_name", "pk_id", "column", "value")


def state_partials(log: DataFrame) -> DataFrame:
    """What operations did to cells and rows: the last write of each cell, and per row, with no column, its last INSERT and DELETE.

    Partials of parts of a log can be merged (C7).
    """
    keyed = log.where(F.col("pk_id").isNotNull())
    life = keyed.groupBy("table_name", "pk_id").agg(
        F.max(F.when(F.col("type") == "INSERT", F.col("seq"))).alias("born"),
        F.max(F.when(F.col("type") == "DELETE", F.col("seq"))).alias("died"),
    ).where("born is not null or died is not null")
    cells = _written_cells(keyed).groupBy("table_name", "pk_id", "column").agg(F.max("seq").alias("at"), F.max_by("value", "seq").alias("value"))
    return cells.unionByName(life, allowMissingColumns=True)


def living_cells(partials: DataFrame) -> DataFrame:
    """The state from merged partials: cells written since the last INSERT of rows that live."""
    life = partials.where("column is null and born is not null and (died is null or born > died)").select("table_name", "pk_id", "born")
    cells = partials.where("column is not null").select("table_name", "pk_id", "column", "at", "value")
    return even_join(cells, life, ["table_name", "pk_id"]).where("at >= born").select("table_name", "pk_id", "column", "value")


def _written(log: DataFrame) -> DataFrame:
    pairs = F.zip_with("columns", "values", lambda c, v: F.struct(c.alias("column"), F.to_json(v).alias("value")))
    return log.withColumn("cells", F.when(F.col("type").isin("INSERT", "UPDATE"), pairs))


def _written_cells(log: DataFrame) -> DataFrame:
    writes = (log if "cells" in log.columns else _written(log)).where(F.col("type").isin("INSERT", "UPDATE"))
    return each(writes, F.col("cells"), "c").select("table_name", "pk_id", "seq", "c.column", "c.value")


def answer_gets(log: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Each SELECT answered from the state at its place in the log.

    Result: seq, table_name, pk_id, column, value (JSON text, null if unset).
    SELECTs of rows that do not live have no result. With ``before``, merged
    ``state_partials`` of what came earlier, ``log`` is what came since.
    """
    # the scans read their input several times; operations are joined and values rendered once
    keyed = materialize(_written(log.where(F.col("pk_id").isNotNull())).select("table_name", "pk_id", "seq", "type", "columns", "cells"))
    marks = keyed.select("table_name", "pk_id", "seq", "type")
    written = _written_cells(keyed)
    if before is not None:
        lives = F.array(
            F.struct(F.col("born").alias("seq"), F.lit("INSERT").alias("type")), F.struct(F.col("died").alias("seq"), F.lit("DELETE").alias("type"))
        )
        marks = marks.unionByName(before.where("column is null").select("table_name", "pk_id", F.inline(lives)).where("seq is not null"))
        written = written.unionByName(
            before.where("column is not null").select("table_name", "pk_id", F.col("at").alias("seq"), "column", "value")
        )
    life = running_scan(
        marks, ["table_name", "pk_id"], "seq",
        {
            "born": Running("max", F.when(F.col("type") == "INSERT", F.col("seq"))),
            "died": Running("max", F.when(F.col("type") == "DELETE", F.col("seq"))),
        },
    ).where("type = 'SELECT' and born is not null and (died is null or born > died)")
    reads = keyed.where(F.col("type") == "SELECT").select(
        "table_name", "pk_id", "seq", F.explode("columns").alias("column"),
        _none("struct<at:bigint,value:string>").alias("w"), F.lit(True).alias("read"),
    )
    writes = written.select(
        "table_name", "pk_id", "seq", "column",
        F.struct(F.col("seq").alias("at"), "value").alias("w"), F.lit(False).alias("read"),
    )
    scanned = running_scan(
        reads.union(writes), ["table_name", "pk_id", "column"], "seq", {"last": Running("last", F.col("w"))}
    ).where("read")
    joined = even_join(scanned, life.select("table_name", "pk_id", "seq", "born"), ["table_name", "pk_id", "seq"])
    return joined.select(
        "seq", "table_name", "pk_id", "column",
        F.when(F.col("last.at") >= F.col("born"), F.col("last.value")).alias("value"),
    )
