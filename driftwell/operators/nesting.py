"""Nested records to related tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions.coerce import with_traits
from driftwell.functions.payload import each, elements, fields, once, strict_json
from driftwell.operators.scan import dense_number
from driftwell.operators.widening import drift_log, type_history
from driftwell.session import even_join, materialize, spread

# fixed value: name of the id column
ROW_ID = "table_autogen_id"
# after every position in a path
LAST = (1 << 31) - 1


def record_nodes(records: DataFrame, seq: str, raw: str, root: str = "root") -> DataFrame:
    """Every object inside every record, one row each, level by level.

    Columns: table_name, seq, path (positions from the root, so that paths sort
    in document order), parent_table, parent_path, parent_key, pos (place in
    the parent's array, null for a plain object) and ``raw`` JSON text. Lists of
    lists are flattened; their scalars belong to no table.
    """
    frontier = records.select(
        F.lit(root).alias("table_name"),
        F.col(seq).cast("bigint").alias("seq"),
        F.array().cast("array<int>").alias("path"),
        F.lit(None).cast("string").alias("parent_table"),
        F.lit(None).cast("array<int>").alias("parent_path"),
        F.lit(None).cast("string").alias("parent_key"),
        F.lit(None).cast("int").alias("pos"),
        F.lit("OBJECT").alias("_kind"),
        F.col(raw).alias("raw"),
    )
    levels = []
    while True:
        levels.append(frontier.where(F.col("_kind") == "OBJECT").drop("_kind"))
        frontier = materialize(_children(spread(frontier, "seq", "path")))
        if frontier.isEmpty():
            return reduce(DataFrame.unionByName, levels)


def _children(frontier: DataFrame) -> DataFrame:
    """Objects and lists held by the objects and lists of one level."""
    is_object = F.col("_kind") == "OBJECT"

    def nested_kind(shown: Column, value: Column) -> Column:
        # the text rules out most scalars; a string may still look like an object
        kind = F.regexp_extract(F.schema_of_variant(value), "^(OBJECT|ARRAY)", 1)
        return F.when(F.substring(shown, 1, 1).isin("{", "["), kind).otherwise("")

    entries = F.map_entries(F.from_json("raw", "map<string,string>"))
    items = F.from_json("raw", "array<string>")
    in_object = once(
        fields(strict_json(F.col("raw"))),
        lambda values: F.transform(
            entries,
            lambda e, i: F.struct(
                i.alias("at"), e["key"].alias("key"), e["value"].alias("raw"),
                nested_kind(e["value"], F.try_element_at(values, e["key"])).alias("kind"),
            ),
        ),
    )
    in_list = once(
        elements(strict_json(F.col("raw"))),
        lambda values: F.transform(
            items,
            lambda x, i: F.struct(
                i.alias("at"), F.lit(None).cast("string").alias("key"), x.alias("raw"),
                nested_kind(x, F.get(values, i)).alias("kind"),
            ),
        ),
    )
    held = F.when(is_object, in_object).otherwise(in_list)
    # most objects are leaves, and their text shows it
    parsed = frontier.where(F.substr(F.col("raw"), F.lit(2)).rlike(r"[{\[]"))
    inside = parsed.select(
        "table_name", "seq", "path", "parent_table", "parent_path", "parent_key", "pos", is_object.alias("_obj"),
        F.filter(held, lambda h: h["kind"] != "").alias("held"),
    )
    below = each(inside, F.col("held"), "h")
    return below.select(
        F.when(F.col("_obj"), F.concat_ws("_", "table_name", "h.key")).otherwise(F.col("table_name")).alias("table_name"),
        "seq",
        F.array_append("path", F.col("h.at")).alias("path"),
        F.when(F.col("_obj"), F.col("table_name")).otherwise(F.col("parent_table")).alias("parent_table"),
        F.when(F.col("_obj"), F.col("path")).otherwise(F.col("parent_path")).alias("parent_path"),
        F.when(F.col("_obj"), F.col("h.key")).otherwise(F.col("parent_key")).alias("parent_key"),
        F.when(~F.col("_obj"), F.col("h.at")).alias("pos"),
        F.col("h.kind").alias("_kind"),
        F.col("h.raw").alias("raw"),
    )


def number_nodes(nodes: DataFrame) -> DataFrame:
    """Dense row ids per table in arrival order, and the parent's id."""
    numbered = dense_number(nodes, ROW_ID, "seq", ["table_name"], ["path"])
    parents = numbered.select(
        F.col("table_name").alias("parent_table"), "seq", F.col("path").alias("parent_path"),
        F.col(ROW_ID).alias("parent_id"),
    )
    return even_join(numbered, parents, ["parent_table", "seq", "parent_path"], "left")


def node_cells(nodes: DataFrame) -> DataFrame:
    """Column values of each row: scalars and scalar lists.

    Columns: the node's, plus at (place in the record), field, value (VARIANT).
    Object values stand for a child row; they are kept with a null value and
    ``is_child`` set. Lists that hold objects or lists are no columns.
    """
    cells = once(
        fields(strict_json(F.col("raw"))),
        lambda values: F.transform(
            F.json_object_keys("raw"),
            lambda k, i: F.struct(i.alias("at"), k.alias("field"), F.try_element_at(values, k).alias("value")),
        ),
    )
    kept = [c for c in nodes.columns if c != "raw"]
    kind = F.schema_of_variant("value")
    holds = F.exists(elements(F.col("value")), lambda x: F.schema_of_variant(x).rlike("^(OBJECT|ARRAY)"))
    described = spread(nodes, "seq", "path").select(*kept, cells.alias("cells"))
    flat = each(described, F.col("cells"), "c").select(*kept, "c.at", "c.field", "c.value")
    return flat.where(~F.coalesce(holds, F.lit(False))).withColumn(
        "is_child", F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    )


def insert_operations(numbered: DataFrame) -> DataFrame:
    """One INSERT per row with columns and values in record order.

    Values are JSON texts; an object column holds its child's row id.
    ``op_order`` sorts children before their parent within a record.
    """
    ids = numbered.where(F.col("parent_table").isNotNull() & F.col("pos").isNull()).select(
        F.col("parent_table").alias("table_name"), "seq", F.col("parent_path").alias("path"),
        F.col("parent_key").alias("field"), F.col(ROW_ID).alias("child_id"),
    )
    cells = even_join(node_cells(numbered), ids, ["table_name", "seq", "path", "field"], "left")
    shown = F.when(F.col("is_child"), F.col("child_id").cast("string")).otherwise(F.to_json("value"))
    per_row = cells.groupBy("table_name", "seq", "path", ROW_ID).agg(
        F.array_sort(F.collect_list(F.struct("at", "field", shown.alias("shown")))).alias("c")
    )
    rows = even_join(
        numbered.select("table_name", "seq", "path", ROW_ID), per_row, ["table_name", "seq", "path", ROW_ID], "left"
    )
    empty = F.array().cast("array<string>")
    return rows.select(
        F.lit("INSERT").alias("type"), "table_name", "seq",
        F.array_append("path", F.lit(LAST)).alias("op_order"), ROW_ID,
        F.coalesce(F.col("c.field"), empty).alias("columns"),
        F.coalesce(F.col("c.shown"), empty).alias("values"),
    )


def discovered_columns(nodes: DataFrame) -> DataFrame:
    """First sight of each column and child table.

    Columns: type (ALTER or CREATE), table_name, column_name, seq, new_type.
    The type of a column is that of its first value, ``UNK`` when that is null.
    """
    cells = node_cells(nodes).where(~F.col("is_child"))
    typed = with_traits(cells, "value")
    first = F.struct("seq", "path")
    columns = typed.groupBy("table_name", F.col("field").alias("column_name")).agg(
        F.min("seq").alias("seq"), F.min_by(F.coalesce("traits.first", F.lit("UNK")), first).alias("new_type")
    ).select(F.lit("ALTER").alias("type"), "table_name", "column_name", "seq", "new_type")
    tables = nodes.where(F.col("parent_table").isNotNull()).groupBy("table_name").agg(F.min("seq").alias("seq"))
    created = tables.select(
        F.lit("CREATE").alias("type"), "table_name", F.lit(None).cast("string").alias("column_name"), "seq",
        F.lit(None).cast("string").alias("new_type"),
    )
    return columns.unionByName(created)


def registry(nodes: DataFrame) -> DataFrame:
    """Catalog of all tables: table_name, column_name, type.

    Each table has its row id; object columns are listed with the child table
    as their type.
    """
    cells = node_cells(nodes)
    plain = cells.where(~F.col("is_child"))
    history = type_history(plain, ["table_name", "field"], "seq", "value", tie=["path"])
    named = plain.select("table_name", "field").distinct()
    typed = named.join(history, ["table_name", "field"], "left").select(
        "table_name", F.col("field").alias("column_name"), F.coalesce("final_type", F.lit("UNK")).alias("type")
    )
    ids = nodes.select("table_name").distinct().select(
        "table_name", F.lit(ROW_ID).alias("column_name"), F.lit("int auto").alias("type")
    )
    children = nodes.where(F.col("parent_table").isNotNull()).select(
        F.col("parent_table").alias("table_name"), F.col("parent_key").alias("column_name"),
        F.concat(F.lit("table "), F.col("table_name")).alias("type"),
    ).distinct()
    return typed.unionByName(ids).unionByName(children)


def alter_log(nodes: DataFrame) -> DataFrame:
    """All ALTER events of nested records: discoveries and drifts."""
    cells = node_cells(nodes).where(~F.col("is_child"))
    history = type_history(cells, ["table_name", "field"], "seq", "value", tie=["path"])
    drifts = drift_log(history, ["table_name", "field"]).select(
        "table_name", F.col("field").alias("column_name"), "seq", "old_type", "new_type"
    )
    found = discovered_columns(nodes).where(F.col("type") == "ALTER").select(
        "table_name", "column_name", "seq", F.lit(None).cast("string").alias("old_type"), "new_type"
    )
    return found.unionByName(drifts)
