"""From dependencies to a relational schema (I6–I11). All inputs are metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions.payload import fields, is_list
from driftwell.functions.text import pair_name, table_name


def column_owners(attributes: DataFrame) -> DataFrame:
    """One owner per column: the key with most attributes, then the first by name.

    ``attributes`` holds (key, column) as found by entity detection.
    """
    sizes = attributes.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("size"), "key"))
    return attributes.join(sizes, "key").withColumn("_r", rank).where("_r = 1").select("key", "column")


def entity_tables(attributes: DataFrame, keys: list[str]) -> DataFrame:
    """Entity tables: table_name, primary_key, column_name (I7). A key is its table's first column."""
    spark = attributes.sparkSession
    declared = spark.createDataFrame([(k,) for k in keys], "key string")
    everything = declared.union(attributes.select("key")).distinct()
    owned = column_owners(attributes)
    columns = everything.select("key", F.col("key").alias("column")).union(owned).distinct()
    return columns.select(
        table_name(F.col("key")).alias("table_name"), F.col("key").alias("primary_key"),
        F.col("column").alias("column_name"),
    )


def list_owners(records: DataFrame, payload: str, keys: list[str], lists: DataFrame, dependencies: DataFrame) -> DataFrame:
    """For each key that is also a list column, its owner: list_column, owner (I8).

    The owner is the first key by name that has dependencies and shows up as a
    scalar in the same records.
    """
    return owners_of_lists(list_pairs(records, payload, keys), lists, dependencies)


def list_pairs(records: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """Keys that hold a list, with the keys that hold a scalar in the same record: list_column, owner."""
    held = F.map_entries(fields(F.col(payload)))
    return records.select(
        F.explode(F.filter(held, lambda e: e["key"].isin(keys) & is_list(e["value"]))["key"]).alias("list_column"),
        F.filter(held, lambda e: e["key"].isin(keys) & ~is_list(e["value"]))["key"].alias("o"),
    ).select("list_column", F.explode("o").alias("owner")).distinct()


def owners_of_lists(pairs: DataFrame, lists: DataFrame, dependencies: DataFrame) -> DataFrame:
    """The first owner by name, among pairs seen, that has dependencies."""
    able = dependencies.select(F.col("key").alias("owner")).distinct()
    found = lists.select(F.col("column").alias("list_column"))
    return (
        pairs.join(able, "owner", "left_semi")
        .join(found, "list_column", "left_semi")
        .groupBy("list_column")
        .agg(F.min("owner").alias("owner"))
    )


def junction_tables(owners: DataFrame) -> DataFrame:
    """Junction tables: table_name, owner, list_column and the tables they refer to (I8)."""
    return owners.select(
        pair_name(table_name(F.col("owner")), table_name(F.col("list_column"))).alias("table_name"),
        "owner", "list_column",
        table_name(F.col("owner")).alias("owner_table"), table_name(F.col("list_column")).alias("list_table"),
    )


def junction_rows(records: DataFrame, payload: str, owner: str, list_column: str) -> DataFrame:
    """The distinct pairs of one junction table."""
    values = fields(F.col(payload))
    return records.select(
        F.try_variant_get(values[owner], "$", "string").alias(owner),
        F.explode(F.try_variant_get(values[list_column], "$", "array<string>")).alias(list_column),
    ).where(F.col(owner).isNotNull()).distinct()


def entity_rows(state_cells: DataFrame, primary_key: str, columns: list[str]) -> DataFrame:
    """Rows of one entity table from long (pk, column, value) cells of a bounded column list."""
    return state_cells.groupBy(F.col("pk").alias(primary_key)).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns if c != primary_key]
    )


def foreign_keys(tables: DataFrame, inclusions: DataFrame) -> DataFrame:
    """Foreign keys attached to the owning table.

    Columns: table_name, column_name, references_table, references_column.
    """
    targets = tables.select("table_name", "primary_key").distinct().select(
        F.col("table_name").alias("references_table"), F.col("primary_key").alias("references")
    )
    owners = tables.select("table_name", F.col("column_name").alias("column"))
    return (
        inclusions.select("column", "references").distinct()
        .join(owners, "column").join(targets, "references")
        .select("table_name", F.col("column").alias("column_name"), "references_table",
                F.col("references").alias("references_column"))
    )


def schema_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """CREATE for new tables, ALTER_TABLE ADD_COLUMN for new columns of known ones.

    Both inputs hold (table_name, column_name); what is gone is not reported.
    """
    before = previous.select("table_name").distinct()
    created = current.join(before, "table_name", "left_anti").groupBy("table_name").agg(
        F.array_sort(F.collect_set("column_name")).alias("columns")
    ).select(F.lit("CREATE").alias("type"), "table_name", "columns")
    added = (
        current.join(before, "table_name", "left_semi")
        .join(previous, ["table_name", "column_name"], "left_anti")
        .select(F.lit("ALTER_TABLE").alias("type"), "table_name", F.array("column_name").alias("columns"))
    )
    return created.unionByName(added)


def assemble(
    tables: DataFrame, dependencies: DataFrame, foreign: DataFrame, lists: DataFrame, junctions: DataFrame | None = None
) -> DataFrame:
    """The whole schema as one long frame: section, name, item, detail."""
    none = F.lit(None).cast("string")
    parts = tables.select(
        F.lit("tables").alias("section"), F.col("table_name").alias("name"), F.col("column_name").alias("item"),
        F.when(F.col("column_name") == F.col("primary_key"), "PRIMARY KEY").alias("detail"),
    )
    parts = parts.unionAll(dependencies.select(F.lit("functional_dependencies"), "key", "column", none).distinct())
    parts = parts.unionAll(
        foreign.select(F.lit("foreign_keys"), "table_name", "column_name",
                       F.concat("references_table", F.lit("("), "references_column", F.lit(")")))
    )
    parts = parts.unionAll(lists.select(F.lit("many_to_many"), "column", none, none))
    if junctions is not None:
        for column, table in (("owner", "owner_table"), ("list_column", "list_table")):
            parts = parts.unionAll(
                junctions.select(F.lit("junctions"), "table_name", column,
                                 F.concat(table, F.lit("("), column, F.lit(")")))
            )
    return parts
