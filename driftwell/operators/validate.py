"""Checking query specs against a declared schema, as one batch job (Q19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.session import lookup_join

SPEC = (
    "action string, entity string, fields array<string>, where string, data string, "
    "options struct<nest:boolean, group_by:array<string>, sort:array<string>, limit:int, "
    "upsert:boolean, multi:boolean, cascade:boolean>"
)


def parse_specs(raw: DataFrame, index: str = "query_index", column: str = "raw") -> DataFrame:
    """Query-spec JSON, one spec per row, into columns; ``where``/``data`` stay JSON text."""
    return raw.select(
        F.col(index).alias("query_index"), F.from_json(column, SPEC).alias("s")
    ).select("query_index", "s.*")


def validate_specs(specs: DataFrame, columns: DataFrame) -> DataFrame:
    """One row per error: query_index, error. A spec without rows is valid.

    ``columns`` is the output of ``declared_columns``.
    """
    tables = columns.groupBy(F.col("table_name").alias("entity")).agg(
        F.collect_set("column_name").alias("known"),
        F.array_sort(
            F.collect_set(F.when(F.col("is_primary_key"), F.col("column_name")))
        ).alias("keys"),
    )
    q = lookup_join(specs, tables, ["entity"])
    empty = F.array().cast("array<string>")
    items = F.when(F.ltrim("data").startswith("["), F.from_json("data", "array<string>")).otherwise(F.array("data"))
    # null for an item that is not an object
    records = F.transform(items, lambda x: F.when(F.ltrim(x).startswith("{"), F.from_json(x, "map<string,string>")))
    q = q.withColumns(
        {
            "missing": F.col("known").isNull(),
            "where_keys": F.coalesce(F.json_object_keys("where"), empty),
            "data_empty": F.col("data").isNull() | F.trim("data").isin("", "null", "{}", "[]"),
            "records": records,
        }
    )
    known = F.col("action").isin("add", "get", "change", "remove")
    present = known & ~F.col("missing")

    def flag(condition, message):
        return F.when(condition, F.array(message)).otherwise(empty)

    def each(condition, items, message):
        return F.when(condition, F.transform(items, message)).otherwise(empty)

    def unknown(items):
        return F.filter(items, lambda c: ~F.array_contains("known", c))

    def lacks(place):
        return lambda c: F.concat(F.lit("table '"), F.col("entity"), F.lit("' has no column '"), c, F.lit("' (in "), place, F.lit(")"))

    where_error = lacks(F.lit("where"))
    is_add, is_get = F.col("action") == "add", F.col("action") == "get"
    is_change, is_remove = F.col("action") == "change", F.col("action") == "remove"
    plain_fields = F.filter(F.coalesce("fields", empty), lambda f: (f != "*") & ~f.rlike(r"[.(]"))

    def record_errors(record, at):
        place = F.concat(F.lit("record "), at.cast("string"))
        nested = F.map_filter(record, lambda k, v: F.coalesce(F.ltrim(v).rlike(r"^\[\s*\{"), F.lit(False)))
        named = F.filter(
            F.array_except(F.map_keys(record), F.map_keys(nested)), lambda c: ~c.startswith("__")
        )
        return F.when(record.isNull(), F.array(F.concat(place, F.lit(" is not an object")))).otherwise(F.concat(
            F.transform(unknown(named), lacks(place)),
            F.transform(
                F.array_except("keys", F.map_keys(record)), lambda c: F.concat(place, F.lit(" lacks key column '"), c, F.lit("'"))
            ),
        ))

    # all checks of a spec read one row, so they are one pass over the specs
    errors = F.concat(
        flag(~F.coalesce(known, F.lit(False)), F.concat(F.lit("action '"), F.coalesce("action", F.lit("")), F.lit("' is not known"))),
        flag(known & F.col("missing"), F.concat(F.lit("no table '"), F.coalesce("entity", F.lit("")), F.lit("' is declared"))),
        flag(present & (is_add | is_change) & F.col("data_empty"), F.concat(F.lit("'"), F.col("action"), F.lit("' carries no data"))),
        flag(
            present & (is_change | is_remove) & (F.size("where_keys") == 0),
            F.concat(F.lit("'"), F.col("action"), F.lit("' has no condition")),
        ),
        each(present & is_get, unknown(plain_fields), lacks(F.lit("fields"))),
        each(present & is_get, unknown(F.filter("where_keys", lambda c: ~c.contains("."))), where_error),
        each(present & (is_remove | (is_change & ~F.col("data_empty"))), unknown(F.col("where_keys")), where_error),
        each(
            present & is_change & ~F.col("data_empty"),
            F.coalesce(unknown(F.map_keys(F.get("records", F.lit(0)))), empty), lacks(F.lit("data")),
        ),
        F.when(
            present & is_add & ~F.col("data_empty"), F.flatten(F.transform("records", record_errors))
        ).otherwise(empty),
    )
    return q.select("query_index", F.explode(errors).alias("error"))
