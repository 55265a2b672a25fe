"""Statement text for operations (C10). Values are VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftwell.functions.coerce import shown_text
from driftwell.functions.payload import once, text


def _quoted(s: Column) -> Column:
    return F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("''")), F.lit("'"))


def _typed(value: Column, show) -> Column:
    """``show(type, text)`` of a value, both taken from it once."""
    return once(F.struct(F.schema_of_variant(value).alias("kind"), text(value).alias("plain")), lambda v: show(v["kind"], v["plain"]))


def sql_literal(value: Column) -> Column:
    """NULL, 1/0, numbers as they are, quoted text, lists and objects as quoted JSON."""
    return _typed(value, lambda kind, plain: (
        F.when(kind.isNull() | (kind == "VOID"), F.lit("NULL"))
        .when(kind == "BOOLEAN", F.when(plain == "true", "1").otherwise("0"))
        .when(kind.rlike("^(STRING|ARRAY|OBJECT)"), _quoted(plain))
        .otherwise(shown_text(kind, plain))
    ))


def document_literal(value: Column) -> Column:
    """null, true/false, numbers, double-quoted text, JSON."""
    return _typed(value, lambda kind, plain: (
        F.when(kind.isNull() | (kind == "VOID"), F.lit("null"))
        .when(kind == "STRING", F.concat(F.lit('"'), F.replace(plain, F.lit('"'), F.lit('\\"')), F.lit('"')))
        .when(kind.rlike("^(BOOLEAN|ARRAY|OBJECT)"), plain)
        .otherwise(shown_text(kind, plain))
    ))


def _assignments(names: Column, values: Column, between: str) -> Column:
    pairs = F.zip_with(names, values, lambda n, v: F.concat(n, F.lit(" = "), sql_literal(v)))
    return F.array_join(pairs, between)


def where_clause(where: Column) -> Column:
    body = _assignments(F.map_keys(where), F.map_values(where), " AND ")
    return F.when(F.size(where) > 0, F.concat(F.lit(" WHERE "), body)).otherwise("")


def create_table(table: Column, columns: Column, primary_key: Column, foreign: Column | None = None) -> Column:
    """CREATE TABLE with the columns in name order."""
    lines = F.transform(
        F.array_sort(columns),
        lambda c: F.concat(c, F.lit(" VARCHAR(255)"), F.when(c == primary_key, " PRIMARY KEY").otherwise("")),
    )
    if foreign is not None:
        lines = F.concat(lines, F.transform(foreign, lambda k: F.concat(
            F.lit(" FOREIGN KEY ("), k["column"], F.lit(") REFERENCES "), k["references_table"],
            F.lit("("), k["references_column"], F.lit(")"))))
    return F.concat(
        F.lit("CREATE TABLE IF NOT EXISTS "), table, F.lit(" (\n"), F.array_join(lines, ",\n"), F.lit("\n);")
    )


def add_column(table: Column, column: Column) -> Column:
    return F.concat(F.lit("ALTER TABLE "), table, F.lit(" ADD COLUMN "), column, F.lit(";"))


def statement(kind: Column, table: Column, columns: Column, values: Column, where: Column) -> Column:
    """One INSERT, UPDATE, DELETE or SELECT."""
    names = F.array_join(columns, ", ")
    literals = F.array_join(F.transform(values, sql_literal), ", ")
    condition = F.coalesce(where_clause(where), F.lit(""))
    return (
        F.when(kind == "INSERT", F.concat(F.lit("INSERT INTO "), table, F.lit(" ("), names, F.lit(") VALUES ("), literals, F.lit(");")))
        .when(kind == "UPDATE", F.concat(F.lit("UPDATE "), table, F.lit(" SET "), _assignments(columns, values, ", "), condition, F.lit(";")))
        .when(kind == "DELETE", F.concat(F.lit("DELETE FROM "), table, condition, F.lit(";")))
        .when(kind == "SELECT", F.concat(F.lit("SELECT "), F.when(F.size(columns) > 0, names).otherwise("*"), F.lit(" FROM "), table, condition, F.lit(";")))
    )


def document_insert(table: Column, columns: Column, values: Column) -> Column:
    """``db.<table>.insertOne({field: value, …});``"""
    parts = F.zip_with(columns, values, lambda n, v: F.concat(n, F.lit(": "), document_literal(v)))
    return F.concat(F.lit("db."), table, F.lit(".insertOne({"), F.array_join(parts, ", "), F.lit("});"))
