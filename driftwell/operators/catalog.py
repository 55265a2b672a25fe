"""Declared relational metadata: columns, primary keys, foreign keys."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ForeignKey:
    table: str
    column: str
    ref_table: str
    ref_column: str


class StoredTables(Mapping):
    """Parquet tables below a folder, opened when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, names: list[str]):
        self.spark, self.folder, self.names = spark, folder, names
        self.opened: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        if name not in self.opened:
            self.opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.opened[name]

    def __contains__(self, name: object) -> bool:
        return name in self.names

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


@dataclass
class Catalog:
    """Tables by name with their keys. The tables themselves stay lazy."""

    tables: Mapping[str, DataFrame]
    primary_keys: dict[str, list[str]] = field(default_factory=dict)
    foreign_keys: list[ForeignKey] = field(default_factory=list)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise ValueError(f"unknown table {name!r}")
        return self.tables[name]

    def columns(self, name: str) -> list[str]:
        return self[name].columns

    def with_table(self, name: str, state: DataFrame) -> Catalog:
        return Catalog(ChainMap({name: state}, self.tables), self.primary_keys, self.foreign_keys)

    def keys_of(self, name: str) -> list[ForeignKey]:
        return [k for k in self.foreign_keys if k.table == name]

    def path(self, start: str, end: str) -> list[tuple[str, str, str, str]] | None:
        """Shortest foreign-key path as (from, to, from column, to column).

        Among shortest paths the one through most junction tables (two or more
        foreign keys) wins, then the one declared first.
        """
        if start == end:
            return []
        links: dict[str, list[tuple[str, str, str]]] = {}
        for k in self.foreign_keys:
            links.setdefault(k.table, []).append((k.ref_table, k.column, k.ref_column))
            links.setdefault(k.ref_table, []).append((k.table, k.ref_column, k.column))
        best = {start: (0, [])}
        reached = {start}
        while best and end not in best:
            following: dict[str, tuple[int, list]] = {}
            for here, (junctions, steps) in best.items():
                for there, own, other in links.get(here, []):
                    if there in reached:
                        continue
                    score = junctions + (len(self.keys_of(there)) >= 2)
                    if there not in following or score > following[there][0]:
                        following[there] = (score, [*steps, (here, there, own, other)])
            reached |= following.keys()
            best = following
        return best[end][1] if end in best else None


def declared_columns(documents: DataFrame, column: str = "value") -> DataFrame:
    """Explode schema documents into one row per declared column.

    A document is ``{table: {column: [type, constraint, …],
    "table@constraints": [...]}}``. Returned: table_name, column_name, data_type,
    is_primary_key, ref_table, ref_column. Composite ``PRIMARY KEY (a, b)``
    constraints count for each of their columns.
    """
    tables = documents.select(
        F.explode(F.from_json(column, "map<string,map<string,array<string>>>")).alias(
            "table_name", "columns"
        )
    ).where(~F.col("table_name").startswith("table@"))
    constraints = F.coalesce(F.col("columns")["table@constraints"], F.array().cast("array<string>"))
    composite = F.flatten(
        F.transform(
            F.filter(constraints, lambda c: c.startswith("PRIMARY KEY")),
            lambda c: F.split(F.regexp_extract(c, r"\(([^)]*)\)", 1), r"\s*,\s*"),
        )
    )
    listed = tables.withColumn("composite", composite).select(
        "table_name", "composite", F.explode("columns").alias("column_name", "declared")
    ).where(~F.col("column_name").startswith("table@"))
    reference = F.get(F.filter("declared", lambda c: c.contains("FK ->")), F.lit(0))
    target = r"FK ->\s*(\w+)\s*\(\s*(\w+)\s*\)"
    return listed.select(
        "table_name",
        "column_name",
        F.get("declared", F.lit(0)).alias("data_type"),
        (
            F.array_contains("declared", "PRIMARY KEY")
            | F.array_contains("composite", F.col("column_name"))
        ).alias("is_primary_key"),
        F.nullif(F.regexp_extract(reference, target, 1), F.lit("")).alias("ref_table"),
        F.nullif(F.regexp_extract(reference, target, 2), F.lit("")).alias("ref_column"),
    )


def declared_exists(columns: DataFrame, table: str, column: str | None = None) -> DataFrame:
    """One row telling whether a table, or a column of it, is declared."""
    wanted: Column = F.col("table_name") == table
    if column is not None:
        wanted = wanted & (F.col("column_name") == column)
    return columns.agg(F.coalesce(F.bool_or(wanted), F.lit(False)).alias("is_declared"))


def broken_references(columns: DataFrame) -> DataFrame:
    """Foreign keys that point at a column no table declares."""
    known = columns.select(
        F.col("table_name").alias("ref_table"), F.col("column_name").alias("ref_column")
    )
    return columns.where(F.col("ref_table").isNotNull()).join(
        known, ["ref_table", "ref_column"], "left_anti"
    )
