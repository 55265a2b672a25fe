"""Mutations as copy-on-write: each returns the new table state (M1–M7)."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driftwell.operators.catalog import Catalog
from driftwell.operators.query import where_condition


@dataclass
class Mutation:
    """New table state and a one-row frame of counts, both lazy."""

    state: DataFrame
    counts: DataFrame


def _value(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def records_frame(spark: SparkSession, data: list[dict], known: StructType | None = None) -> DataFrame:
    """Records as rows: known fields in their type, others in the type that their values have as JSON."""
    types = {f.name: f.dataType.simpleString() for f in known.fields} if known else {}
    names = list(dict.fromkeys(n for r in data for n in r))
    held, new = [n for n in names if n in types], [n for n in names if n not in types]
    rows = [[r.get(n) for n in held] + [json.dumps({n: r[n] for n in new if n in r})] for r in data]
    frame = spark.createDataFrame(rows, ", ".join([f"`{n}` {types[n]}" for n in held] + ["_new string"]))
    if new:
        found = spark.range(1).select(F.schema_of_json(F.lit(json.dumps([{n: r.get(n) for n in new} for r in data])))).first()[0]
        frame = frame.withColumn("_new", F.from_json("_new", found[len("ARRAY<"):-1]))
    return frame.select(*held, *[F.col("_new")[n].alias(n) for n in new])


def insert(df: DataFrame, data: dict | list | DataFrame | None) -> DataFrame:
    """Append one record, a list of records, or a DataFrame of records (M1).

    Fields that the table lacks become columns of the type their values have;
    lists and objects stay nested. For child records see ``insert_records``.
    """
    if data is None:
        raise ValueError("data must not be null")
    if isinstance(data, dict):
        data = [data]
    if isinstance(data, list):
        if not data:
            return df
        data = records_frame(df.sparkSession, data, df.schema)
    elif not isinstance(data, DataFrame):
        raise TypeError("data must be a record, a list of records or a DataFrame")
    return df.unionByName(data, allowMissingColumns=True)


def insert_records(catalog: Catalog, entity: str, data: dict | list | None) -> dict[str, DataFrame]:
    """Insert records and the child records they carry under names of other tables (M1, M2)."""
    if data is None:
        raise ValueError("data must not be null")
    data = [data] if isinstance(data, dict) else data
    if not data:
        return {entity: catalog[entity]}
    return nested_insert(catalog, entity, records_frame(catalog[entity].sparkSession, data, catalog[entity].schema))


def inserted_count(data: DataFrame) -> DataFrame:
    return data.agg(F.count(F.lit(1)).alias("inserted_count"))


def nested_insert(
    catalog: Catalog, entity: str, records: DataFrame, child_columns: dict[str, str] | None = None
) -> dict[str, DataFrame]:
    """Insert parents and the child records they carry, to any depth (M2).

    Array-of-struct columns whose name is a table become rows of that table and
    inherit the parent's primary key; arrays naming no table are dropped. The
    key goes to the column that references the parent where the catalog has one,
    else to the name ``child_columns`` gives, else to its own.
    """
    states: dict[str, DataFrame] = {}

    def add(table: str, rows: DataFrame) -> None:
        arrays = [f.name for f in rows.schema.fields if f.dataType.simpleString().startswith("array<struct")]
        states[table] = insert(states.get(table, catalog[table]), rows.drop(*arrays))
        for name in arrays:
            if name not in catalog.tables:
                continue
            fields = {f.name for f in rows.schema[name].dataType.elementType.fields}
            links = {k.ref_column: k.column for k in catalog.foreign_keys if (k.table, k.ref_table) == (name, table)}
            into = {k: (child_columns or {}).get(k) or links.get(k, k) for k in catalog.primary_keys.get(table, [])}
            into = {k: c for k, c in into.items() if c not in fields and k in rows.columns}
            add(name, rows.select(*[F.col(k).alias(c) for k, c in into.items()], F.explode(name).alias("_c")).select(*into.values(), "_c.*"))

    add(entity, records)
    return states


def _first_match(df: DataFrame, hit: Column, key: str | None) -> Column:
    """Restrict a condition to the matching row with the smallest key."""
    if key is None:
        raise ValueError("a single-row change needs a key to choose the row by")
    least = df.where(hit).agg(F.min(key).alias("_k"))
    return hit & (F.col(key) == least.scalar())


def update(
    df: DataFrame,
    where: dict | None,
    data: dict | None,
    multi: bool = True,
    upsert: bool = False,
    key: str | None = None,
    document: bool = True,
) -> Mutation:
    """Set fields where the condition holds (M3, M4); optionally insert when none did (M5)."""
    if where is None:
        raise ValueError("where must be given")
    if not data:
        raise ValueError("data must be a non-empty record")
    hit = F.coalesce(where_condition(where, document), F.lit(False))
    if not multi:
        hit = _first_match(df, hit, key)
    marked = df.withColumn("_hit", hit)
    changes = F.lit(False)
    for name, value in data.items():
        now = F.col(name) if name in df.columns else F.lit(None)
        changes = changes | ~now.eqNullSafe(_value(value))
    counts = marked.withColumn("_changed", F.col("_hit") & changes).agg(
        F.count_if("_hit").alias("matched_count"), F.count_if("_changed").alias("modified_count")
    )
    state = marked
    for name, value in data.items():
        if name in df.columns:
            new = F.when(F.col("_hit"), _value(value).cast(df.schema[name].dataType)).otherwise(F.col(name))
        else:
            new = F.when(F.col("_hit"), _value(value))
        state = state.withColumn(name, new)
    state = state.drop("_hit")
    if upsert:
        record = {k: v for k, v in where.items() if not isinstance(v, dict)} | data
        fresh = counts.where(F.col("matched_count") == 0).select(
            *[
                _value(v).cast(state.schema[k].dataType).alias(k) if k in state.columns
                else _value(v).alias(k)
                for k, v in record.items()
            ]
        )
        state = state.unionByName(fresh, allowMissingColumns=True)
        counts = counts.withColumn("upserted_count", (F.col("matched_count") == 0).cast("bigint"))
    return Mutation(state, counts)


def upsert_rows(df: DataFrame, incoming: DataFrame, key: list[str], order: str | None = None) -> DataFrame:
    """Bulk upsert by key: incoming non-key fields replace, new keys are added (M5).

    Of incoming rows with one key the one with the greatest ``order`` counts;
    without an order such rows are an error, as in a merge.
    """
    fields = [c for c in incoming.columns if c not in key and c != order]
    record = F.struct(*fields, F.lit(True).alias("_there"))
    if order:
        chosen = F.max_by(record, order)
    else:
        chosen = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("several incoming rows have one key"))).otherwise(F.first(record))
    incoming = incoming.groupBy(*key).agg(chosen.alias("_r")).select(*key, *[F.col("_r")[c].alias(c) for c in fields])
    joined = df.withColumn("_old", F.lit(True)).alias("o").join(
        incoming.withColumn("_new", F.lit(True)).alias("n"), key, "full_outer"
    )
    columns = []
    for c in df.columns:
        if c in key:
            columns.append(F.col(c))
        elif c in fields:
            columns.append(F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            columns.append(F.col(f"o.{c}"))
    columns += [F.col(f"n.{c}") for c in fields if c not in df.columns]
    return joined.select(*columns)


def delete(df: DataFrame, where: dict | None, multi: bool = True, key: str | None = None, document: bool = True) -> Mutation:
    """Remove the matching rows, or one of them (M6). ``where`` must not be empty."""
    if not where:
        raise ValueError("where must be a non-empty condition")
    hit = F.coalesce(where_condition(where, document), F.lit(False))
    if not multi:
        hit = _first_match(df, hit, key)
    return Mutation(
        df.where(~F.coalesce(hit, F.lit(False))), df.agg(F.count_if(hit).alias("deleted_count"))
    )


def cascade_targets(catalog: Catalog, entity: str, where: dict, document: bool = True) -> dict[str, DataFrame]:
    """The rows a cascade removes, per table: the parents and, one level down, the rows that reference them (M7).

    One null rule holds for both.
    """
    if not where:
        raise ValueError("where must be a non-empty condition")
    gone = catalog[entity].where(F.coalesce(where_condition(where, document), F.lit(False)))
    hits = {entity: gone}
    for table in dict.fromkeys(k.table for k in catalog.foreign_keys if k.ref_table == entity):
        marked = _marked(catalog, table, entity, gone)
        hits[table] = marked.where("_gone").drop("_gone")
    return hits


def _marked(catalog: Catalog, table: str, entity: str, gone: DataFrame) -> DataFrame:
    """Rows of a table with whether any of their references to ``entity`` is to a removed row."""
    rows = catalog[table].withColumn("_gone", F.lit(False))
    for i, k in enumerate(k for k in catalog.foreign_keys if (k.table, k.ref_table) == (table, entity)):
        parents = gone.select(F.col(k.ref_column).alias(f"_p{i}"))
        hit = rows.join(parents, F.col(k.column) == F.col(f"_p{i}"), "left_semi")
        rest = rows.join(parents, F.col(k.column) == F.col(f"_p{i}"), "left_anti")
        rows = hit.withColumn("_gone", F.lit(True)).unionByName(rest)
    return rows


def cascade_delete(catalog: Catalog, entity: str, where: dict, document: bool = True) -> dict[str, DataFrame]:
    """Remove parents and, one level down, the rows that reference them: all changed tables (M7)."""
    states = {entity: delete(catalog[entity], where, document=document).state}
    gone = cascade_targets(catalog, entity, where, document)[entity]
    for k in catalog.foreign_keys:
        if k.ref_table == entity:
            parents = gone.select(F.col(k.ref_column).alias("_p"))
            current = states.get(k.table, catalog[k.table])
            states[k.table] = current.join(parents, F.col(k.column) == F.col("_p"), "left_anti")
    return states
