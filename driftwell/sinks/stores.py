"""Relational and document sinks with schema evolution (K1–K3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.functions.coerce import converted, list_items
from driftwell.functions.payload import elements, field, text
from driftwell.operators.profiling import RELATIONAL, split_payload

# fixed values: from widest to narrowest, with the physical type of each
PHYSICAL = {"str": "string", "float": "double", "int": "bigint", "bool": "boolean", "list": "array<string>"}


def relational_columns(placement: DataFrame, types: DataFrame) -> dict[str, str]:
    """Column → type of the fields placed in the relational store: the schema of the table, read from kept state."""
    chosen = placement.where(F.col("dest") == RELATIONAL).join(types, "field", "left")
    rows = chosen.select("field", F.coalesce("final_type", F.lit("str")).alias("t")).toLocalIterator()
    return {r["field"]: stored_type(r["t"]) for r in sorted(rows)}


def stored_type(resolved: str) -> str:
    """The stored type of a resolved one."""
    return "list" if resolved.startswith("list") else "str" if resolved == "UNK" else resolved


def physical_name(column: str, type_name: str) -> str:
    """Stored name of a column: capitals are marked, so that names that differ in case stay apart."""
    return "".join(f"^{c.lower()}" if c != c.lower() and len(c.lower()) == 1 else "^^" if c == "^" else c for c in column) + f"__{type_name}"


def logical_name(stored: str) -> str:
    out, marked = "", False
    for c in stored:
        if marked:
            out, marked = out + ("^" if c == "^" else c.upper()), False
        elif c == "^":
            marked = True
        else:
            out += c
    return out


def _present(value: Column) -> Column:
    return value.isNotNull() & (F.schema_of_variant(value) != "VOID")


def _typed(payload: str, name: str, type_name: str) -> Column:
    return typed_value(field(F.col(payload), name), type_name)


def typed_value(value: Column, type_name: str) -> Column:
    """A VARIANT value as the physical type of a stored column; null where it does not convert."""
    if type_name == "list":
        return F.transform(list_items(value), lambda x: text(x))
    columns = converted(F.lit(type_name), F.schema_of_variant(value), text(value), elements(value))
    return F.when(_present(value), columns[f"{type_name}_value"])


def with_typed(records: DataFrame, payload: str, columns: dict[str, str]) -> DataFrame:
    """Records with their relational columns under their stored names."""
    return records.withColumns({physical_name(f, t): _typed(payload, f, t) for f, t in columns.items()}) if columns else records


def write_relational(typed: DataFrame, columns: dict[str, str], path: str, table: str, batch_id: int, keys: list[str]) -> None:
    """Append the relational columns of one batch (K1); ``typed`` comes from ``with_typed``.

    The first batch creates the table and later ones may bring new columns. A
    column that is widened gets one more physical column, ``name__type``, so
    that no old file has to be rewritten. The batch owns its directory: writing
    it again replaces it. Rows with no column besides the keys are skipped.
    """
    names = [physical_name(f, t) for f, t in columns.items()]
    any_set = F.lit(False)
    for name in names:
        any_set = any_set | F.col(f"`{name}`").isNotNull()
    typed.select(*keys, *[F.col(f"`{n}`") for n in names]).where(any_set).write.mode("overwrite").parquet(f"{path}/{table}/batch_id={batch_id}")


def read_relational(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The relational table over all batches, each column in its widest type."""
    raw = spark.read.option("mergeSchema", "true").parquet(f"{path}/{table}")
    physical: dict[str, dict[str, str]] = {}
    plain = []
    for name in raw.columns:
        column, _, kind = name.rpartition("__")
        if column and kind in PHYSICAL:
            physical.setdefault(column, {})[kind] = name
        else:
            plain.append(name)
    shown = []
    for column, by_type in physical.items():
        widest = next(k for k in ("list", "str", "float", "int", "bool") if k in by_type)
        parts = []
        for kind, name in by_type.items():
            value = F.col(f"`{name}`")
            if kind != widest and widest == "list":
                value = F.array(value.cast("string"))
                value = F.when(F.col(f"`{name}`").isNotNull(), value)
            elif kind == "bool" and widest in ("int", "float"):
                value = value.cast("int").cast(PHYSICAL[widest])
            else:
                value = value.cast(PHYSICAL[widest])
            parts.append(value)
        shown.append(F.coalesce(*parts).alias(logical_name(column)))
    return raw.select(*[c for c in plain if c != "batch_id"], *shown)


def write_documents(
    typed: DataFrame, payload: str, placement: DataFrame, path: str, collection: str, batch_id: int, keys: list[str],
    columns: dict[str, str] | None = None,
) -> None:
    """Append the document fields of one batch as JSON, nested values whole (K2).

    ``columns`` are those of the relational half, present in ``typed``: a value
    that does not convert to its column's type, such as an integer beyond 64
    bits or a scalar in a column of lists, is kept here, so that the two halves
    together hold every value.
    """
    split = split_payload(typed, placement, payload)
    kept = F.col("document")
    if columns:
        left_out = F.array(*[
            F.struct(F.lit(f).alias("key"), F.when(F.col(f"`{physical_name(f, t)}`").isNull(), field(F.col(payload), f)).alias("value"))
            for f, t in columns.items()
        ])
        extra = F.map_from_entries(F.filter(left_out, lambda x: _present(x["value"])))
        kept = F.coalesce(F.map_concat(kept, extra), extra)
    split.select(*keys, F.to_json(kept).alias("document")).write.mode("overwrite").json(
        f"{path}/{collection}/batch_id={batch_id}"
    )


def read_documents(spark: SparkSession, path: str, collection: str, schema: str) -> DataFrame:
    """Documents of all batches; ``schema`` names the key columns and ``document``."""
    return spark.read.schema(schema).json(f"{path}/{collection}").drop("batch_id")


def flush(
    records: DataFrame, payload: str, placement: DataFrame, types: DataFrame, path: str, batch_id: int,
    keys: list[str], table: str = "root",
) -> None:
    """Write one batch to both stores (K3). Writing the same batch twice changes nothing."""
    columns = relational_columns(placement, types)
    typed = with_typed(records, payload, columns).persist()
    try:
        write_relational(typed, columns, f"{path}/relational", table, batch_id, keys)
        write_documents(typed, payload, placement, f"{path}/documents", table, batch_id, keys, columns)
    finally:
        typed.unpersist()
