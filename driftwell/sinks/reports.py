"""Log, report, schema and state sinks (K4–K8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.operators.oplog import counts_by_type
from driftwell.session import materialize, owned_tables


def write_operation_log(numbered: DataFrame, path: str, global_key: str = "username", batch_id: int | None = None) -> None:
    """Append operations as JSON lines in ``op_seq`` order (K4).

    With a batch id the batch owns its directory: writing it again replaces it.
    """
    line = F.to_json(
        F.struct(
            "type", "table_name", "columns", "values", "where", "sql", F.col("actor").alias(global_key), "op_seq"
        )
    )
    # sorting reads its input twice, first to find the ranges: the lines are made once
    with owned_tables(numbered.sparkSession):
        ordered = materialize(numbered.select("op_seq", line.alias("value"))).orderBy("op_seq").select("value")
        if batch_id is None:
            ordered.write.mode("append").text(path)
        else:
            ordered.write.mode("overwrite").text(f"{path}/batch_id={batch_id}")


def operation_report(numbered: DataFrame) -> DataFrame:
    """Numbered statements: query_index, type, entity, sql, description (K5)."""
    kind = F.lower("type")
    return numbered.select(
        F.col("op_seq").alias("query_index"), kind.alias("type"), F.col("table_name").alias("entity"), "sql",
        F.concat(F.initcap(kind), F.lit(" on "), F.col("table_name")).alias("description"),
    )


def report_metadata(numbered: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Counts by type, and the number of errors, as (name, n) rows (K5)."""
    counts = counts_by_type(numbered).select(F.col("type").alias("name"), "n")
    total = numbered.agg(F.lit("total_queries").alias("name"), F.count(F.lit(1)).alias("n"))
    out = counts.union(total)
    if errors is not None:
        out = out.union(errors.agg(F.lit("errors").alias("name"), F.count(F.lit(1)).alias("n")))
    return out


def write_report(numbered: DataFrame, path: str, errors: DataFrame | None = None) -> None:
    """Statements and metadata, each a JSON directory."""
    operation_report(numbered).orderBy("query_index").write.mode("overwrite").json(f"{path}/generated_queries")
    report_metadata(numbered, errors).write.mode("overwrite").json(f"{path}/metadata")


def schema_documents(tables: DataFrame, foreign: DataFrame) -> DataFrame:
    """One document per table: primary_key, columns, foreign_keys (K6)."""
    columns = tables.groupBy("table_name", "primary_key").agg(F.array_sort(F.collect_set("column_name")).alias("columns"))
    keys = foreign.groupBy("table_name").agg(
        F.array_sort(F.collect_set(F.struct("column_name", "references_table", "references_column"))).alias("foreign_keys")
    )
    none = F.array().cast("array<struct<column_name:string,references_table:string,references_column:string>>")
    return columns.join(keys, "table_name", "left").withColumn("foreign_keys", F.coalesce("foreign_keys", none))


def write_schema(tables: DataFrame, foreign: DataFrame, path: str) -> None:
    schema_documents(tables, foreign).write.mode("overwrite").json(path)


def execution_summary(executed: DataFrame) -> DataFrame:
    """Per entity: statements run, succeeded, failed, rows affected (K7).

    ``executed`` has index, type, entity, status, rows_affected.
    """
    ok = F.col("status") == "success"
    return executed.groupBy("entity").agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
        F.count_if(F.col("type") == "select").alias("selects"),
        F.coalesce(F.sum(F.when(ok, F.col("rows_affected"))), F.lit(0)).alias("rows_affected"),
    )


def write_results_by_entity(executed: DataFrame, path: str) -> None:
    """Results as JSON lines, a directory per entity and kind (K7).

    An entity may have any number of results, so they are files, not one array.
    """
    kind = F.when(F.col("type") == "select", "select_results").otherwise("other_operations")
    executed.withColumn("kind", kind).write.mode("overwrite").partitionBy("entity", "kind").json(path)


def save_state(df: DataFrame, path: str, version: int) -> None:
    """Keep a registry or profile table across sessions (K8). A version is written whole."""
    df.write.mode("overwrite").parquet(f"{path}/version={version}")


def load_state(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")
