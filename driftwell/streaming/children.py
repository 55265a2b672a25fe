"""Child tables of nested records from the stream.

Every object of a record is a row of its own table. Row ids go on from a kept
counter per table, so that they are dense over all batches, and a parent's id is
found inside the batch, since a record never leaves it. All tables are written
by one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.functions.payload import elements, fields, strict_json
from driftwell.operators.nesting import ROW_ID, number_nodes, record_nodes
from driftwell.operators.widening import continue_history, type_summary
from driftwell.session import even_join, materialize, spread
from driftwell.sinks import reports, stores

ROWS = (
    f"table_name string, seq bigint, path array<int>, {ROW_ID} bigint, parent_table string, parent_id bigint, "
    "parent_key string, pos int, cells map<string,variant>, children map<string,bigint>"
)
COUNTS = "table_name string, n bigint"
TYPES = "table_name string, field string, final_type string"


@dataclass
class ChildTables:
    """The tables of nested records below ``base``."""

    base: str

    def step(self, spark: SparkSession, records: DataFrame, batch_id: int) -> None:
        """Write the rows of one micro-batch; ``records`` has seq and record_text.

        A batch owns its directories and reads only the counters and types of
        the version before it, so a batch run again gives the same ids.
        """
        nodes = record_nodes(records, "seq", "record_text")
        numbered = materialize(number_nodes(nodes))
        before = self._state(spark, "counts", batch_id - 1, COUNTS)
        own = before.select("table_name", F.col("n").alias("_own"))
        of_parent = before.select(F.col("table_name").alias("parent_table"), F.col("n").alias("_of_parent"))
        shifted = numbered.join(own, "table_name", "left").join(of_parent, "parent_table", "left").withColumns({
            ROW_ID: F.col(ROW_ID) + F.coalesce("_own", F.lit(0)),
            "parent_id": F.col("parent_id") + F.coalesce("_of_parent", F.lit(0)),
        })
        held = shifted.where(F.col("parent_table").isNotNull() & F.col("pos").isNull()).groupBy(
            F.col("parent_table").alias("table_name"), "seq", F.col("parent_path").alias("path")
        ).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("parent_key"), F.col(ROW_ID))))).alias("children"))
        rows = even_join(shifted.withColumn("cells", own_cells("raw")), held, ["table_name", "seq", "path"], "left")
        # a table with most rows is many files, one with few is one
        rows = rows.select(*[c.split()[0] for c in ROWS.split(", ")]).hint("rebalance", "table_name")
        rows.write.mode("overwrite").partitionBy("table_name").parquet(f"{self.base}/rows/batch_id={batch_id}")
        counted = numbered.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
        counts = before.unionByName(counted).groupBy("table_name").agg(F.sum("n").alias("n"))
        reports.save_state(counts, f"{self.base}/counts", batch_id)
        self._keep_types(spark, batch_id)

    def _state(self, spark: SparkSession, name: str, version: int, schema: str) -> DataFrame:
        return reports.load_state(spark, f"{self.base}/{name}", version) if version >= 0 else spark.createDataFrame([], schema)

    def _keep_types(self, spark: SparkSession, batch_id: int) -> None:
        """Types of all columns after this batch: they go on from those before it."""
        group = ["table_name", "field"]
        rows = self.rows(spark, batch_id)
        cells = spread(rows.select("table_name", "seq", "path", "cells"), "seq", "path").select(
            "table_name", "seq", "path", F.explode("cells").alias("field", "value")
        )
        known = self._state(spark, "types", batch_id - 1, TYPES).select(*group, F.col("final_type").alias("known"))
        summary = type_summary(cells, group, "seq", "value", tie=["path"]).join(known, group, "left")
        typed = continue_history(summary, group, F.coalesce("known", F.lit("UNK"))).select(*group, "final_type")
        # columns with nulls only have no type yet
        named = rows.select("table_name", F.explode(F.map_keys("cells")).alias("field"))
        seen = named.distinct().unionByName(known.select(*group)).distinct()
        now = seen.join(typed, group, "left").join(known, group, "left")
        reports.save_state(now.select(*group, F.coalesce("final_type", "known", F.lit("UNK")).alias("final_type")), f"{self.base}/types", batch_id)

    def rows(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        """Rows of all tables, or those of one batch."""
        path = f"{self.base}/rows" if batch_id is None else f"{self.base}/rows/batch_id={batch_id}"
        return spark.read.schema(ROWS).parquet(path)

    def types(self, spark: SparkSession, version: int) -> DataFrame:
        """table_name, field, final_type after a batch."""
        return reports.load_state(spark, f"{self.base}/types", version)

    def read(self, spark: SparkSession, table: str, version: int) -> DataFrame:
        """One table as relational rows: ids, parent, and every column in its type after batch ``version``.

        Column names are those of the records. A column of an object holds its
        child's row id. Only the files of this table are read.
        """
        of_table = self.types(spark, version).where(F.col("table_name") == table)
        columns = {r.field: stores.stored_type(r.final_type) for r in sorted(of_table.toLocalIterator())}
        rows = self.rows(spark).where(F.col("table_name") == table)
        children = sorted(r.key for r in rows.select(F.explode(F.map_keys("children")).alias("key")).distinct().toLocalIterator())
        fixed = [ROW_ID, "parent_table", "parent_id", "parent_key", "pos", "seq"]
        shown = [stores.typed_value(F.try_element_at("cells", F.lit(f)), t).alias(f) for f, t in columns.items() if f not in fixed]
        shown += [F.try_element_at("children", F.lit(k)).alias(k) for k in children if k not in columns and k not in fixed]
        return rows.select(*fixed, *shown)


def own_cells(raw: str) -> Column:
    """The scalars and scalar lists of an object's text by name; what is nested is left out."""
    values = fields(strict_json(F.col(raw)))
    nested = lambda v: F.schema_of_variant(v).startswith("OBJECT") | F.coalesce(
        F.exists(elements(v), lambda x: F.schema_of_variant(x).rlike("^(OBJECT|ARRAY)")), F.lit(False)
    )
    return F.map_filter(values, lambda k, v: ~F.coalesce(nested(v), F.lit(False)))
