"""Helpers the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.session import materialize

# The characters that count as white space in every operator.
WHITESPACE = "\t\n\x0b\x0c\r "
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def id_text(name: str = "doc_id") -> Column:
    """An id as text, for Python workers: pandas would turn nullable integers to floats and lose digits."""
    return F.col(name).cast("bigint").cast("string")


def with_id(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """An id that was carried as text, as a number again."""
    return df.withColumn(name, F.col(name).cast("bigint"))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the documents whose labels are never learned."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 5 == 0


def number_within(rows: DataFrame, groups: list[str], order: list[str], name: str, per_cell: int = 20_000) -> DataFrame:
    """Gapless numbers from 0 in each group, without a group in one task.

    Rows are dealt by hash of ``order`` into cells of about ``per_cell`` rows;
    cells are counted, their starts are sums over the counts before, and rows
    are numbered inside their cell. ``rows`` is read twice, so give a stored table.
    """
    cells = max(1, -(-rows.count() // per_cell))
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    before = F.sum("count").over(Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.groupBy(*groups, "_cell").count().select(*groups, "_cell", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*groups, "_cell").orderBy(*order)) - 1
    return (
        rows.withColumn("_inside", inside)
        .join(starts, [*groups, "_cell"])
        .withColumn(name, (F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop("_cell", "_start", "_inside")
    )


def number_in_order(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Gapless numbers from 0 over all rows in the order given, by range partitions."""
    kept = materialize(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    # one row per partition
    before = F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = kept.groupBy("_part").count().select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (
        kept.withColumn("_inside", inside)
        .join(starts, "_part")
        .withColumn(name, (F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop("_part", "_start", "_inside")
    )
