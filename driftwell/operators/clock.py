"""Event time and ingest time (X1, X2), cross-store reassembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.operators.scan import BLOCK_BITS, Running, dense_number, running_scan
from driftwell.session import even_join


def event_time(stamp: Column, now: Column | None = None) -> Column:
    """Event time in epoch seconds; the present when missing or null."""
    if now is None:
        now = F.unix_micros(F.current_timestamp()) / F.lit(1_000_000)
    return F.coalesce(stamp, now)


def ingest_time(
    df: DataFrame, seq: str, micros: str, name: str = "sys_ingested_us", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Strictly increasing ingest time in arrival order.

    Each row gets its arrival clock, or one microsecond more than its
    predecessor when the clock did not move on. With i the arrival number that
    is ``i + max(micros[j] - j for j <= i)``, a running maximum.
    """
    numbered = dense_number(df, "_i", seq, block_bits=block_bits)
    scanned = running_scan(
        numbered, [], seq, {"_top": Running("max", F.col(micros) - F.col("_i"))}, block_bits=block_bits
    )
    return scanned.withColumn(name, F.col("_top") + F.col("_i")).drop("_i", "_top")


def reassemble(relational: DataFrame, documents: DataFrame, key: str = "sys_ingested_at") -> DataFrame:
    """Relational rows with their document and whether it was found."""
    marked = documents.withColumn("_there", F.lit(True))
    return even_join(relational, marked, [key], "left").withColumn(
        "document_found", F.when(F.col("_there"), "YES").otherwise("NO")
    ).drop("_there")


def broken_links(relational: DataFrame, documents: DataFrame, key: str = "sys_ingested_at") -> DataFrame:
    """Relational rows without a document."""
    return even_join(relational, documents.select(key), [key], "left_anti")
