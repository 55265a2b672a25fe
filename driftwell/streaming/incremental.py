"""State that grows with a stream: profiles, types, schema, first-seen keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.operators.profiling import described_cells, profile_sums
from driftwell.operators.scan import Running, running_scan
from driftwell.operators.schema import schema_changes
from driftwell.operators.widening import continue_history, type_summary
from driftwell.session import even_join

SUMS = ["total_seen", "present_count", "samples", "chars", "squares"]


def profile_step(previous: DataFrame | None, records: DataFrame, seq: str, payload: str, distinct: bool = False) -> DataFrame:
    """Profile after one more batch (R5). One row per field, whatever was read so far.

    ``distinct`` tells that no two records share a ``seq``, as where the ingest numbered them.
    """
    batch_total = records.agg(F.count(F.lit(1)).alias("n")).scalar()
    cells = described_cells(records.select(seq, payload), seq, payload)
    sums = profile_sums(records, seq, payload, cells, distinct).withColumn("records", batch_total)
    summary = type_summary(cells, ["field"], seq, "value")
    if previous is None:
        typed = continue_history(summary, ["field"], F.lit("UNK"))
        return _with_types(sums, typed).withColumn("alter_count", F.lit(1) + F.col("drifts")).drop("drifts")
    known = previous.select("field", F.col("final_type").alias("known"))
    typed = continue_history(
        summary.join(known, "field", "left"), ["field"], F.coalesce("known", F.lit("UNK"))
    )
    new = _with_types(sums, typed)
    old = previous.select("field", *[F.col(c).alias(f"_{c}") for c in previous.columns if c != "field"])
    both = old.join(new, "field", "full_outer")
    before = previous.agg(F.coalesce(F.max("records"), F.lit(0)).alias("n")).scalar()
    zero = F.lit(0)
    return both.select(
        "field",
        *[(F.coalesce(c, zero) + F.coalesce(f"_{c}", zero)).cast(sums.schema[c].dataType).alias(c) for c in SUMS],
        F.coalesce(before + F.col("at_last"), F.col("_at_last")).alias("at_last"),
        F.coalesce("last_nested", "_last_nested").alias("last_nested"),
        F.coalesce("last_text", "_last_text").alias("last_text"),
        (before + batch_total).alias("records"),
        F.coalesce("final_type", "_final_type").alias("final_type"),
        (F.coalesce("_alter_count", F.lit(1)) + F.coalesce("drifts", zero)).alias("alter_count"),
    )


def _with_types(sums: DataFrame, typed: DataFrame) -> DataFrame:
    drifts = F.size(F.filter("changes", lambda c: ~c["old_type"].isin("UNK", "list<UNK>")))
    t = typed.select("field", "final_type", drifts.alias("drifts"))
    return sums.join(t, "field", "left").withColumns(
        {"final_type": F.coalesce("final_type", F.lit("UNK")), "drifts": F.coalesce("drifts", F.lit(0))}
    )


def merge_moments(
    n1: Column, mean1: Column, m1: Column, n2: Column, mean2: Column, m2: Column
) -> tuple[Column, Column, Column]:
    """Count, mean and squared deviations of two parts together."""
    n = n1 + n2
    shift = mean2 - mean1
    return (
        n,
        F.when(n == 0, 0.0).otherwise(mean1 + shift * n2 / n),
        F.when(n == 0, 0.0).otherwise(m1 + m2 + shift * shift * n1 * n2 / n),
    )


def schema_step(previous: DataFrame | None, current: DataFrame) -> DataFrame:
    """Schema changes a batch brings over the catalog so far."""
    if previous is None:
        previous = current.limit(0)
    return schema_changes(previous, current)


def first_seen_step(previous: DataFrame | None, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """INSERT or UPDATE for the writes of one batch, given the keys seen before.

    ``batch`` holds table_name, pk_id, seq, event; ``previous`` holds
    table_name, pk_id, seen. Result: the batch with ``type``, and the seen flags
    of the keys this batch touched. A key with very many events in the batch is
    scanned in blocks like any other group.
    """
    write = F.col("event").isin("create", "add")
    trace = F.when(write, F.lit(True)).when(F.col("event") == "remove", F.lit(False))
    group = ["table_name", "pk_id"]
    scanned = running_scan(batch, group, "seq", {"_seen": Running("last", trace, inclusive=False)})
    touched = batch.groupBy(*group).agg(F.max_by(trace, F.when(trace.isNotNull(), F.col("seq"))).alias("seen"))
    before = F.lit(False)
    if previous is not None:
        scanned = even_join(scanned, previous.select(*group, F.col("seen").alias("_before")), group, "left")
        before = F.coalesce("_before", F.lit(False))
    kind = (
        F.when(write, F.when(F.coalesce(F.col("_seen"), before), "UPDATE").otherwise("INSERT"))
        .when(F.col("event") == "change", "UPDATE")
        .when(F.col("event") == "remove", "DELETE")
        .when(F.col("event") == "get", "SELECT")
    )
    return scanned.select(*batch.columns, kind.alias("type")), touched.where("seen is not null")


def latest_flags(deltas: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Seen flags from the per-batch deltas; only of a batch's keys when one is given."""
    group = ["table_name", "pk_id"]
    if batch is not None:
        deltas = even_join(deltas, batch.select(*group).distinct(), group, "left_semi")
    return deltas.groupBy(*group).agg(F.max_by("seen", "batch_id").alias("seen"))
