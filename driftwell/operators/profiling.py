"""Field profiles and relational-or-document placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.functions.coerce import with_traits
from driftwell.functions.payload import fields, identity, is_list, is_nested, short_identity, text
from driftwell.operators.scan import Running, dense_number, running_scan
from driftwell.operators.widening import CHANGES, continue_history, type_history, type_summary
from driftwell.session import even_join, lookup_join, materialize

# fixed values: thresholds and store names
PRESENCE_FLOOR = 0.80
INSTABILITY_CEILING = 0.05
LENGTH_VARIANCE_CEILING = 2000.0
RELATIONAL, DOCUMENT = "sql", "mongodb"


def record_cells(records: DataFrame, seq: str, payload: str) -> DataFrame:
    """One row per field of each record: seq, field, value, and what profiling reads of it."""
    carried = [c for c in records.columns if c != payload]
    cells = records.select(*carried, F.explode(fields(F.col(payload))).alias("field", "value"))
    kind = F.schema_of_variant("value")
    return cells.withColumns(
        {
            "nested": is_nested(F.col("value")),
            "is_null": kind == "VOID",
            "is_list": is_list(F.col("value")),
            "length": F.when(kind == "STRING", F.length(text(F.col("value")))),
        }
    )


def described_cells(records: DataFrame, seq: str, payload: str) -> DataFrame:
    """What profiling and typing need of each cell, without the value itself.

    The result is stored once: several passes read it, and it is small next to
    the records.
    """
    cells = with_traits(record_cells(records, seq, payload), "value")
    return materialize(
        cells.select(
            *[c for c in records.columns if c != payload],
            "field", "nested", "is_null", "is_list", "length", F.when(~F.col("nested"), F.col("traits")).alias("traits"),
        )
    )


def alter_counts(history: DataFrame, group: list[str]) -> DataFrame:
    """ALTERs per column over the whole stream: its discovery plus its drifts."""
    return history.select(*group, (F.lit(1) + F.size(_drifts(F.col("changes")))).alias("alter_count"))


def _drifts(changes: Column) -> Column:
    return F.filter(changes, lambda c: ~c["old_type"].isin("UNK", "list<UNK>"))


def length_variance(n: Column, total: Column, squares: Column) -> Column:
    """Sample variance from exact integer sums; 0 below two samples."""
    wide = "decimal(38,0)"
    spread = n.cast(wide) * squares.cast(wide) - total.cast(wide) * total.cast(wide)
    return F.when(n < 2, 0.0).otherwise(spread.cast("double") / n / (n - 1))


def profile_fields(
    records: DataFrame, seq: str, payload: str, history: DataFrame | None = None
) -> DataFrame:
    """The whole-table profile, one row per field.

    Distinct values are counted exactly: a null is one value, flat lists are
    seen but never distinct. Each field's distinct values are spread over all
    tasks, so a dominant field does not end up in one.
    """
    cells = record_cells(records, seq, payload)
    total = records.agg(F.count(F.lit(1)).alias("n")).scalar()
    flat = ~F.col("nested")
    hashable = short_identity(F.when(flat & ~F.col("is_list"), identity(F.col("value"))))
    # first per (field, value): after it every group is small or already reduced
    per_value = cells.withColumn("_id", hashable).groupBy("field", "_id").agg(
        F.count_if(flat).alias("seen"),
        F.count_if(flat & ~F.col("is_null")).alias("present"),
        F.count("length").alias("samples"),
        F.sum(F.col("length").cast("bigint")).alias("chars"),
        F.sum((F.col("length").cast("bigint") * F.col("length")).cast("decimal(38,0)")).alias("squares"),
    )
    per_field = per_value.groupBy("field").agg(
        F.sum("seen").alias("total_seen"),
        F.sum("present").alias("present_count"),
        F.count("_id").alias("unique_count"),
        F.sum("samples").alias("samples"),
        F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"),
        F.coalesce(F.sum("squares"), F.lit(0)).alias("squares"),
    ).where(F.col("total_seen") > 0)
    if history is None:
        history = type_history(described_cells(records.select(seq, payload), seq, payload), ["field"], seq, "value")
    out = per_field.join(alter_counts(history, ["field"]), "field", "left")
    return finish_profile(out.withColumn("total_records", total))


def finish_profile(sums: DataFrame) -> DataFrame:
    """Ratios and flags from per-field counts and sums."""
    variance = length_variance(F.col("samples"), F.col("chars"), F.col("squares"))
    seen = F.col("total_seen")
    return (
        sums.withColumns(
            {
                "alter_count": F.coalesce("alter_count", F.lit(1)),
                "presence_ratio": F.col("present_count") / F.col("total_records"),
                "cardinality_ratio": F.col("unique_count") / seen,
                "is_unique": F.col("unique_count") == seen,
                "_variance": variance,
            }
        )
        .withColumns(
            {
                "alter_ratio": F.col("alter_count") / seen,
                "is_unstable": F.col("alter_count") / seen > INSTABILITY_CEILING,
                "mean_length": F.round(
                    F.when(F.col("samples") > 0, F.col("chars") / F.col("samples")).otherwise(0.0), 2
                ),
                "variance": F.round("_variance", 2),
                "std_dev": F.round(F.sqrt("_variance"), 2),
                "is_high_variance": F.col("_variance") > LENGTH_VARIANCE_CEILING,
            }
        )
        .drop("chars", "squares", "_variance")
    )


def approx_cardinality(records: DataFrame, seq: str, payload: str, rsd: float = 0.02) -> DataFrame:
    """Estimated distinct values per field, in constant memory (P3, large-scale form)."""
    cells = record_cells(records, seq, payload).where(~F.col("nested"))
    return cells.groupBy("field").agg(
        F.count(F.lit(1)).alias("total_seen"),
        F.approx_count_distinct(
            F.when(~F.col("is_list"), identity(F.col("value"))), rsd
        ).alias("unique_estimate"),
    )


def placement_replay(
    records: DataFrame, seq: str, payload: str, history: DataFrame | None = None, carried: DataFrame | None = None
) -> DataFrame:
    """The store each field of each record goes to, from the state up to that record.

    Columns: field, seq, dest, and the running figures it rests on. With
    ``carried``, a profile kept of the records before these (one row per field),
    the figures go on from it.
    """
    slim = record_numbers(records, seq)
    cells = described_cells(records.select(seq, payload), seq, payload)
    flat = ~F.col("nested")
    if history is None and carried is None:
        history = type_history(cells, ["field"], seq, "value")
    elif history is None:
        known = carried.select("field", F.col("final_type").alias("known"))
        summary = type_summary(cells, ["field"], seq, "value").join(known, "field", "left")
        history = continue_history(summary, ["field"], F.coalesce("known", F.lit("UNK")))
    length = F.col("length").cast("bigint")
    scanned = running_scan(
        even_join(cells.drop("traits"), slim, [seq]),
        ["field"],
        seq,
        {
            "seen": Running("count", F.when(flat, 1)),
            "present": Running("count", F.when(flat & ~F.col("is_null"), 1)),
            "samples": Running("count", F.col("length")),
            "chars": Running("sum", length),
            "squares": Running("sum", (length * length).cast("decimal(38,0)")),
        },
    )
    rows = lookup_join(scanned, history, ["field"])
    alters, before = F.lit(1), F.lit(0)
    if carried is not None:
        sums = {"total_seen": "seen", "present_count": "present", "samples": "samples", "chars": "chars", "squares": "squares"}
        kept = carried.select("field", F.col("alter_count").alias("_alters"), *[F.col(c).alias(f"_{n}") for c, n in sums.items()])
        rows = lookup_join(rows, kept, ["field"])
        rows = rows.withColumns({n: F.coalesce(F.col(n) + F.coalesce(f"_{n}", F.lit(0)), f"_{n}") for n in sums.values()})
        alters = F.coalesce("_alters", alters)
        before = carried.agg(F.coalesce(F.max("records"), F.lit(0)).alias("n")).scalar()
    reached = F.filter(
        _drifts(F.coalesce("changes", F.array().cast(CHANGES))), lambda c: c["seq"] <= F.col(seq)
    )
    rows = rows.withColumns(
        {
            "alters": alters + F.size(reached),
            "variance": length_variance(F.col("samples"), F.col("chars"), F.col("squares")),
            "presence": F.col("present") / (F.col("_record_no") + before),
        }
    )
    dest = (
        F.when(F.col("nested"), DOCUMENT)
        .when(F.col("alters") / F.col("seen") > INSTABILITY_CEILING, DOCUMENT)
        .when(F.col("length").isNotNull() & (F.col("variance") > LENGTH_VARIANCE_CEILING), DOCUMENT)
        .when(F.col("presence") >= PRESENCE_FLOOR, RELATIONAL)
        .otherwise(DOCUMENT)
    )
    return rows.select("field", seq, dest.alias("dest"), "seen", "present", "alters", "variance", "presence")


def last_decisions(replay: DataFrame, seq: str) -> DataFrame:
    """The replayed decision at each field's last occurrence."""
    return replay.groupBy("field").agg(F.max_by("dest", seq).alias("dest"))


def record_numbers(records: DataFrame, seq: str) -> DataFrame:
    """The number of each record in ``seq`` order."""
    return dense_number(records.select(seq), "_record_no", seq)


def profile_sums(
    records: DataFrame, seq: str, payload: str, cells: DataFrame | None = None, distinct: bool = False
) -> DataFrame:
    """Mergeable per-field sums of a batch of records.

    ``at_last`` counts the records up to the field's last occurrence; the
    record counts of batches add up, and so do all other columns. With ``distinct``,
    no two records share a ``seq`` and none is null: then only the last cell of
    each field is looked up among the record numbers, instead of every cell.
    """
    if cells is None:
        cells = described_cells(records.select(seq, payload), seq, payload)
    if distinct:
        sums = materialize(_cell_sums(cells, seq, F.max(seq).alias("_last")))
        numbers = lookup_join(record_numbers(records, seq), sums.select(F.col("_last").alias(seq)).distinct(), [seq], "inner")
        return sums.join(numbers.select(F.col(seq).alias("_last"), F.col("_record_no").alias("at_last")), "_last").drop("_last")
    return _cell_sums(even_join(cells, record_numbers(records, seq), [seq]), seq, F.max("_record_no").alias("at_last"))


def _cell_sums(cells: DataFrame, seq: str, last: Column) -> DataFrame:
    flat = ~F.col("nested")
    length = F.col("length").cast("bigint")
    return cells.groupBy("field").agg(
        F.count_if(flat).alias("total_seen"),
        F.count_if(flat & ~F.col("is_null")).alias("present_count"),
        F.count("length").alias("samples"),
        F.coalesce(F.sum(length), F.lit(0)).alias("chars"),
        F.coalesce(F.sum((length * length).cast("decimal(38,0)")), F.lit(0)).alias("squares"),
        last,
        F.max_by("nested", seq).alias("last_nested"),
        F.max_by(F.col("length").isNotNull(), seq).alias("last_text"),
    )


def final_placement(sums: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """The same decisions as ``last_decisions`` from sums alone, without a replay.

    ``sums`` either has an ``alter_count`` already or ``history`` gives it.
    """
    rows = sums if history is None else sums.join(alter_counts(history, ["field"]), "field", "left")
    alters = F.coalesce("alter_count", F.lit(1))
    variance = length_variance(F.col("samples"), F.col("chars"), F.col("squares"))
    dest = (
        F.when(F.col("last_nested"), DOCUMENT)
        .when(alters / F.col("total_seen") > INSTABILITY_CEILING, DOCUMENT)
        .when(F.col("last_text") & (variance > LENGTH_VARIANCE_CEILING), DOCUMENT)
        .when(F.col("present_count") / F.col("at_last") >= PRESENCE_FLOOR, RELATIONAL)
        .otherwise(DOCUMENT)
    )
    return rows.select("field", dest.alias("dest"))


def placement_of(names: DataFrame, placement: DataFrame) -> DataFrame:
    """Look fields up; one never seen goes to the document store."""
    return names.join(placement, "field", "left").withColumn("dest", F.coalesce("dest", F.lit(DOCUMENT)))


def reclassified(replay: DataFrame, seq: str, carried: DataFrame | None = None) -> DataFrame:
    """Changes of store: field, seq, old_dest, new_dest (P9); ``carried`` has the dest each field had before."""
    scanned = running_scan(
        replay.select("field", seq, "dest"), ["field"], seq,
        {"old_dest": Running("last", F.col("dest"), inclusive=False)},
    )
    if carried is not None:
        scanned = lookup_join(scanned, carried.select("field", F.col("dest").alias("_was")), ["field"])
        scanned = scanned.withColumn("old_dest", F.coalesce("old_dest", "_was"))
    return scanned.where(F.col("old_dest") != F.col("dest")).select(
        "field", seq, "old_dest", F.col("dest").alias("new_dest")
    )


def split_by_store(rows: DataFrame, placement: dict[str, str], keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Columns of a typed table by store; both halves keep ``keep``."""
    store = lambda c: placement.get(c, DOCUMENT)
    columns = [c for c in rows.columns if c not in keep]
    return (
        rows.select(*keep, *[c for c in columns if store(c) == RELATIONAL]),
        rows.select(*keep, *[c for c in columns if store(c) == DOCUMENT]),
    )


def split_payload(records: DataFrame, placement: DataFrame, payload: str) -> DataFrame:
    """Open payloads split into ``relational`` and ``document`` maps.

    The placement is one row, so a record of any width is split where it stands.
    """
    stores = placement.where(F.col("dest") == RELATIONAL).agg(
        F.coalesce(F.collect_set("field"), F.array().cast("array<string>")).alias("s")
    )
    split = records.withColumns({"_names": stores.scalar(), "_values": fields(F.col(payload))})
    goes = lambda k, v: F.array_contains("_names", k) & ~F.coalesce(is_nested(v), F.lit(False))
    return split.withColumns(
        {
            "relational": F.map_filter("_values", goes),
            "document": F.map_filter("_values", lambda k, v: ~goes(k, v)),
        }
    ).drop("_names", "_values")
