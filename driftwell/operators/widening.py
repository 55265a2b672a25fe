"""Type resolution of drifting columns over whole tables.

Widening is an order-dependent fold: which type a column has depends on which
values came first. A fold step is a function from type to type, and such
functions compose, so the fold is run as a tree. Blocks of consecutive rows are
summarised for every possible incoming type, block summaries are composed into
super-block summaries, and those into the history of the column. No task sees
more than one block of one column, however long the column is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.functions.coerce import converted, with_traits
from driftwell.functions.payload import once
from driftwell.functions.widening import TYPES, next_type
from driftwell.session import lookup_join

FOLD_BITS = 14
CHANGES = "array<struct<seq:bigint,old_type:string,new_type:string>>"


def _compose(items: Column, start: Column) -> Column:
    """Run block summaries one after the other from a starting type."""
    begin = F.struct(start.alias("type"), F.array().cast(CHANGES).alias("changes"))
    return F.aggregate(
        items,
        begin,
        lambda acc, b: once(
            F.element_at(b["summary"], acc["type"]),
            lambda s: F.struct(
                s["type"].alias("type"), F.concat(acc["changes"], s["changes"]).alias("changes")
            ),
        ),
    )


def _for_every_type(run) -> Column:
    types = F.array(*[F.lit(t) for t in TYPES])
    return F.map_from_arrays(types, F.transform(types, run))


def type_summary(
    cells: DataFrame,
    group: list[str],
    seq: str,
    value: str,
    fold_bits: int = FOLD_BITS,
    tie: list[str] | None = None,
) -> DataFrame:
    """What the rows of each column do to every possible incoming type.

    ``cells`` holds one VARIANT value per (group, seq); ``tie`` orders values
    that share a seq. Cells that have ``traits`` already are not read again.
    ``summary`` maps an incoming type to (type, changes).
    """
    tie = tie or []
    described = cells if "traits" in cells.columns else with_traits(cells, value)
    typed = described.where(F.col("traits").isNotNull()).select(
        *group, *tie, F.col(seq).cast("bigint").alias("_seq"), "traits",
        F.shiftright(F.col(seq).cast("bigint"), fold_bits).alias("_blk"),
    )
    # the same traits twice in a row never change the type a second time
    earlier = F.lag("traits").over(Window.partitionBy(*group, "_blk").orderBy("_seq", *tie))
    runs = typed.withColumn("_earlier", earlier).where(~F.col("traits").eqNullSafe(F.col("_earlier")))

    def fold_rows(start: Column) -> Column:
        begin = F.struct(start.alias("type"), F.array().cast(CHANGES).alias("changes"))
        def step(acc: Column, row: Column) -> Column:
            return once(
                next_type(acc["type"], row["traits"]),
                lambda new: F.struct(
                    new.alias("type"),
                    F.when(new == acc["type"], acc["changes"])
                    .otherwise(
                        F.array_append(
                            acc["changes"],
                            F.struct(
                                row["_seq"].alias("seq"),
                                acc["type"].alias("old_type"),
                                new.alias("new_type"),
                            ),
                        )
                    )
                    .alias("changes"),
                ),
            )

        return F.aggregate("rows", begin, step)

    level = (
        runs.groupBy(*group, "_blk")
        .agg(F.array_sort(F.collect_list(F.struct("_seq", *tie, "traits"))).alias("rows"))
        .select(*group, "_blk", _for_every_type(fold_rows).alias("summary"))
    )
    for _ in range(2):
        level = (
            level.groupBy(*group, F.shiftright("_blk", fold_bits).alias("_up"))
            .agg(F.array_sort(F.collect_list(F.struct("_blk", "summary")), _by_block).alias("blocks"))
            .select(
                *group,
                F.col("_up").alias("_blk"),
                _for_every_type(lambda start: _compose(F.col("blocks"), start)).alias("summary"),
            )
        )
    return (
        level.groupBy(*group)
        .agg(F.array_sort(F.collect_list(F.struct("_blk", "summary")), _by_block).alias("blocks"))
        .select(
            *group, _for_every_type(lambda start: _compose(F.col("blocks"), start)).alias("summary")
        )
    )


def type_history(
    cells: DataFrame,
    group: list[str],
    seq: str,
    value: str,
    fold_bits: int = FOLD_BITS,
    tie: list[str] | None = None,
) -> DataFrame:
    """Final type and all type changes of each column.

    Result: the group columns, ``final_type`` and ``changes``, an array of
    (seq, old_type, new_type) that starts with the first typing. Columns with
    nulls only are absent: their type stays unknown.
    """
    whole = type_summary(cells, group, seq, value, fold_bits, tie)
    return continue_history(whole, group, F.lit("UNK"))


def continue_history(summary: DataFrame, group: list[str], known_type: Column) -> DataFrame:
    """History of the summarised rows for columns that come in with ``known_type``."""
    end = F.element_at(F.col("summary"), known_type)
    return summary.withColumn("_end", end).select(
        *group, F.col("_end.type").alias("final_type"), F.col("_end.changes").alias("changes")
    )


def _by_block(a: Column, b: Column) -> Column:
    return F.when(a["_blk"] < b["_blk"], -1).when(a["_blk"] > b["_blk"], 1).otherwise(0)


def drift_log(history: DataFrame, group: list[str]) -> DataFrame:
    """One ALTER row per widening: group, seq, old_type, new_type.

    The first typing of a column is its discovery, not a drift, and neither is
    the first typing of an empty list's elements.
    """
    return (
        history.select(*group, F.explode("changes").alias("_change"))
        .select(*group, "_change.seq", "_change.old_type", "_change.new_type")
        .where(~F.col("old_type").isin("UNK", "list<UNK>"))
    )


def type_at(changes: Column, seq: Column) -> Column:
    """The type a column has right after row ``seq``."""
    reached = F.filter(changes, lambda c: c["seq"] <= seq)
    return F.coalesce(F.try_element_at(reached, F.lit(-1))["new_type"], F.lit("UNK"))


def resolve(
    cells: DataFrame, group: list[str], seq: str, value: str, history: DataFrame | None = None
) -> DataFrame:
    """Every value converted to the type its column had at that row.

    Adds ``resolved_type``, one ``*_value`` column per physical type, and
    ``failed`` for a non-null value that does not convert: a scalar in a list
    column.
    """
    if history is None:
        history = type_history(cells, group, seq, value)
    rows = with_traits(lookup_join(cells, history, group), value)
    at = type_at(F.col("changes"), F.col(seq))
    rows = rows.withColumn("resolved_type", at)
    out = converted(F.col("resolved_type"), F.col("_kind"), F.col("_text"), F.col("_list"))
    rows = rows.withColumns(out)
    failed = F.col("traits").isNotNull() & F.coalesce(*[F.col(c).cast("string") for c in out]).isNull()
    return rows.withColumn("failed", failed).drop(
        "_kind", "_text", "_list", "traits", "changes", "final_type"
    )
