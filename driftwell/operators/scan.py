"""Ordered running aggregates that never put a whole group into one task.

A window over ``partitionBy(group).orderBy(seq)`` sorts each group in a single
task, which fails when one group holds a third of the table. Here the group is
cut into blocks of consecutive ``seq`` values: blocks are scanned independently,
and what each block needs from its predecessors is a scan over per-block
partials, itself cut once more into super-blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.session import even_join

BLOCK_BITS = 18


@dataclass(frozen=True)
class Running:
    """One running measure. ``kind`` is sum, count, max, min, last or first.

    ``last`` and ``first`` skip nulls. ``inclusive`` tells whether the current
    row belongs to its own frame.
    """

    kind: str
    value: Column
    inclusive: bool = True

    def partial(self, column: Column, order: Column) -> Column:
        present = F.when(column.isNotNull(), order)
        return {
            "sum": lambda: F.sum(column),
            "count": lambda: F.count(column),
            "max": lambda: F.max(column),
            "min": lambda: F.min(column),
            "last": lambda: F.max_by(column, present),
            "first": lambda: F.min_by(column, present),
        }[self.kind]()

    def fold(self, column: Column) -> Column:
        return {
            "sum": lambda: F.sum(column),
            "count": lambda: F.sum(column),
            "max": lambda: F.max(column),
            "min": lambda: F.min(column),
            "last": lambda: F.last(column, ignorenulls=True),
            "first": lambda: F.first(column, ignorenulls=True),
        }[self.kind]()

    def local(self, column: Column) -> Column:
        return F.count(column) if self.kind == "count" else self.fold(column)

    def merge(self, earlier: Column, later: Column) -> Column:
        return {
            "sum": lambda: F.coalesce(earlier + later, earlier, later),
            "count": lambda: F.coalesce(earlier, F.lit(0)) + F.coalesce(later, F.lit(0)),
            "max": lambda: F.greatest(earlier, later),
            "min": lambda: F.least(earlier, later),
            "last": lambda: F.coalesce(later, earlier),
            "first": lambda: F.coalesce(earlier, later),
        }[self.kind]()


def running_scan(
    df: DataFrame,
    group: list[str],
    seq: str,
    measures: dict[str, Running],
    tie: list[str] | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add one running column per measure, per ``group``, in ``seq`` order.

    ``seq`` is an integer that comes from the data; with ``tie`` it need not be
    unique. Group columns must not be null.
    """
    tie = tie or []
    names = list(measures)
    slot = {n: f"_m{i}" for i, n in enumerate(names)}
    rows = df.withColumn("_blk", F.shiftright(F.col(seq).cast("bigint"), block_bits))
    rows = rows.withColumns({slot[n]: m.value for n, m in measures.items()})

    order = F.struct(seq, *tie)
    partials = (
        rows.groupBy(*group, "_blk")
        .agg(*[m.partial(F.col(slot[n]), order).alias(slot[n]) for n, m in measures.items()])
        .withColumn("_sup", F.shiftright("_blk", block_bits))
    )
    before = (Window.unboundedPreceding, -1)
    blocks = partials.select(
        *group, "_blk", "_sup",
        *[
            m.fold(F.col(slot[n])).over(
                Window.partitionBy(*group, "_sup").orderBy("_blk").rowsBetween(*before)
            ).alias(f"{slot[n]}b")
            for n, m in measures.items()
        ],
    )
    # within a super-block the blocks are already in place for the totals
    totals = partials.groupBy(*group, "_sup").agg(
        *[
            (F.max_by(slot[n], F.when(F.col(slot[n]).isNotNull(), F.col("_blk")))
             if m.kind == "last"
             else F.min_by(slot[n], F.when(F.col(slot[n]).isNotNull(), F.col("_blk")))
             if m.kind == "first"
             else m.fold(F.col(slot[n]))).alias(slot[n])
            for n, m in measures.items()
        ]
    )
    supers = totals.select(
        *group, "_sup",
        *[
            m.fold(F.col(slot[n])).over(
                Window.partitionBy(*group).orderBy("_sup").rowsBetween(*before)
            ).alias(f"{slot[n]}s")
            for n, m in measures.items()
        ],
    )
    carry = even_join(blocks, supers, [*group, "_sup"]).select(
        *group, "_blk",
        *[
            m.merge(F.col(f"{slot[n]}s"), F.col(f"{slot[n]}b")).alias(f"{slot[n]}c")
            for n, m in measures.items()
        ],
    )
    inside = Window.partitionBy(*group, "_blk").orderBy(seq, *tie)
    local = rows.withColumns(
        {
            f"{slot[n]}l": m.local(F.col(slot[n])).over(
                inside.rowsBetween(Window.unboundedPreceding, 0 if m.inclusive else -1)
            )
            for n, m in measures.items()
        }
    )
    joined = even_join(local, carry, [*group, "_blk"], "left")
    return joined.select(
        *[F.col(c) for c in df.columns if c not in measures],
        *[
            m.merge(F.col(f"{slot[n]}c"), F.col(f"{slot[n]}l")).alias(n)
            for n, m in measures.items()
        ],
    )


def dense_number(
    df: DataFrame,
    name: str,
    seq: str,
    group: list[str] | None = None,
    tie: list[str] | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Number rows 1, 2, 3, … per group in ``seq`` order."""
    return running_scan(
        df, group or [], seq, {name: Running("count", F.lit(1))}, tie, block_bits
    )
