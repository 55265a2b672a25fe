"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.common import WORD_PATTERN, number_in_order, whole_text
from driftwell.session import materialize

MOST_COPIES = 3
PER_CELL = 2_000
#: Preferences are whole numbers from 1 to this.
LEVELS = 16
#: Uniform numbers have this many bits, from the MD5 of the document's id.
BITS = 48


def uniform(key: Column) -> Column:
    """A number above 0 and below 1 that depends on the key only, the same in every run."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, BITS // 4)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / float(1 << BITS)


def source_targets(sources: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Share the total size by weight 1, 2, 3, 1, … in source order, at most ``most`` times a source's size.

    Each round gives what is left to the open sources by weight; sources whose
    share exceeds their limit close at the limit. Rounds end when none closes.
    Only two sums per round reach the driver. ``sources`` has (source, absent, size).
    """
    ranked = materialize(
        number_in_order(sources, [F.col("absent"), F.col("source")], "rank").withColumn("weight", F.col("rank") % 3 + 1)
    )
    total = ranked.agg(F.sum("size")).first()[0] or 0
    full = F.lit(False)
    left, weights = total, None
    limit = F.col("size") * most
    closed_before = -1
    while True:
        sums = ranked.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weights"),
            F.count(F.when(full, 1)).alias("closed"),
        ).first()
        if sums.closed == closed_before or sums.weights == 0:
            break
        closed_before, left, weights = sums.closed, total - sums.given, sums.weights
        share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(weights))
        full = limit < share
    if weights is None:
        return ranked.withColumn("target", F.lit(0.0))
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(weights))
    return ranked.withColumn("target", F.when(limit < share, limit.cast("double")).otherwise(share))


def longer(size: Column) -> Column:
    """A preference for longer documents: how many binary digits the size has, at most ``LEVELS``."""
    return F.least(F.length(F.bin(size)), F.lit(LEVELS))


def expected_copies(levels: DataFrame, most: int) -> DataFrame:
    """How often a document of each source and level is expected in the mix, so that the words expected are the target.

    The number is the level times one factor per source, at most ``most``. Levels
    whose number would be higher have ``most``; the factor shares the rest of the
    target among the levels below. ``levels`` has one row per source and level
    with size (of its documents together) and target (of the source).
    """
    source = Window.partitionBy("source", "absent")
    down = source.orderBy(F.desc("level"))
    above = F.coalesce(F.sum("size").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    liked = F.sum(F.col("size") * F.col("level")).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    factor = F.when(liked > 0, (F.col("target") - (most * above).cast("double")) / liked.cast("double"))
    fitting = levels.withColumn("factor", factor).withColumn("fits", F.col("factor") * F.col("level") <= float(most))
    first = F.max(F.when(F.col("fits"), F.struct("level", "factor"))).over(source)
    below = fitting.withColumn("first", first).withColumn(
        "expected", F.when(F.col("level") <= F.col("first.level"), F.col("first.factor") * F.col("level")).otherwise(F.lit(float(most)))
    )
    return below.drop("factor", "fits", "first")


def _ahead(rows: DataFrame, weight: Column, name: str) -> DataFrame:
    """The sum of ``weight`` over the rows of the source that are ahead in rank, by cells of neighbours."""
    key = ["source", "absent", "cell"]
    sums = rows.groupBy(*key).agg(F.sum(weight).alias("words"))
    earlier = F.sum("words").over(Window.partitionBy("source", "absent").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select(*key, F.coalesce(earlier, F.lit(0)).alias("start"))
    inside = F.sum(weight).over(Window.partitionBy(*key).orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("inside", F.coalesce(inside, F.lit(0))).join(starts, key).withColumn(name, F.col("start") + F.col("inside")).drop("start", "inside")


def mix(docs: DataFrame, most: int = MOST_COPIES, per_cell: int = PER_CELL, preference: Column | None = None, uid: str | None = None) -> DataFrame:
    """How many words of each document the mix takes.

    A document is expected in the mix as often as its ``preference`` (a whole
    number from 1 to ``LEVELS``; by default ``longer``) times a factor that makes
    the words expected of its source the source's target, at most ``most``. The
    whole part is certain. The fraction is the document's inclusion probability p
    in a Pareto sample: with a uniform number u, documents are ranked by
    (u / (1 - u)) / (p / (1 - p)) and taken from the top while their words fit
    into the rest of the target; what then is left goes to the next in rank that
    are not longer than it, as near as a document allows. So the size of the
    sample in words is fixed, whatever the draws.

    Ranks need no task that holds a source: documents are dealt into cells of
    about ``per_cell`` neighbours in rank (by the share of documents that is
    expected ahead of a rank), and word sums of the cells give each its start.

    Empty and null texts have size 0 and take nothing; texts of any length are
    counted whole, and one longer than the rest of the target is not drawn. A
    null source is a source of its own, the last. Repeated rows are ranked like
    any others; rows that are equal in every column share their draw. Null ids
    share a draw too. An empty table gives an empty result. Columns of the input
    other than doc_id, text and source are ignored; ``uid`` may name one that
    numbers the rows, and is returned as uid.
    """
    carried = [F.col(uid).alias("uid")] if uid else []
    liking = None if preference is None else F.greatest(F.lit(1), F.least(F.lit(LEVELS), F.coalesce(preference.cast("int"), F.lit(1))))
    rows = docs.select(
        "doc_id", *carried,
        F.coalesce("source", F.lit("")).alias("source"),
        F.col("source").isNull().alias("absent"),
        F.regexp_count(whole_text(), F.lit(WORD_PATTERN)).cast("bigint").alias("size"),
        *([] if liking is None else [liking.alias("level")]),
    )
    if liking is None:
        rows = rows.withColumn("level", longer(F.col("size")))
    rows = materialize(rows.withColumn("u", uniform(F.col("doc_id"))))
    levels = materialize(rows.groupBy("source", "absent", "level").agg(F.sum("size").alias("size"), F.count("*").alias("docs")))
    sources = levels.groupBy("source", "absent").agg(F.sum("size").alias("size"))
    targets = source_targets(sources, most).select("source", "absent", F.col("size").alias("source_size"), "target")

    edge = 1e-9
    plan = expected_copies(levels.join(targets, ["source", "absent"]), most).withColumn("copies", F.floor("expected"))
    plan = plan.withColumn("p", F.greatest(F.lit(edge), F.least(F.lit(1 - edge), F.col("expected") - F.col("copies"))))
    source = Window.partitionBy("source", "absent")
    drawable = F.col("copies") < most
    docs_drawn = F.sum(F.when(drawable, F.col("docs")).otherwise(0)).over(source)
    odds = F.struct((F.col("docs") / docs_drawn).alias("share"), (F.col("p") / (1 - F.col("p"))).alias("odds"))
    plan = materialize(plan.select(
        "source", "absent", "level", "source_size", "target", "copies", "p",
        (F.col("target") - F.sum(F.col("copies") * F.col("size")).over(source).cast("double")).alias("rest"),
        F.array_sort(F.collect_list(F.when(drawable, odds)).over(source)).alias("mixture"),
        F.greatest(F.lit(1), F.ceil(docs_drawn / per_cell)).alias("cells"),
    ))

    drawn_from = drawable & (F.col("size") > 0)
    ranked = rows.join(plan, ["source", "absent", "level"]).withColumn(
        "rank", (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    )
    # the share of documents expected ahead of a rank, so that cells hold about as many documents each
    ahead = F.aggregate("mixture", F.lit(0.0), lambda s, m: s + m["share"] * (m["odds"] * F.col("rank") / (1 + m["odds"] * F.col("rank"))))
    ranked = ranked.withColumn("weight", F.when(drawn_from, F.col("size")).otherwise(F.lit(0))).withColumn(
        "cell", F.least(F.floor(F.when(drawn_from, ahead).otherwise(F.col("u")) * F.col("cells")), F.col("cells") - 1)
    ).drop("mixture", "cells", "p", "u", "level")
    placed = _ahead(ranked, F.col("weight"), "before")
    fits = (F.col("weight") > 0) & ((F.col("before") + F.col("size")).cast("double") <= F.col("rest"))
    placed = materialize(placed.withColumn("fits", fits).drop("before"))

    # by cell, so that no join deals a whole source to one task
    key = ["source", "absent", "cell"]
    used = placed.groupBy(*key).agg(F.sum(F.when(F.col("fits"), F.col("size")).otherwise(F.lit(0))).alias("used"))
    used = used.withColumn("used", F.sum("used").over(source))
    late = placed.join(used, key).withColumn("gap", F.col("rest") - F.col("used").cast("double"))
    may = ~F.col("fits") & (F.col("weight") > 0) & (F.col("size").cast("double") <= F.col("gap"))
    late = late.withColumn("weight", F.when(may, F.col("size")).otherwise(F.lit(0)))
    late = _ahead(late, F.col("weight"), "before")
    fills = (F.col("weight") > 0) & ((2 * F.col("before") + F.col("size")).cast("double") <= 2 * F.col("gap"))
    return late.select(
        *(["uid"] if uid else []), "doc_id", "size", "source_size", "target",
        (F.col("size") * (F.col("copies") + F.when(F.col("fits") | fills, 1).otherwise(0))).cast("bigint").alias("taken"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT)::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS k FROM w),
c AS (SELECT *, sum(3 * source_size) OVER (ORDER BY k) - 3 * source_size AS given,
             sum(weight) OVER () - sum(weight) OVER (ORDER BY k) + weight AS weights,
             sum(source_size) OVER () AS total FROM o),
-- the first source, in order of limit over weight, that stays open when all before it are closed
f AS (SELECT total - given AS lft, weights, k FROM c
      WHERE NOT 3 * source_size < (weight * (total - given))::DOUBLE / weights::DOUBLE ORDER BY k LIMIT 1),
t AS (SELECT c.source, c.source_size,
             CASE WHEN c.k < f.k THEN (3 * c.source_size)::DOUBLE ELSE (c.weight * f.lft)::DOUBLE / f.weights::DOUBLE END AS target
      FROM c CROSS JOIN f),
-- sources by level, the number of binary digits of the size; levels above the first that fits have three copies
l AS (SELECT source, least(length(bin(size)), 16) AS level, sum(size)::BIGINT AS size FROM d GROUP BY ALL),
g AS (SELECT l.*, t.source_size, t.target, coalesce(sum(l.size) OVER v, 0) AS above, sum(l.size * level) OVER z AS liked
      FROM l JOIN t ON l.source IS NOT DISTINCT FROM t.source
      WINDOW v AS (PARTITION BY l.source ORDER BY level DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             z AS (PARTITION BY l.source ORDER BY level DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
h AS (SELECT *, CASE WHEN liked > 0 THEN (target - (3 * above)::DOUBLE) / liked::DOUBLE END AS factor FROM g),
k AS (SELECT *, max(CASE WHEN factor * level <= 3.0 THEN level END) OVER (PARTITION BY source) AS first FROM h),
e AS (SELECT *, max(CASE WHEN level = first THEN factor END) OVER (PARTITION BY source) AS chosen FROM k),
n AS (SELECT *, CASE WHEN level <= first THEN chosen * level ELSE 3.0::DOUBLE END AS expected FROM e),
p AS (SELECT *, floor(expected)::BIGINT AS copies FROM n),
q AS (SELECT *, greatest(1e-9::DOUBLE, least(1 - 1e-9::DOUBLE, expected - copies::DOUBLE)) AS incl,
             target - (sum(copies * size) OVER (PARTITION BY source))::DOUBLE AS rest FROM p),
x AS (SELECT d.doc_id, d.size, q.source_size, q.target, q.copies, q.rest, d.source, copies < 3 AND d.size > 0 AS open,
             (d.u / (1 - d.u)) / (incl / (1 - incl)) AS rank
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source AND least(length(bin(d.size)), 16) = q.level),
y AS (SELECT *, open AND (coalesce(sum(size) FILTER (open) OVER (PARTITION BY source ORDER BY rank, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size)::DOUBLE <= rest AS fits FROM x),
a AS (SELECT *, rest - (coalesce(sum(size) FILTER (fits) OVER (PARTITION BY source), 0))::DOUBLE AS gap FROM y),
b AS (SELECT *, open AND NOT fits AND size::DOUBLE <= gap AS late FROM a),
m AS (SELECT *, late AND (2 * coalesce(sum(size) FILTER (late) OVER (PARTITION BY source ORDER BY rank, doc_id, size
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size)::DOUBLE <= 2 * gap AS fills FROM b)
SELECT doc_id, size, source_size, target, (size * (copies + CASE WHEN fits OR fills THEN 1 ELSE 0 END))::BIGINT AS taken
FROM m
"""
