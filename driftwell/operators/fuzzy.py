"""Joins on values that are nearly equal (X4): a segment index blocks, edit distance verifies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.session import even_join, lookup_join, materialize, spread

#: Values in one part of a block.
CHUNK = 10_000
#: Rows of one value in one pack.
COPIES = 1_000


def _cut(length: Column, i: Column, segments: int) -> Column:
    """Where segment ``i`` of a value of that length begins."""
    return F.floor(length * i / segments).cast("int")


def near_values(left: DataFrame, right: DataFrame, value: str, most: int, chunk: int = CHUNK) -> DataFrame:
    """Pairs (left_value, right_value, distance) of distinct values within ``most`` edits, without regard to case.

    A value of the right side is cut into ``most + 1`` segments. Edits spoil at
    most ``most`` of them, so one is a substring of the other value, at most
    ``most`` places away, and lengths differ by no more. Segments with length,
    number and text are the block key; substrings of the left side probe them.
    A block with more than ``chunk`` values is dealt to parts that all its
    probes visit. Null values match nothing.
    """
    pieces = most + 1
    numbers = F.sequence(F.lit(0), F.lit(most))
    lefts, rights = (
        materialize(df.where(F.col(value).isNotNull()).select(F.lower(value).alias("value")).distinct()) for df in (left, right)
    )
    index = rights.select("value", F.char_length("value").alias("length"), F.explode(numbers).alias("i"))
    begin, end = _cut(F.col("length"), F.col("i"), pieces), _cut(F.col("length"), F.col("i") + 1, pieces)
    key = ["length", "i", "segment"]
    index = index.select(*key[:2], F.substr("value", begin + 1, end - begin).alias("segment"), F.col("value").alias("right_value"))
    own = F.char_length("value")
    probes = lefts.select("value", F.explode(F.sequence(F.greatest(own - most, F.lit(0)), own + most)).alias("length"))
    probes = probes.select("value", "length", F.explode(numbers).alias("i"))
    probes = probes.select("value", "length", "i", begin.alias("begin"), (end - begin).alias("width"))
    probes = probes.select("value", "length", "i", "width", F.explode(F.sequence(F.col("begin") - most, F.col("begin") + most)).alias("at"))
    probes = probes.where((F.col("at") >= 0) & (F.col("at") + F.col("width") <= own)).select(
        *key[:2], F.substr("value", F.col("at") + 1, F.col("width")).alias("segment"), F.col("value").alias("left_value")
    ).distinct()
    hot = materialize(index.groupBy(*key).count().where(F.col("count") > chunk).select(*key, F.ceil(F.col("count") / chunk).cast("int").alias("parts")))
    if not hot.isEmpty():
        parts = F.coalesce("parts", F.lit(1))
        index = index.join(hot, key, "left").withColumn("part", F.pmod(F.xxhash64("right_value"), parts).cast("int")).drop("parts")
        probes = probes.join(hot, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
        key = [*key, "part"]
    distance = F.levenshtein("left_value", "right_value", most)
    return probes.join(index, key).select("left_value", "right_value", distance.alias("distance")).where("distance >= 0").distinct()


def _packs(rows: DataFrame, on: str, copies: int) -> tuple[DataFrame, DataFrame]:
    """Tables (value, packs) and (value, pack, rows): rows whose values are equal without regard to case, dealt to packs of about ``copies``.

    Fields of the packed rows are named by their places. Numbers that deal rows are stored, so that a task that runs again deals alike.
    """
    fields = [f"c{i}" for i in range(len(rows.columns))]
    numbered = rows.where(F.col(on).isNotNull()).select(F.lower(on), "*").toDF("value", *fields)
    numbered = materialize(numbered.select("value", F.struct(*fields).alias("row"), F.xxhash64(F.monotonically_increasing_id()).alias("number")))
    sizes = materialize(numbered.groupBy("value").agg(F.ceil(F.count(F.lit(1)) / copies).cast("int").alias("packs")))
    dealt = lookup_join(numbered, sizes.where("packs > 1"), ["value"], salt=F.col("number"))
    pack = F.pmod("number", F.coalesce("packs", F.lit(1))).cast("int")
    return sizes, materialize(dealt.groupBy("value", pack.alias("pack")).agg(F.collect_list("row").alias("rows")))


def fuzzy_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, most: int, chunk: int = CHUNK, copies: int = COPIES) -> DataFrame:
    """Rows of both sides whose values are within ``most`` edits, with their ``distance``.

    Pairs are found among distinct values. Rows of a value travel in packs,
    which are opened where a pack of either side has met: all pairs of rows
    are made, but none is shuffled, and those of a hot value come from many tasks.
    """
    sides = {"left": _packs(left, left_on, copies), "right": _packs(right, right_on, copies)}
    met = near_values(sides["left"][0], sides["right"][0], "value", most, chunk)
    for side, (sizes, _) in sides.items():
        met = even_join(met, sizes.withColumnRenamed("value", f"{side}_value"), [f"{side}_value"])
        met = met.withColumn(f"{side}_pack", F.explode(F.sequence(F.lit(0), F.col("packs") - 1))).drop("packs")
    for side, (_, packs) in sides.items():
        met = even_join(met, packs.toDF(f"{side}_value", f"{side}_pack", f"{side}_rows"), [f"{side}_value", f"{side}_pack"])
    met = spread(met, *[f"{side}_{part}" for side in sides for part in ("value", "pack")])
    opened = met.select(F.inline("left_rows"), "distance", "right_rows").select("*", F.inline("right_rows")).drop("right_rows")
    return opened.toDF(*left.columns, "distance", *right.columns)


def fuzzy_classes(left: DataFrame, right: DataFrame, left_key: str, left_on: str, right_key: str, right_on: str, most: int, chunk: int = CHUNK) -> DataFrame:
    """The rows of ``fuzzy_join`` without expanding copies: kind, a, b, distance.

    Rows of a side whose values are equal without regard to case are a class,
    named by its smallest key. ``pair`` rows are the names of a left and a right
    class within ``most`` edits; ``left`` and ``right`` rows are a key and the
    name of its class. Null values are in no class.
    """
    one, other = (
        df.where(F.col(on).isNotNull()).select(F.col(key).alias("key"), F.lower(on).alias("value")) for df, key, on in ((left, left_key, left_on), (right, right_key, right_on))
    )
    named = [materialize(df.groupBy("value").agg(F.min("key").alias("name"))) for df in (one, other)]
    pairs = near_values(*named, "value", most, chunk)
    pairs = even_join(pairs, named[0].select(F.col("value").alias("left_value"), F.col("name").alias("a")), ["left_value"])
    pairs = even_join(pairs, named[1].select(F.col("value").alias("right_value"), F.col("name").alias("b")), ["right_value"])
    out = pairs.select(F.lit("pair").alias("kind"), "a", "b", "distance")
    for kind, rows, names in (("left", one, named[0]), ("right", other, named[1])):
        members = even_join(rows, names, ["value"])
        out = out.unionByName(members.select(F.lit(kind).alias("kind"), F.col("key").alias("a"), F.col("name").alias("b"), F.lit(None).cast("int").alias("distance")))
    return out
