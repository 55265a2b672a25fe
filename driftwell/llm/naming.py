"""Exact duplicates by deterministic block naming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.common import WHITESPACE, whole_text
from driftwell.session import materialize

BLOCK_BYTES = 4096
PER_BUCKET = 20_000


def without_whitespace(text: Column) -> Column:
    for ch in WHITESPACE:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def block_hash(block: Column) -> Column:
    return F.xxhash64(block)


def blocks_of(body: Column, size: int) -> Column:
    """The bytes in pieces of ``size``; one empty piece for no bytes."""
    last = F.greatest(F.ceil(F.octet_length(body) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(body, i * size + 1, size))


def integer_names(distinct: DataFrame, key: list[str]) -> DataFrame:
    """Name distinct keys 1, 2, 3, … by sorting: the rank inside a hash bucket, buckets interleaved.

    ``distinct`` must be a stored table without repeated keys.
    """
    buckets = max(1, -(-distinct.count() // PER_BUCKET))
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key)).cast("bigint")
    return distinct.withColumn("_bucket", bucket).withColumn("name", (rank - 1) * buckets + F.col("_bucket") + 1).drop("_bucket")


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hashed=block_hash, uid: str | None = None) -> DataFrame:
    """One row per input row: uid, doc_id, n_chars, text_sha256, level and name.

    ``uid`` names a column that numbers the rows already; else they get numbers here.
    Two rows have the same (level, name) exactly when their normalised texts are equal.

    Level 0 names the blocks of fixed size. Distinct contents are gathered with
    a map-side combine, so frequent blocks shrink before the shuffle. A hash that
    has one content stands for it exactly, and its name is its rank among the
    sorted hashes; contents that share a hash are told apart by themselves. Each
    further level names the pairs of neighbouring names, until every document has
    one name. Names are collision-free at every level.
    """
    body = without_whitespace(whole_text()).cast("binary")
    pieces = docs.select(F.explode(blocks_of(body, block_bytes)).alias("block")).withColumn("h", hashed(F.col("block")))
    contents = materialize(pieces.distinct().groupBy("h").agg(F.count("*").alias("contents")))
    names = integer_names(contents, ["h"]).select("h", "name", "contents")
    names = materialize(names)

    rows = materialize(
        docs.select(
            (F.col(uid) if uid else F.monotonically_increasing_id()).alias("uid"), "doc_id",
            F.char_length(whole_text()).cast("bigint").alias("n_chars"), body.alias("body"),
        ).select(
            "uid", "doc_id", "n_chars", F.sha2("body", 256).alias("text_sha256"),
            F.transform(blocks_of(F.col("body"), block_bytes), hashed).alias("hashes"),
        )
    )
    spots = rows.select("uid", F.size("hashes").alias("n"), F.posexplode("hashes").alias("i", "h"))
    clear = names.where("contents = 1")
    placed = spots.join(clear.select("h", "name"), "h").select("uid", "n", "i", "name")
    if clear.count() < names.count():
        placed = placed.union(_told_apart(docs, rows, spots, names, block_bytes, hashed))
    placed = materialize(placed)

    done = [placed.where("n = 1").select("uid", F.lit(0).alias("level"), "name")]
    open_rows, level = placed.where("n > 1"), 0
    longest = placed.agg(F.max("n")).first()[0] or 1
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        half = F.floor(F.col("i") / 2).cast("int")
        pairs = materialize(
            open_rows.groupBy("uid", half.alias("i")).agg(
                F.first("n").alias("n"),
                F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
                # 0 is no name: the last of an odd number has no neighbour
                F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(0)).alias("b"),
            )
        )
        pair_names = materialize(integer_names(materialize(pairs.select("a", "b").distinct()), ["a", "b"]))
        named = materialize(
            pairs.join(pair_names, ["a", "b"]).select("uid", F.ceil(F.col("n") / 2).cast("int").alias("n"), "i", "name")
        )
        done.append(named.where("n = 1").select("uid", F.lit(level).alias("level"), "name"))
        open_rows = named.where("n > 1")
    whole = done[0]
    for more in done[1:]:
        whole = whole.union(more)
    return rows.drop("hashes").join(whole, "uid")


def _told_apart(docs, rows, spots, names, block_bytes, hashed) -> DataFrame:
    """Names for blocks whose hash has several contents: by the contents themselves, below 0."""
    shared = names.where("contents > 1").select("h")
    body = without_whitespace(whole_text()).cast("binary")
    held = docs.select(F.sha2(body, 256).alias("text_sha256"), F.posexplode(blocks_of(body, block_bytes)).alias("i", "block"))
    held = materialize(held.withColumn("h", hashed(F.col("block"))).join(shared, "h").distinct())
    contents = materialize(integer_names(materialize(held.select("h", "block").distinct()), ["h", "block"]))
    by_text = held.join(contents, ["h", "block"]).select("text_sha256", "i", (-F.col("name")).alias("name"))
    of_row = spots.join(shared, "h").join(rows.select("uid", "text_sha256"), "uid")
    return of_row.join(by_text, ["text_sha256", "i"]).select("uid", "n", "i", "name")


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, hashed=block_hash) -> DataFrame:
    """Which document stays of each group of equal texts; one row per input row.

    Texts are equal when they are identical without white space. The row with
    the most code points stays, then the one with the smallest doc_id; a null id
    comes after all others; of rows equal in both, one stays. A null text is
    empty, and all empty texts are one group. An empty table gives an empty
    result. Columns other than doc_id and text are ignored.
    """
    rows = materialize(identities(docs, block_bytes, hashed))
    groups = materialize(
        rows.groupBy("level", "name").agg(
            F.count("*").alias("group_size"),
            F.max(F.struct("n_chars", F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("minus"), (-F.col("uid")).alias("row"))).alias("best"),
        ).select("level", "name", "group_size", (-F.col("best.minus")).alias("keep_id"), (-F.col("best.row")).alias("keep_row"))
    )
    return rows.join(groups, ["level", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_row")).alias("kept"), "text_sha256"
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
             count(*) OVER (PARTITION BY body) AS group_size,
             row_number() OVER (PARTITION BY body ORDER BY n DESC, doc_id NULLS LAST) = 1 AS kept FROM d)
SELECT doc_id, keep_id, group_size, kept, sha256(body) AS text_sha256 FROM g
"""
