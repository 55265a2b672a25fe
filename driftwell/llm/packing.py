"""Batches of a token budget from length buckets that minimise padding."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.common import WORD_PATTERN, number_within, whole_text
from driftwell.session import materialize

#: Pieces are at most this long; the histogram has so many entries at most.
MAX_LENGTH = 2048
BUCKETS = 16
TOKEN_BUDGET = 65_536


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` length ranges with the least total padding.

    Dynamic programming over the histogram: padding of lengths i..j in one
    bucket is length[j] * count(i..j) - tokens(i..j). The lengths are distinct
    and increasing. Of equal optima the one with the fewest buckets is taken.
    """
    n = len(lengths)
    if n == 0:
        return []
    rows = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    tokens = np.concatenate([[0], np.cumsum(lengths * counts, dtype=np.int64)])
    worst = np.iinfo(np.int64).max // 4
    best = np.full(n + 1, worst, dtype=np.int64)
    best[0] = 0
    last, choices = None, []
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, worst, dtype=np.int64), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            cut[j] = np.argmin(cost)
            new[j] = cost[cut[j]]
        if last is not None and new[n] >= last:
            break
        choices.append(cut)
        best, last = new, new[n]
    ends, j = [], n
    for cut in reversed(choices):
        ends.append(int(lengths[j - 1]))
        j = int(cut[j])
    return ends[::-1]


def pack(
    docs: DataFrame,
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    budget: int = TOKEN_BUDGET,
    tokens: Column | None = None,
) -> DataFrame:
    """Cut documents into pieces, pieces into length buckets, buckets into batches.

    Tokens are the words of the text unless a count is given. A document of more
    than ``max_length`` tokens becomes full pieces and a rest, so that the
    histogram of lengths has ``max_length`` entries at most, whatever the corpus;
    it alone goes to the driver, and its optimal boundaries are exact. A batch
    holds as many pieces of one bucket as fit the budget when each is padded to
    the bucket's end; only the last batch of a bucket is smaller. Pieces are
    numbered inside their bucket by distributed counts.

    Documents without tokens, null texts among them, have no piece: one row with
    piece 0, length 0 and null bucket, batch and place. Null ids and repeated
    rows are packed like any others. An empty table gives an empty result. Other
    columns are ignored.
    """
    size = F.regexp_count(whole_text(), F.lit(WORD_PATTERN)) if tokens is None else tokens
    rows = docs.select("doc_id", size.cast("bigint").alias("n_tokens"))
    last = F.greatest(F.ceil(F.col("n_tokens") / max_length).cast("bigint") - 1, F.lit(0))
    pieces = rows.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
    start = F.col("piece") * max_length
    pieces = materialize(pieces.select("doc_id", "piece", start.alias("start"), F.least(F.lit(max_length), F.col("n_tokens") - start).alias("length")))
    held = pieces.where("length > 0").groupBy("length").count().orderBy("length").collect()
    ends = best_boundaries(np.array([r.length for r in held], np.int64), np.array([r["count"] for r in held], np.int64), buckets)
    if not ends:
        nothing = {c: F.lit(None).cast("bigint") for c in ("bucket", "bucket_length", "batch", "place")}
        return pieces.withColumns(nothing)
    all_ends = F.array(*[F.lit(e).cast("bigint") for e in ends])
    bucket = F.size(F.filter(all_ends, lambda e: e < F.col("length")))
    filled = pieces.where("length > 0").withColumn("bucket", bucket.cast("bigint"))
    filled = filled.withColumn("bucket_length", F.get(all_ends, F.col("bucket").cast("int")))
    numbered = number_within(filled, ["bucket"], ["doc_id", "piece", "length"], "number")
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_length")))
    packed = numbered.withColumn("batch", F.floor(F.col("number") / room)).withColumn("place", F.col("number") % room).drop("number")
    bare = pieces.where("length = 0").withColumns({c: F.lit(None).cast("bigint") for c in ("bucket", "bucket_length", "batch", "place")})
    return packed.select(bare.columns).unionByName(bare)
