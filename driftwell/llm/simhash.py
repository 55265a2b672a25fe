"""Near duplicates by SimHash: exact links of close fingerprints, compared in tiles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.common import id_text, whole_text, with_id
from driftwell.session import materialize

RADIUS = 4
SHINGLE = 4
SEED = 42
#: The fingerprint is cut into this many words of bits; close ones agree on all but RADIUS of them.
WORDS = 6
#: Fingerprints in one side of a comparison, and in one tile of it.
CHUNK = 4096
TILE = 256


def fingerprint(text: str, words_per_shingle: int = SHINGLE) -> int:
    """SimHash of a text: a bit is 1 if it is set in over half of the shingle hashes."""
    # bytes.lower touches A-Z only, bytes.split the six ASCII white space characters
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    digest, n, w = xxhash.xxh64_intdigest, len(words), words_per_shingle
    if n <= w:
        hashes = [digest(joined, SEED)]
    else:
        starts = [0, *[e + 1 for e in ends[: n - w]]]
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[w - 1 :], strict=True)]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65_536):
        part = np.array(hashes[k : k + 65_536], ">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE, name: str = "doc_id") -> DataFrame:
    """The id in column ``name`` and the fingerprint as a signed bigint, one row per input row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            bits = np.array([fingerprint(t, words_per_shingle) for t in b["text"]], np.uint64)
            yield pd.DataFrame({"id": b["id"], "bits": bits.view(np.int64)})

    rows = docs.select(id_text(name).alias("id"), whole_text().alias("text")).mapInPandas(run, "id string, bits bigint")
    return with_id(rows.withColumnRenamed("id", name), name)


def bit_words(radius: int, words: int = WORDS) -> list[int]:
    """Masks of the fingerprint bits to agree on: every choice of ``words - radius`` of ``words`` runs of bits.

    Two fingerprints that differ in at most ``radius`` bits differ in at most so
    many runs, so they agree on one of the masks.
    """
    edges = np.linspace(0, 64, max(words, radius + 1) + 1).astype(int)
    runs = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(runs, len(runs) - radius)]


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int, tile: int = TILE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (a, b) of different values, a from left and b from right, within the radius.

    Both sides are sorted by population count and cut into tiles. The counts of
    two values within the radius differ by no more than the radius, so a pair of
    tiles whose counts lie further apart is skipped. The others are compared in
    full, by exclusive-or and bit counts.
    """
    sides = []
    for side in (left, right):
        counts = np.bitwise_count(side).astype(np.int16)
        order = np.argsort(counts, kind="stable")
        sides.append((side[order], counts[order]))
    (a, na), (b, nb) = sides
    for i in range(0, len(a), tile):
        x, nx = a[i : i + tile], na[i : i + tile]
        # tiles of b that start after or end before the band of counts
        first = np.searchsorted(nb, nx[0] - radius, "left") // tile * tile
        stop = np.searchsorted(nb, nx[-1] + radius, "right")
        for j in range(first, stop, tile):
            y = b[j : j + tile]
            p, q = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
            if len(p):
                yield x[p], y[q]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect the same values as the given ones, at most one per value."""
    values, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(values))
    while True:
        low = label.copy()
        np.minimum.at(low, u, label[v])
        np.minimum.at(low, v, label[u])
        low = np.minimum(low, low[low])
        if np.array_equal(low, label):
            break
        label = low
    child = np.flatnonzero(label != np.arange(len(values)))
    return values[label[child]], values[child]


def _compare(radius: int):
    def group(bits: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        values = bits.view(np.uint64)
        left, right = values[side <= 0], values[side >= 0]
        found, waiting = [], 0
        for a, b in close_pairs(left, right, radius):
            differ = a != b
            found.append((a[differ], b[differ]))
            waiting += len(a)
            if waiting > 1_000_000:  # keep what connects them
                found, waiting = [forest(*(np.concatenate(x) for x in zip(*found, strict=True)))], 0
        if not found:
            return None
        return forest(*(np.concatenate(x) for x in zip(*found, strict=True)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
            keys = frame[["m", "key", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            bits, side = frame["bits"].to_numpy(), frame["side"].to_numpy()
            out_a, out_b = [], []
            for s, e in zip([0, *cuts], [*cuts, len(frame)], strict=True):
                if e - s > 1 and (pair := group(bits[s:e], side[s:e])) is not None:
                    out_a.append(pair[0].view(np.int64))
                    out_b.append(pair[1].view(np.int64))
            if out_a:
                yield pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

        for b in batches:
            if not len(b):
                continue
            held.append(b)
            frame = pd.concat(held) if len(held) > 1 else b
            last = frame[["m", "key", "i", "j"]].to_numpy()[-1]
            open_rows = (frame[["m", "key", "i", "j"]].to_numpy() == last).all(axis=1)
            yield from flush(frame[~open_rows])
            held = [frame[open_rows]]
        if held:
            yield from flush(pd.concat(held))

    return run


def links(distinct: DataFrame, radius: int = RADIUS, words: int = WORDS, chunk: int = CHUNK) -> DataFrame:
    """Pairs (a, b) that connect exactly the fingerprints that links within the radius connect.

    ``distinct`` has each fingerprint once, as ``bits``, and is a stored table.
    Fingerprints meet where they agree on one of the masks. A meeting place with
    more than ``chunk`` of them is cut into chunks by hash; every pair of its
    chunks is a comparison of its own, so that no task holds a frequent place
    and none of its pairs is lost.
    """
    masks = F.array(*[F.lit(signed(m)).cast("bigint") for m in bit_words(radius, words)])
    met = distinct.select("bits", F.posexplode(masks).alias("m", "mask"))
    met = met.select("bits", "m", F.col("bits").bitwiseAND(F.col("mask")).alias("key"))
    sizes = materialize(met.groupBy("m", "key").count().where("count > 1"))
    met = met.join(sizes, ["m", "key"]).withColumn("chunks", F.ceil(F.col("count") / chunk).cast("int"))
    own = F.pmod(F.xxhash64("bits"), F.col("chunks")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = met.select(
        "m", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.signum(F.col("own") - F.col("other")).cast("int").alias("side"), "bits",
    )
    dealt = dealt.repartition("m", "key", "i", "j").sortWithinPartitions("m", "key", "i", "j")
    return dealt.mapInPandas(_compare(radius), "a bigint, b bigint").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the pairs; root is the smallest node it reaches.

    Alternating stars: every node joins its larger neighbours, then its smaller
    ones, to the smallest it knows, until each tree is one star. Each round is
    stored, so that a lost executor costs one round.
    """
    edges = materialize(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low"))
        low = low.select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = materialize(large.where("u > v").distinct())
        small_low = large.groupBy("u").agg(F.min("v").alias("low"))
        joined = large.join(small_low, "u")
        small = joined.where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        new = materialize(small.union(small_low.select("u", F.col("low").alias("v"))).distinct())
        if new.count() == edges.count() and edges.exceptAll(new).limit(1).count() == 0:
            break
        edges = new
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words_per_shingle: int = SHINGLE) -> DataFrame:
    """Fingerprint and component of every document, one row per input row.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    component_id is the smallest doc_id that links reach. Equal fingerprints are
    compared once. Texts without words, null and empty ones among them, have
    fingerprint 0 and are linked like any other. Repeated rows fall together. A
    null id never names a component unless all ids in it are null. An empty
    table gives an empty result. Other columns are ignored.
    """
    rows = materialize(fingerprints(docs, words_per_shingle))
    joined = rooted(rows.groupBy("bits").agg(F.min("doc_id").alias("first")), radius)
    named = materialize(joined.join(joined.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("bits", "component_id"))
    text = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return rows.join(named, "bits").select("doc_id", text.alias("fingerprint"), "component_id")


def rooted(distinct: DataFrame, radius: int) -> DataFrame:
    """Distinct fingerprints (``bits``) with the root of their component, stored; other columns stay."""
    distinct = materialize(distinct)
    roots = components(materialize(links(distinct.select("bits"), radius)))
    joined = distinct.join(roots, distinct.bits == roots.node, "left")
    return materialize(joined.select(*distinct.columns, F.coalesce("root", "bits").alias("root")))


def near_groups(docs: DataFrame, uid: str, radius: int = RADIUS, words_per_shingle: int = SHINGLE) -> DataFrame:
    """uid and root of every row: the components of ``near_duplicates`` by row, whatever ids rows share.

    ``uid`` names a column that numbers the rows of a stored table.
    """
    rows = materialize(fingerprints(docs, words_per_shingle, uid))
    return rows.join(rooted(rows.select("bits").distinct(), radius), "bits").select(F.col(uid).alias("uid"), "root")
