"""Fingerprints of documents from prefix polynomial hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.common import id_text, whole_text, with_id

PRIME = (1 << 31) - 1
BASES = (1_000_003, 1_998_244_353 % PRIME)
#: Code points of the spans that a sketch samples, and how many of their hashes it keeps.
SPAN = 16
SKETCH = 64
#: Pieces of the doc_id range per shuffle partition, and their largest number.
PIECES_EACH = 8
MOST_PIECES = 16_384


def _times(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """a * b mod 2^31 - 1 for values below it."""
    x = a * b
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


class Powers:
    """Powers of a base and of its inverse, extended on demand."""

    def __init__(self, base: int) -> None:
        self.up = np.array([1, base], np.uint64)
        self.down = np.array([1, pow(base, -1, PRIME)], np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            for name in ("up", "down"):
                t = getattr(self, name)
                setattr(self, name, np.concatenate([t, _times(t, _times(t[-1:], t[1:2]))]))
            assert len(self.up) == 2 * m


POWERS = [Powers(b) for b in BASES]


class PrefixHash:
    """Prefix arrays of a sequence of code points: sums of (c + 1) * base^i modulo a prime, for two bases.

    A span's value is the difference of two prefix sums, moved to position 0 by a
    power of the inverse base. Equal spans have equal values wherever they lie.
    """

    def __init__(self, points: np.ndarray, sums: list[np.ndarray] | None = None) -> None:
        self.n = len(points) if sums is None else len(sums[0]) - 1
        if sums is None:
            sums = []
            for p in POWERS:
                p.reach(self.n + 1)
                sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(_times(points.astype(np.uint64) + np.uint64(1), p.up[: self.n])) % np.uint64(PRIME)]))
        self.sums = sums

    @classmethod
    def of(cls, text: str) -> PrefixHash:
        return cls(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))

    def spliced(self, keep: int, other: PrefixHash, take: int) -> PrefixHash:
        """Of the first ``keep`` points of this and then the first ``take`` of the other; no text is read again."""
        sums = []
        for p, s, t in zip(POWERS, self.sums, other.sums, strict=True):
            p.reach(keep + take + 1)
            sums.append(np.concatenate([s[: keep + 1], (s[keep] + _times(t[1 : take + 1], p.up[keep])) % np.uint64(PRIME)]))
        return PrefixHash(None, sums)

    def span(self, start: int, length: int) -> int:
        """62-bit value of a span."""
        value = 0
        for p, s in zip(POWERS, self.sums, strict=True):
            p.reach(start + 1)
            value = value << 31 | (int(s[start + length]) - int(s[start])) % PRIME * int(p.down[start]) % PRIME
        return value

    def equal(self, start: int, other: PrefixHash, other_start: int, length: int) -> bool:
        return self.span(start, length) == other.span(other_start, length)

    def extension(self, start: int, other: PrefixHash, other_start: int) -> int:
        """Longest common extension to the right of two positions, by binary search."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            mid = (low + high + 1) // 2
            if self.equal(start, other, other_start, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def back_extension(self, end: int, other: PrefixHash, other_end: int) -> int:
        """Longest common extension to the left of two positions."""
        low, high = 0, min(end, other_end)
        while low < high:
            mid = (low + high + 1) // 2
            if self.equal(end - mid, other, other_end - mid, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def sketch(self, span: int = SPAN, keep: int = SKETCH) -> np.ndarray:
        """The ``keep`` smallest mixed values among all spans of ``span`` points; of a shorter text, its only span."""
        if self.n == 0:
            return np.zeros(0, np.uint32)
        span = min(span, self.n)
        p, s = POWERS[0], self.sums[0]
        p.reach(self.n + 1)
        # mod PRIME needs no reduction of the difference beyond adding it once
        raw = _times((s[span:] + np.uint64(PRIME) - s[:-span]) % np.uint64(PRIME), p.down[: self.n - span + 1])
        raw = raw * np.uint64(0x9E3779B97F4A7C15)
        raw ^= raw >> np.uint64(29)
        raw *= np.uint64(0xBF58476D1CE4E5B9)
        values = (raw >> np.uint64(32)).astype(np.uint32)
        limit = 1 << 32
        if len(values) > 8 * keep:
            limit = (1 << 32) * 3 * keep // len(values)
        while True:
            least = np.unique(values if limit >= 1 << 32 else values[values < limit])
            if len(least) >= keep or limit >= 1 << 32:
                return least[:keep]
            limit *= 8

    def fingerprint(self, sketch: np.ndarray) -> str:
        """Length and value of the whole text, then its sketch, in hex."""
        return f"{self.n:x}-{self.span(0, self.n):016x}-{sketch.astype('>u4').tobytes().hex()}"


def likeness(a: np.ndarray, b: np.ndarray, keep: int = SKETCH) -> float:
    """Share of spans in common (2 both / (one + other)), estimated from two sketches."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    least = np.union1d(a, b)[:keep]
    both = np.isin(least, a) & np.isin(least, b)
    shared = both.mean()
    return float(2 * shared / (1 + shared))


COLUMNS = (
    "doc_id string, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, common_prefix_edited bigint, common_prefix_next bigint, common_suffix_next bigint"
)


def _describe(doc_id, text: str, own: tuple, following: str, after: tuple) -> tuple:
    (h, sketch), (g, next_sketch) = own, after
    half = h.n // 2
    keep, take = h.n - half, min(half, g.n)
    edited = h.spliced(keep, g, take)
    edited_sketch = edited.sketch()
    sha = hashlib.sha256((text[:keep] + following[:take]).encode("utf-8", "surrogatepass")).hexdigest()
    return (
        doc_id, h.n, sha, h.fingerprint(sketch), edited.fingerprint(edited_sketch),
        likeness(sketch, edited_sketch), likeness(sketch, next_sketch),
        h.extension(0, edited, 0), h.extension(0, g, 0), h.back_extension(h.n, g, g.n),
    )


def _hashed(text: str) -> tuple:
    h = PrefixHash.of(text)
    return h, h.sketch()


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document with the next one; rows come sorted by piece, then own before guest, then order."""
    piece, held = None, None
    for batch in batches:
        out = []
        for p, guest, doc_id, text in zip(batch["piece"], batch["guest"], batch["doc_id"], batch["text"], strict=True):
            if p != piece:
                piece, held = p, None
                if guest:
                    continue
            elif held is None:
                continue  # further guests
            this = _hashed(text)
            if held is not None:
                out.append(_describe(held[0], held[1], held[2], text, this))
            held = None if guest else (doc_id, text, this)
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in COLUMNS.split(", ")])


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text keeps the first half of the code points (rounded up) and
    goes on with as many code points of the next document as it lost, or all of
    them if there are fewer. The next document is the one that follows in
    ascending doc_id; after the last comes the first. A fingerprint holds the
    length, the value of the whole text and the smallest span values; likeness
    is estimated from two fingerprints alone. Prefix lengths in common come from
    binary search on the prefix arrays.

    Documents are dealt by quantiles of doc_id into pieces; the first document of
    a piece also visits the piece before, so each text moves once and no piece
    needs another. Only one id per piece reaches the driver.

    A null text is empty, and two empty texts are alike (1). Null ids come last.
    Rows with the same id follow each other in order of their text. A table of
    one document has itself as next; an empty table gives an empty result. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))
    rows = docs.select(id_text().alias("doc_id"), order.alias("place"), whole_text().alias("text"))
    pieces = min(MOST_PIECES, PIECES_EACH * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / pieces for i in range(1, pieces)]
    bounds = np.unique(np.array(docs.select(F.col("doc_id").cast("bigint")).approxQuantile("doc_id", shares, 1 / (4 * pieces)), np.float64))

    def number(place: pd.Series) -> np.ndarray:
        return np.searchsorted(bounds, place.to_numpy(np.float64), "right").astype(np.int32)

    in_piece = F.pandas_udf(lambda place: pd.Series(number(place)), "int")
    firsts = {r.piece: r.first for r in rows.select("place").groupBy(in_piece("place").alias("piece")).agg(F.min("place").alias("first")).collect()}
    filled = sorted(firsts)
    before = {p: filled[i - 1] for i, p in enumerate(filled)}

    def visits(place: pd.Series) -> pd.Series:
        """Twice the piece of a document, and once more, plus 1, where it is a guest."""
        return pd.Series([[2 * int(p)] + ([2 * before[int(p)] + 1] if firsts[int(p)] == v else []) for p, v in zip(number(place), place, strict=True)])

    dealt = rows.withColumn("visit", F.explode(F.pandas_udf(visits, "array<int>")("place")))
    dealt = dealt.select(F.shiftright("visit", 1).alias("piece"), (F.col("visit") % 2 == 1).alias("guest"), "place", "doc_id", "text")
    dealt = dealt.repartition("piece").sortWithinPartitions("piece", "guest", "place", "text")
    return with_id(dealt.select("piece", "guest", "doc_id", "text").mapInPandas(_walk, COLUMNS))
