"""Quality by supervised subword embeddings: learned hashed vectors, averaged, softmax, stochastic gradient descent."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.common import held_out, whole_text
from driftwell.llm.subwords import BLANK, Rolling, chunks, edges, mixed

#: Documents the classifier is fitted on, at most; chosen by hash of their id.
SAMPLE = 4000
BITS = 18
GRAMS = (2, 3, 4)
BACK = (1, 2)
SIZE = 16
PASSES = 6
RATE = 4.0
THRESHOLD = 0.3


def features(texts: list[str], bits: int = BITS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, text of each feature counted from there, hashed features): words, their repeats, and byte n-grams."""
    shift = np.uint64(64 - bits)
    for first, data, starts in chunks([t.lower().encode("utf-8", "surrogatepass") for t in texts]):
        rolling = Rolling(data)
        owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        begin, end = edges(~BLANK[data])
        words, of_word = rolling.spans(begin, end), owner[begin]
        owners, hashed = [of_word], [(words ^ np.uint64(0x5851F42D4C957F2D)) >> shift]
        for back in BACK:  # whether a word is the one so many places before
            if len(words) > back:
                same = of_word[back:] == of_word[:-back]
                owners.append(of_word[back:][same])
                hashed.append(mixed(np.uint64(2 * back) + (words[back:] == words[:-back]).astype(np.uint64))[same] >> shift)
        for n in GRAMS:
            if len(data) > n:
                inside = owner[: len(data) - n] == owner[n : len(data)]
                owners.append(owner[: len(data) - n][inside])
                hashed.append((rolling.all_spans(n)[:-1] >> shift)[inside])
        yield first, np.concatenate(owners), np.concatenate(hashed).astype(np.int64)


def sample(docs: DataFrame, labels: DataFrame, label: str, at_most: int) -> DataFrame:
    """doc_id, text and y of at most ``at_most`` labelled documents, none of them held out.

    The choice depends on hashes of ids only. The chosen ids are few by the
    parameter, so they are broadcast and texts stay where they are read. Of rows
    that share a chosen id one is taken, by the hash of its text, so that the
    bound is on rows.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(at_most)
    texts = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    one = F.max(F.struct(F.xxhash64("text").alias("hash"), "text", "y")).alias("one")
    return texts.groupBy("doc_id").agg(one).select("doc_id", "one.text", "one.y")


def counted(texts: DataFrame) -> pd.DataFrame:
    """The features of a bounded sample: y, distinct features and their shares of the text, in order of id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            y, ids = b["y"].to_numpy(), b["doc_id"].to_numpy()
            for first, owner, hashed in features(list(b["text"])):
                order = np.argsort(owner, kind="stable")
                owner, hashed = owner[order], hashed[order]
                for i in np.unique(owner):
                    lo, hi = np.searchsorted(owner, [i, i + 1])
                    distinct, counts = np.unique(hashed[lo:hi], return_counts=True)
                    rows.append((ids[first + i], y[first + i], distinct.astype(np.int32).tobytes(), (counts / (hi - lo)).astype(np.float32).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "y", "ids", "shares"])

    return texts.mapInPandas(run, "doc_id bigint, y int, ids binary, shares binary").toPandas().sort_values(["doc_id", "ids"])


class Embeddings:
    """Feature vectors and an output matrix; a text's logits are the matrix times the mean of its vectors."""

    def __init__(self, bits: int = BITS, size: int = SIZE, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / size, 1 / size, (1 << bits, size)).astype(np.float32)
        self.output = np.zeros((2, size), np.float32)
        self.bias = np.zeros(2, np.float32)

    def fit(self, y: np.ndarray, ids: list[np.ndarray], shares: list[np.ndarray], passes: int = PASSES, rate: float = RATE, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        steps, total = 0, max(1, passes * len(y))
        for _ in range(passes):
            for k in rng.permutation(len(y)):
                step = rate * (1 - steps / total)
                steps += 1
                vectors = self.vectors[ids[k]]
                mean = shares[k] @ vectors
                logits = self.output @ mean + self.bias
                p = np.exp(logits - logits.max())
                p /= p.sum()
                p[y[k]] -= 1
                back = p @ self.output
                self.output -= step * np.outer(p, mean)
                self.bias -= step * 0.1 * p
                # the gradient of the mean, spread over its features by their shares
                self.vectors[ids[k]] = vectors - (step * shares[k])[:, None] * back

    def table(self) -> tuple[np.ndarray, float]:
        """Difference of the two logits that each feature contributes, and the constant; the mean is linear."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", at_most: int = SAMPLE) -> tuple[np.ndarray, float]:
    rows = counted(sample(docs, labels, label, at_most))
    model = Embeddings()
    y = rows["y"].to_numpy(int)
    ids = [np.frombuffer(x, np.int32) for x in rows["ids"]]
    shares = [np.frombuffer(x, np.float32) for x in rows["shares"]]
    if len(y):
        model.bias[:] = np.log([max(1, (y == 0).sum()), max(1, (y == 1).sum())])
        model.fit(y, ids, shares)
    return model.table()


def scores(texts: list[str], table: np.ndarray, constant: float) -> np.ndarray:
    logits = np.full(len(texts), constant)
    for first, owner, hashed in features(texts):
        n = int(owner.max()) + 1 if len(owner) else 0
        total = np.bincount(owner, weights=table[hashed], minlength=n)
        logits[first : first + n] += total / np.maximum(1, np.bincount(owner, minlength=n))
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def scorer(docs: DataFrame, labels: DataFrame, at_most: int = SAMPLE) -> Callable[[Column], Column]:
    """Train, and give the function that scores a text column where it stands, without a join."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, at_most=at_most))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(scores(list(texts), *model.value))

    return score


def score_quality(docs: DataFrame, labels: DataFrame, at_most: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Probability that a document is good, one row per input row.

    Vectors of hashed words and byte n-grams are learned together with a softmax
    output on a sample of at most ``at_most`` labelled documents outside the
    held-out fifth; whole texts are used in training and in scoring. A lowered
    text is all a score depends on.

    A null or empty text has no features and gets the score of the class
    shares. Without usable labels every score is 0.5. A document labelled twice
    counts as good if one label says so. Null ids are scored like any other;
    repeated rows get equal scores. An empty table gives an empty result. Other
    columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), scorer(docs, labels, at_most)(whole_text()).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
