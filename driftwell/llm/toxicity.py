"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from driftwell.llm.common import held_out, id_text, whole_text, with_id
from driftwell.llm.quality import sample
from driftwell.llm.subwords import IN_WORD, Rolling, chunks, edges

#: Labelled documents that voters are chosen and the models are fitted on, at most.
SAMPLE = 8000
BITS = 22
#: Beginnings and ends of words that may vote, in bytes.
AFFIXES = (3, 4, 5, 6)
MOST_VOTERS = 384
#: Least evidence (twice the log likelihood ratio) and purity of a learned voter.
EVIDENCE, PURITY = 18.0, 0.9
#: Conditional correlation from which two voters count as one voice.
TIED = 0.2
THRESHOLD = 0.5

# The words of the built-in lexicon, each a voter.
LEXICON = (
    "idiot moron stupid dumb loser clown scum trash pathetic worthless disgusting imbecile cretin "
    "filthy vermin jerk bastard bitch whore slut asshole fuck fucking shit crap retard retarded freak "
    "ugly fool foolish coward degenerate garbage subhuman parasite hate despise kill"
).split()
#: Rules beside the lexicon, in the order of their voters.
RULES = ("shouting", "exclamations", "insult near you")


def hashed_terms(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, text of each term, term): words, and beginnings and ends of words, each with a sort of its own."""
    shift = np.uint64(64 - BITS)
    for first, data, starts in chunks([t.lower().encode("utf-8", "surrogatepass") for t in texts]):
        rolling = Rolling(data)
        begin, end = edges(IN_WORD[data])
        owner = np.searchsorted(starts, begin, "right") - 1
        owners, terms = [owner], [rolling.spans(begin, end) >> shift]
        for n in AFFIXES:
            long = end - begin > n
            b, e = begin[long], end[long]
            owners += [owner[long], owner[long]]
            terms += [(rolling.spans(b, b + n) ^ np.uint64(n << 40)) >> shift, (rolling.spans(e - n, e) ^ np.uint64(n << 50)) >> shift]
        yield first, np.concatenate(owners), np.concatenate(terms).astype(np.int64)


def word_term(word: str) -> int:
    (_, _, terms), = hashed_terms([word])
    return int(terms[0])


def rule_votes(text: str, lexicon: set[str]) -> list[bool]:
    words = text.split()
    loud = sum(w.isupper() and len(w) > 3 for w in words)
    bare = [w.strip(".,;:!?\"'()").lower() for w in words]
    near = any(w in lexicon and {"you", "your", "you're", "u"} & set(bare[max(0, i - 3) : i + 4]) for i, w in enumerate(bare))
    return [loud * 4 > len(words) > 0, "!!!" in text, near]


class Voters:
    """Terms that vote for toxicity. A voter fires or is silent; built-in words, rules, and terms learned from labels."""

    def __init__(self, terms: np.ndarray) -> None:
        self.terms = terms
        self.index = np.full(1 << BITS, -1, np.int16)
        self.index[terms[::-1]] = np.arange(len(terms))[::-1]
        self.rules = len(terms)
        self.n = len(terms) + len(RULES)

    @classmethod
    def with_lexicon(cls, learned: np.ndarray) -> Voters:
        own = np.array([word_term(w) for w in LEXICON])
        return cls(np.concatenate([own, learned[~np.isin(learned, own)]]))

    def votes(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.n), bool)
        for first, owner, terms in hashed_terms(texts):
            voter = self.index[terms]
            hit = voter >= 0
            out[first + owner[hit], voter[hit]] = True
        lexicon = set(LEXICON)
        for i, t in enumerate(texts):
            out[i, self.rules :] = rule_votes(t, lexicon)
        return out


def learned_terms(terms: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Terms that mark toxic documents: by evidence against chance and by purity, the strongest first."""
    positive, negative = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
    for t, toxic in zip(terms, y, strict=True):
        (positive if toxic else negative)[t] += 1
    n1, n0 = max(1, y.sum()), max(1, len(y) - y.sum())
    seen = np.flatnonzero(positive)
    a, b = positive[seen].astype(float), negative[seen].astype(float)
    share = (a + b) / (n1 + n0)
    gain = 2 * (a * np.log(a / (share * n1)) + np.where(b > 0, b * np.log(np.maximum(b, 1) / (share * n0)), 0))
    pure = (a / n1) / (a / n1 + b / n0)
    good = (gain >= EVIDENCE) & (pure >= PURITY) & (a / n1 > b / n0)
    order = np.lexsort((seen[good], -gain[good]))[:MOST_VOTERS]
    return seen[good][order]


class LabelModel:
    """How often each voter fires in toxic and in other documents, which voters speak as one, and the class share.

    Rates are fitted by expectation maximisation on the votes of all sampled
    documents, starting from the labels that are known. Voters that agree beyond
    what the class explains share one voice: each counts by one over the size of
    its circle.
    """

    def __init__(self, votes: np.ndarray, y: np.ndarray, rounds: int = 8) -> None:
        x = votes.astype(float)
        prior = np.clip(y.astype(float), 0.02, 0.98)
        belief = prior.copy()
        n = len(y)
        self.share = float(np.clip(y.mean() if n else 0.1, 0.01, 0.99))
        for _ in range(rounds):
            w1, w0 = belief.sum(), n - belief.sum()
            self.fires = np.stack([((1 - belief) @ x + 0.05) / (w0 + 1), (belief @ x + 0.5) / (w1 + 1)])
            rate = belief @ x / max(w1, 1e-9), (1 - belief) @ x / max(w0, 1e-9)
            rest = np.concatenate([(x - rate[0]) * np.sqrt(belief)[:, None], (x - rate[1]) * np.sqrt(1 - belief)[:, None]])
            spread = rest.T @ rest
            scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
            self.correlation = spread / np.outer(scale, scale)
            tied = np.maximum(self.correlation, 0) * (self.correlation > TIED)
            np.fill_diagonal(tied, 1)
            self.weight = 1 / tied.sum(axis=1)
            # an observed label is one more, nearly certain, vote
            odds = self.logit(votes) + np.log(prior / (1 - prior))
            belief = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        self.belief = belief

    def logit(self, votes: np.ndarray) -> np.ndarray:
        fire = np.log(self.fires[1] / self.fires[0]) * self.weight
        silent = np.log((1 - self.fires[1]) / (1 - self.fires[0])) * self.weight
        return np.log(self.share / (1 - self.share)) + votes @ (fire - silent) + silent.sum()


def linear_classifier(votes: np.ndarray, target: np.ndarray, passes: int = 400, rate: float = 2.0, decay: float = 2e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels, by gradient descent on all rows at once."""
    x = votes.astype(float)
    w, c = np.zeros(x.shape[1]), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))) if len(x) else -2.0
    if not len(x):
        return w, c
    scale = 1 / np.sqrt(x.mean(axis=0) + 0.01)
    for _ in range(passes):
        p = 1 / (1 + np.exp(-np.clip(x @ w + c, -30, 30)))
        gap = (p - target) / len(x)
        w -= rate * scale * (x.T @ gap + decay * w)
        c -= rate * gap.sum()
    return w, c


def train(docs: DataFrame, labels: DataFrame, at_most: int = SAMPLE) -> tuple[Voters, np.ndarray, float]:
    texts = sample(docs, labels, "toxic", at_most)

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, y, rows = b["doc_id"].to_numpy(), b["y"].to_numpy(), []
            lists: dict[int, np.ndarray] = {i: np.zeros(0, np.int32) for i in range(len(b))}
            for first, owner, terms in hashed_terms(list(b["text"])):
                order = np.argsort(owner, kind="stable")
                owner, terms = owner[order], terms[order]
                for i in np.unique(owner):
                    lo, hi = np.searchsorted(owner, [i, i + 1])
                    lists[first + i] = np.unique(terms[lo:hi]).astype(np.int32)
            for i, t in lists.items():
                rows.append((ids[i], y[i], t.tobytes(), np.packbits(rule_votes(b["text"].iloc[i], set(LEXICON))).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "y", "terms", "rules"])

    rows = texts.mapInPandas(distinct, "doc_id bigint, y int, terms binary, rules binary").toPandas().sort_values(["doc_id", "terms"])
    y = rows["y"].to_numpy(int)
    terms = [np.frombuffer(t, np.int32) for t in rows["terms"]]
    voters = Voters.with_lexicon(learned_terms(terms, y))
    votes = np.zeros((len(y), voters.n), bool)
    for i, (t, rules) in enumerate(zip(terms, rows["rules"], strict=True)):
        voter = voters.index[t]
        votes[i, voter[voter >= 0]] = True
        votes[i, voters.rules :] = np.unpackbits(np.frombuffer(rules, np.uint8))[: len(RULES)]
    model = LabelModel(votes, y)
    return voters, *linear_classifier(votes, model.belief)


def score_toxicity(docs: DataFrame, labels: DataFrame, at_most: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Probability that a document is toxic, one row per input row.

    Voters are the words of a lexicon, rules, and words or beginnings or ends of
    words that labels show to mark toxic documents; labels come from at most
    ``at_most`` documents outside the held-out fifth. A generative model weighs
    the voters, and a linear classifier learns its posteriors. Whole texts are
    searched for votes, in training and in scoring.

    A null or empty text has no votes and gets the score of silence. Without
    usable labels only lexicon and rules vote. A document labelled twice counts
    as toxic if one label says so. Null ids are scored like any other; repeated
    rows get equal scores. An empty table gives an empty result. Other columns
    are ignored.
    """
    voters, weights, constant = train(docs, labels, at_most)
    if not weights.any():  # no labels: trust the lexicon
        weights, constant = np.full(voters.n, 3.0), -2.0
        weights[voters.rules : -1] = 0.5
    model = docs.sparkSession.sparkContext.broadcast((voters.terms, weights, constant))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms, weights, constant = model.value
        voters = Voters(terms)
        for b in batches:
            parts = [voters.votes(list(b["text"].iloc[k : k + 1000])) @ weights for k in range(0, len(b), 1000)]
            p = 1 / (1 + np.exp(-np.clip(np.concatenate([np.zeros(0), *parts]) + constant, -30, 30)))
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": p, "predicted": (p >= threshold).astype(np.int32)})

    rows = docs.select(id_text().alias("doc_id"), held_out().alias("held_out"), whole_text().alias("text"))
    return with_id(rows.mapInPandas(run, "doc_id string, held_out boolean, score double, predicted int"))
