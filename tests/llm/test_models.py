"""Parts of the two classifiers, each against its definition."""

import math
import random

import numpy as np
import pytest

from driftwell.llm import quality, toxicity


def loss(vectors, output, bias, y, ids, shares):
    logits = output @ (shares @ vectors[ids]) + bias
    return float(np.log(np.exp(logits - logits.max()).sum()) + logits.max() - logits[y])


def slope(f, at, h=1e-5):
    """Gradient of ``f`` at an array, by differences."""
    out = np.zeros(at.shape)
    for i in np.ndindex(at.shape):
        up, down = at.copy(), at.copy()
        up[i] += h
        down[i] -= h
        out[i] = (f(up) - f(down)) / (2 * h)
    return out


@pytest.mark.parametrize("y", [0, 1])
def test_a_step_follows_the_gradient(y):
    rng = np.random.default_rng(3)
    model = quality.Embeddings(bits=4, size=3)
    model.vectors = rng.normal(size=(16, 3))
    model.output, model.bias = rng.normal(size=(2, 3)), rng.normal(size=2)
    ids, shares, rate = np.array([1, 5, 9]), np.array([0.5, 0.25, 0.25]), 0.1
    v, o, b = model.vectors.copy(), model.output.copy(), model.bias.copy()
    model.fit(np.array([y]), [ids], [shares], passes=1, rate=rate)
    assert np.allclose(model.vectors, v - rate * slope(lambda x: loss(x, o, b, y, ids, shares), v), atol=1e-6)
    assert np.allclose(model.output, o - rate * slope(lambda x: loss(v, x, b, y, ids, shares), o), atol=1e-6)
    assert np.allclose(model.bias, b - rate * 0.1 * slope(lambda x: loss(v, o, x, y, ids, shares), b), atol=1e-6)


def test_training_lowers_the_loss_and_splits_the_classes():
    rng = np.random.default_rng(5)
    y = np.array([i % 2 for i in range(80)])
    ids = [np.unique(np.concatenate([rng.integers(0, 40, 5), [40 + 3 * c + rng.integers(0, 3)]])) for c in y]
    shares = [np.full(len(i), 1 / len(i), np.float32) for i in ids]
    model = quality.Embeddings(bits=6, size=4)
    total = lambda: sum(loss(model.vectors, model.output, model.bias, c, i, s) for c, i, s in zip(y, ids, shares, strict=True))
    before = total()
    model.fit(y, ids, shares, passes=30)
    assert total() < before / 4
    table, constant = model.table()
    assert all((s @ table[i] + constant > 0) == bool(c) for c, i, s in zip(y, ids, shares, strict=True))


def test_features_do_not_depend_on_neighbours():
    rng = random.Random(2)
    texts = ["", "a", "Ünï ünï", "x " * 50_000, "one two one\ttwo two"] + ["".join(rng.choices("ab ü\n", k=rng.randrange(60))) for _ in range(40)]
    rng.shuffle(texts)
    together = {}
    for first, owner, hashed in quality.features(texts):
        for o, h in zip(owner.tolist(), hashed.tolist(), strict=True):
            together.setdefault(first + o, []).append(h)
    for i, t in enumerate(texts):
        alone = [h for _, _, hashed in quality.features([t]) for h in hashed.tolist()]
        assert sorted(together.get(i, [])) == sorted(alone)
        words, size = t.lower().split(), len(t.lower().encode())
        # a word may be followed by the line end that stands after the text
        repeats = sum(max(0, len(words) - b) for b in quality.BACK)
        grams = len(alone) - len(words) - repeats
        assert sum(max(0, size - n + 1) for n in quality.GRAMS) <= grams <= sum(size + 1 for _ in quality.GRAMS)


def test_scores_are_the_softmax_of_the_mean():
    model = quality.Embeddings(seed=4)
    model.output = np.random.default_rng(1).normal(size=model.output.shape)
    model.bias[:] = 0.3, -0.2
    texts = ["some words here", "", "and others, und andere"]
    for t, got in zip(texts, quality.scores(texts, *model.table()), strict=True):
        hashed = np.concatenate([h for _, _, h in quality.features([t])])
        logits = model.output @ (model.vectors[hashed].mean(axis=0) if len(hashed) else np.zeros(model.output.shape[1])) + model.bias
        assert got == pytest.approx(np.exp(logits[1]) / np.exp(logits).sum(), abs=1e-5)


def simulated(n=6000, seed=8):
    """Votes of independent voters whose rates are known, one voter twice, and the classes."""
    rng = np.random.default_rng(seed)
    y = rng.random(n) < 0.3
    rates = np.array([[0.02, 0.6], [0.05, 0.5], [0.1, 0.7], [0.3, 0.3]])
    votes = rng.random((n, 4)) < np.where(y[:, None], rates[:, 1], rates[:, 0])
    return np.concatenate([votes, votes[:, :1]], axis=1), y.astype(int), rates


def test_label_model_finds_rates_and_voices():
    votes, y, rates = simulated()
    model = toxicity.LabelModel(votes, y)
    assert np.allclose(model.fires[:, :4].T, rates, atol=0.03)
    assert model.correlation[0, 4] == pytest.approx(1, abs=1e-6)
    assert model.weight[[0, 4]] == pytest.approx(0.5, abs=0.02) and (model.weight[1:4] > 0.95).all()
    # two copies of a voter say no more than one, and the posterior is that of the true rates
    single = toxicity.LabelModel(votes[:, :4], y)
    assert np.allclose(model.logit(votes), single.logit(votes[:, :4]), atol=0.15)
    true = np.log(0.3 / 0.7) + np.where(votes[:, :4], np.log(rates[:, 1] / rates[:, 0]), np.log((1 - rates[:, 1]) / (1 - rates[:, 0]))).sum(axis=1)
    assert np.corrcoef(true, model.logit(votes))[0, 1] > 0.99


def test_label_model_outvotes_wrong_labels():
    votes, y, _ = simulated()
    wrong = np.random.default_rng(4).random(len(y)) < 0.05
    model = toxicity.LabelModel(votes, np.where(wrong, 1 - y, y))
    strong = votes[:, :3].all(axis=1) & (y == 1) & wrong
    assert strong.any() and (model.belief[strong] > 0.5).all()


def test_label_model_of_nothing():
    model = toxicity.LabelModel(np.zeros((0, 3), bool), np.zeros(0, int))
    assert np.isfinite(model.logit(np.zeros((1, 3), bool))).all()


def test_linear_classifier_follows_its_targets():
    rng = np.random.default_rng(6)
    x = rng.random((4000, 3)) < 0.4
    target = 1 / (1 + np.exp(-(x @ np.array([2.0, -1.0, 0.0]) - 0.5)))
    w, c = toxicity.linear_classifier(x, target, decay=0.0)
    assert np.allclose(w, [2, -1, 0], atol=0.05) and c == pytest.approx(-0.5, abs=0.05)
    assert toxicity.linear_classifier(np.zeros((0, 2), bool), np.zeros(0))[0].tolist() == [0, 0]


def test_learned_terms_against_counts():
    rng = np.random.default_rng(9)
    y = (rng.random(600) < 0.4).astype(int)
    terms = []
    for toxic in y:
        own = set(rng.integers(0, 30, 6).tolist())
        own |= {100} if toxic and rng.random() < 0.5 else set()
        own |= {101} if rng.random() < (0.5 if toxic else 0.02) else set()
        own |= {102} if rng.random() < (0.3 if toxic else 0.2) else set()
        terms.append(np.array(sorted(own)))
    n1, n0, want = y.sum(), len(y) - y.sum(), {}
    for t in {int(x) for ts in terms for x in ts}:
        a = sum(t in ts for ts, c in zip(terms, y, strict=True) if c)
        b = sum(t in ts for ts, c in zip(terms, y, strict=True) if not c)
        if not a:
            continue
        share = (a + b) / len(y)
        gain = 2 * (a * math.log(a / (share * n1)) + (b * math.log(b / (share * n0)) if b else 0))
        if gain >= toxicity.EVIDENCE and (a / n1) / (a / n1 + b / n0) >= toxicity.PURITY and a / n1 > b / n0:
            want[t] = gain
    assert set(want) == {100, 101}
    assert toxicity.learned_terms(terms, y).tolist() == sorted(want, key=lambda t: (-want[t], t))
