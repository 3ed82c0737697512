"""The ordinal regression against plain loops with numeric gradients."""

import math
import random

import numpy as np
import pytest

from marketvane.llm import toxicity


def sample():
    rng = random.Random(6)
    bad, plain = [f"bad{k}" for k in "abcdefgh"], [f"word{k}" for k in "abcdefghijklmnop"]
    texts, labels = [], []
    for k in range(90):
        toxic = k % 3 == 0
        own = rng.sample(plain, 6) + (rng.sample(bad, rng.randint(1, 8)) if toxic else rng.sample(bad, 1) if k % 10 == 1 else [])
        texts.append(own)
        labels.append(toxic)
    return texts, labels


def plain_fit(texts, labels):
    """Telling words by their likelihood ratio, then Adam on the numeric gradient of the penalized likelihood."""
    vocabulary = sorted({w for t in texts for w in t})
    n, n_toxic = len(texts), sum(labels)
    telling = []
    for w in vocabulary:
        a = sum(w in t for t, y in zip(texts, labels) if y)
        b = sum(w in t for t, y in zip(texts, labels) if not y)
        rate, p, q = (a + b + 1) / (n + 2), (a + 0.5) / (n_toxic + 1), (b + 0.5) / (n - n_toxic + 1)
        ratio = 2 * (
            a * math.log(p / rate) + (n_toxic - a) * math.log((1 - p) / (1 - rate))
            + b * math.log(q / rate) + (n - n_toxic - b) * math.log((1 - q) / (1 - rate))
        )
        if ratio >= toxicity.TELLING and p > q and a >= toxicity.LEAST_DOCS:
            telling.append(w)
    has = np.array([[w in t for w in telling] for t in texts], float)
    grade = [1 + sum(row.sum() >= g for g in toxicity.GRADES) if y else 0 for row, y in zip(has, labels)]

    def thresholds(value):
        t = [value[len(telling)]]
        for step in value[len(telling) + 1 :]:
            t.append(t[-1] + math.exp(step))
        return t

    def loss(value):
        t = [-math.inf, *thresholds(value), math.inf]
        total = 0.0
        for x, g in zip(has @ value[: len(telling)], grade):
            high = 1.0 if t[g + 1] == math.inf else 1 / (1 + math.exp(x - t[g + 1]))
            low = 0.0 if t[g] == -math.inf else 1 / (1 + math.exp(x - t[g]))
            total -= math.log(high - low)
        return total / len(texts) + toxicity.RIDGE / 2 * float(value[: len(telling)] @ value[: len(telling)]) / len(telling)

    value = np.concatenate([np.zeros(len(telling)), [1.0], np.zeros(len(toxicity.GRADES))])
    moment, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, toxicity.STEPS + 1):
        slope = np.zeros_like(value)
        for k in range(len(value)):
            moved = np.zeros_like(value)
            moved[k] = 1e-5
            slope[k] = (loss(value + moved) - loss(value - moved)) / 2e-5
        moment, square = 0.9 * moment + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        value = value - toxicity.RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-10)
    return dict(zip(telling, value[: len(telling)])), thresholds(value)


def hashed(words):
    return toxicity.words(" ".join(words).encode())


def test_fit_equals_plain_loops():
    texts, labels = sample()
    model = toxicity.fit([hashed(t) for t in texts], np.array(labels))
    weights, thresholds = plain_fit(texts, labels)
    assert len(weights) == len(model.features) >= 5
    got = dict(zip(model.features.tolist(), model.weights.tolist()))
    for word, weight in weights.items():
        assert got[int(hashed([word])[0])] == pytest.approx(weight, abs=0.02)
    assert model.thresholds.tolist() == pytest.approx(thresholds, abs=0.02) and sorted(thresholds) == thresholds
    for text in texts[:20]:
        x = sum(weights.get(w, 0.0) for w in text)
        upto = [0.0, *(1 / (1 + math.exp(x - t)) for t in thresholds), 1.0]
        want = sum(k * (upto[k + 1] - upto[k]) for k in range(len(upto) - 1))
        odds = model.grades(np.array([model.evidence(hashed(text))]))
        assert float(odds[0] @ np.arange(odds.shape[1])) == pytest.approx(want, abs=0.02) and odds.sum() == pytest.approx(1)
