"""The learned models' forward and backward steps against plain ones."""

import math

import numpy as np

from siltworks.llm import language, quality


def plain_score(net, bag):
    """One bag through gated attention, passage by passage."""
    weights, hidden = [], []
    for passage in bag.astype(float):
        own = np.tanh(passage @ net.encode.astype(float))
        seen = np.tanh(own @ net.view.astype(float))
        gate = 1 / (1 + np.exp(-(own @ net.gate.astype(float))))
        hidden.append(own)
        weights.append(math.exp(float((seen * gate) @ net.attend.astype(float))))
    pooled = sum(w * h for w, h in zip(weights, hidden)) / sum(weights)
    return 1 / (1 + math.exp(-(pooled @ net.output.astype(float) + float(net.bias[0]))))


def bags_of(seed, sizes):
    rng = np.random.default_rng(seed)
    return [rng.random((n, quality.BUCKETS + quality.SHARES)).astype(np.float32) for n in sizes]


def assert_descends(before, after, loss, seed, tries=12):
    """The first step of Adam moves each weight against the sign of its gradient."""
    rng, checked = np.random.default_rng(seed), 0
    for old, new in zip(before, after):
        for _ in range(tries):
            at = tuple(rng.integers(0, n) for n in old.shape)
            kept = float(old[at])
            slopes = []
            for sign in (1, -1):
                old[at] = kept + sign * 1e-3
                slopes.append(loss())
            old[at] = kept
            slope = (slopes[0] - slopes[1]) / 2e-3
            if abs(slope) > 2e-4:
                assert np.sign(new[at] - kept) == -np.sign(slope)
                checked += 1
    assert checked > 2 * len(before)


def test_quality_forward():
    bags = bags_of(1, [1, 3, 7, 2])
    net = quality.train(bags, np.array([0, 1, 1, 0], np.float32), epochs=2)
    first = np.append(0, np.cumsum([len(b) for b in bags]))
    found = net.forward(np.concatenate(bags), first)[0]
    assert np.allclose(found, [plain_score(net, bag) for bag in bags], atol=1e-4)


def test_quality_backward():
    bags, labels = bags_of(2, [1, 4, 2, 5, 3]), np.array([0, 1, 1, 0, 1], np.float32)
    net = quality.train(bags, labels, epochs=0)

    def loss():
        scores = [plain_score(net, bag) for bag in bags]
        return -sum(math.log(s if label else 1 - s) for s, label in zip(scores, labels)) / len(bags)

    stepped = quality.train(bags, labels, epochs=1)
    assert_descends(net.weights(), stepped.weights(), loss, 3)


def plain_logs(net, window):
    """One window through filters, their greatest values and a softmax, filter by filter."""
    embedded = net.embedding.astype(float)[window]
    features = []
    for bank in net.banks:
        width = len(bank) // language.EMBEDDING
        for column in bank.astype(float).T:
            at = [embedded[i : i + width].reshape(-1) @ column for i in range(len(window) - width + 1)]
            features.append(max(at))
    pooled = np.maximum(np.array(features) + net.bias.astype(float), 0)
    logits = pooled @ net.dense.astype(float) + net.dense_bias.astype(float)
    return logits - math.log(sum(math.exp(x) for x in logits))


def weights_of(net):
    return [net.embedding, *net.banks, net.bias, net.dense, net.dense_bias]


def windows_of(seed):
    rng = np.random.default_rng(seed)
    return rng.integers(97, 103, (6, 24)).astype(np.uint8), ["a", "b", "c", "a", "b", "c"]


def test_language_forward():
    windows, labels = windows_of(4)
    net = language.train(windows, labels, epochs=2)
    found = net.log_probabilities(net.maxima(windows))
    assert np.allclose(found, [plain_logs(net, window) for window in windows], atol=1e-3)


def test_language_backward():
    windows, labels = windows_of(5)
    net = language.train(windows, labels, epochs=0)

    def loss():
        return -sum(plain_logs(net, w)[net.labels.index(x)] for w, x in zip(windows, labels)) / len(labels)

    stepped = language.train(windows, labels, epochs=1)
    before, after = weights_of(net), weights_of(stepped)
    # Bytes that no window holds have no gradient.
    before[0], after[0] = before[0][97:103], after[0][97:103]
    assert_descends(before, after, loss, 6, tries=8)
