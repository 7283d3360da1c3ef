"""Suffix arrays by the difference cover modulo three, in numpy."""

from __future__ import annotations

import numpy as np

COVER = 3


def _names(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names 1, 2, ... of sorted keys, equal for equal keys, in the keys' own places."""
    ranked = keys[order]
    names = np.empty(len(keys), np.int64)
    names[order] = np.cumsum(np.append(1, ranked[1:] != ranked[:-1]))
    return names


def _pairs(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """One number for each pair, ascending with it."""
    width = int(low.max(initial=0)) + 1
    if (int(high.max(initial=0)) + 1) * width < 1 << 62:
        return high * width + low
    return _dense(high) * width + low


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of all suffixes in their order. ``text`` holds numbers from 1.

    Suffixes that start at places 1 and 2 modulo 3 are sorted by their triples; where names
    repeat, the names in the order of the places are sorted in turn; the other suffixes
    are sorted by a symbol and the rank of the next suffix, and merged in.
    """
    n = len(text)
    if n < COVER:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), np.int64)
    padded = np.append(text, [0, 0, 0])
    # With a length of 1 modulo 3 the empty suffix takes part, so that the two classes part.
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    triples = _pairs(_pairs(padded[sample], padded[sample + 1]), padded[sample + 2])
    order = np.argsort(triples, kind="stable")
    names = _names(triples, order)
    rank = np.zeros(n + 3, np.int64)
    if names.max() == len(names):
        rank[sample] = names
        sample = sample[order]
    else:
        sample = sample[suffix_array(names)]
        rank[sample] = np.arange(1, len(sample) + 1)
    sample = sample[sample < n]

    def with_next(at: np.ndarray) -> np.ndarray:
        return _pairs(padded[at], rank[at + 1])

    def with_second(at: np.ndarray) -> np.ndarray:
        return _pairs(_pairs(padded[at], padded[at + 1]), rank[at + 2])

    zeros = np.arange(0, n, 3)
    zeros = zeros[np.argsort(with_next(zeros), kind="stable")]
    # How many sampled suffixes of either class come before each of the others.
    before = np.zeros(len(zeros), np.int64)
    for of_class, keys_of in ((1, with_next), (2, with_second)):
        own = sample[sample % 3 == of_class]
        keys = keys_of(np.concatenate([zeros, own]))
        before += np.searchsorted(keys[len(zeros) :], keys[: len(zeros)])
    result = np.empty(n, np.int64)
    places = np.arange(len(zeros)) + before
    taken = np.zeros(n, bool)
    taken[places] = True
    result[places] = zeros
    result[~taken] = sample
    return result


def equal_prefixes(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """A group number for each of the places, equal where ``depth`` symbols are.

    ``places`` come in the order of the suffix array; only neighbours are compared.
    """
    same = np.zeros(len(places), bool)
    step = 1 << 16
    rows = np.lib.stride_tricks.sliding_window_view(text, depth)
    for at in range(1, len(places), step):
        end = min(at + step, len(places))
        same[at:end] = (rows[places[at:end]] == rows[places[at - 1 : end - 1]]).all(axis=1)
    return np.cumsum(~same)
