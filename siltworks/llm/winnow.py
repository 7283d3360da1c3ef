"""Content-defined anchors of texts, by the least hash in each window.

Every window of ``window`` bytes has one anchor: the place of the least hash, of 40 bits, among
the grams of half its length that it contains, the leftmost if several are least. Equal
windows have equal anchors at equal distances, so only the few anchors need comparing.
"""

from __future__ import annotations

import numpy as np

from siltworks.llm.words import _BYTE_VALUES, mix, prefix_hash, run_hash, span_hash


# Places in what is read of a text at once take so many bits, hashes the others.
PLACE_BITS = 24


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost place of the least value in each run of ``width`` values, which fit in 40 bits.

    A value and its place are one number, so the least of all runs takes a few passes without lookups.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    if n > 1 << PLACE_BITS:
        raise ValueError(f"{n} values in one piece of a text")
    least = values.astype(np.uint64) << np.uint64(PLACE_BITS) | np.arange(n, dtype=np.uint64)
    span = 1
    # Doubling: the least of 2s values is the lesser of two runs of s; then one overlap.
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)


class Anchors:
    """Windows that start in [low, high) of a text, and their anchors.

    Windows that hold the end of the text do not exist. A long text is read in pieces; what
    an anchor's windows can reach belongs to the piece, so pieces agree on every anchor.
    """

    def __init__(self, text: bytes, window: int, low: int, high: int):
        self.window, gram = window, window // 2
        reach = window - gram
        high = max(min(high, len(text) - window + 1), low)
        base, end = max(low - reach, 0), min(high + reach + window, len(text))
        data = np.frombuffer(text, np.uint8, end - base, base)
        sums = prefix_hash(_BYTE_VALUES[data])
        grams = run_hash(sums, low - base, high - base + reach if high > low else low - base, gram)
        of_window = sliding_argmin(grams >> np.uint64(PLACE_BITS), reach + 1)
        # Leftmost least places never go back, so an anchor's windows follow each other.
        first = np.flatnonzero(np.diff(of_window, prepend=-1))
        places, count = of_window[first], np.diff(first, append=len(of_window))
        #: Least hashes lie at the low end; mixed once more, they fill even ranges evenly.
        self.hashes = mix(grams[places])
        # Of each anchor: its place in the text, its first window and their number.
        self.places, self.first, self.count = places + low, first + low, count
        left = np.maximum(self.places - reach, 0)
        right = np.minimum(self.places + window, len(text))
        edges = mix(((self.places - left) << 32 | (right - self.places)).astype(np.uint64))
        #: Hashes of all bytes that windows of an anchor can reach, and of where they end.
        self.contexts = mix(span_hash(sums, left - base, right - base) + edges)
