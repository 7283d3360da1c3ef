"""Texts as byte arrays inside a task: words, their hashes, and blocks of rows.

The texts of a block are joined with a space between them, so a whole block is scanned
by a few array operations, whatever the number and length of its texts. Hashes only
find candidates or name words; they are 64 bits of a polynomial over random bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BLOCK_BYTES = 1 << 21

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256).astype(np.uint64) | np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def space_words() -> np.ndarray:
    """Bytes of words that run between blanks and line ends: ``[^\\x20\\x09-\\x0D]``."""
    table = np.ones(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = False
    return table


def name_words() -> np.ndarray:
    """Bytes of lower-case words of letters and digits; all of a non-ASCII character count."""
    table = np.ones(256, bool)
    table[:0x80] = False
    table[0x30:0x3A] = True
    table[0x61:0x7B] = True
    return table


def blocks(texts: Sequence[bytes | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; a longer text is a range of its own."""
    start = size = 0
    for row, text in enumerate(texts):
        length = len(text) if text else 0
        if row > start and size + length > limit:
            yield start, row
            start, size = row, 0
        size += length
    if start < len(texts):
        yield start, len(texts)


class Words:
    """The words of a block: byte ranges in ``data`` and the text each belongs to."""

    def __init__(self, texts: Sequence[bytes | None], table: np.ndarray, lower: bool = True):
        joined = b" ".join(text or b"" for text in texts)
        self.bytes = joined.lower() if lower else joined
        self.data = np.frombuffer(self.bytes, np.uint8)
        edges = np.diff(table[self.data].astype(np.int8), prepend=0, append=0)
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)
        lengths = np.fromiter((len(text) if text else 0 for text in texts), np.int64, len(texts))
        offsets = np.cumsum(lengths + 1) - lengths - 1
        # Of text i: words first[i] to first[i + 1].
        self.first = np.append(np.searchsorted(self.starts, offsets), len(self.starts))
        self.offsets = offsets

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        sums = prefix_hash(_BYTE_VALUES[self.data])
        return span_hash(sums, self.starts, self.ends)

    def joined(self, first: int, end: int) -> bytes:
        """Words first to end with one space between them."""
        return b" ".join(
            self.bytes[self.starts[i] : self.ends[i]] for i in range(first, end)
        )


def _power(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:size]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Running polynomial of ``values``; :func:`span_hash` reads ranges of it."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges, equal for equal values wherever the range lies."""
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(sums))[starts])


def run_hash(sums: np.ndarray, start: int, end: int, size: int) -> np.ndarray:
    """:func:`span_hash` of the ranges of ``size`` values that begin from ``start`` to ``end``, one after the other."""
    own = sums[start + size : end + size] - sums[start:end]
    return mix(own * _power(_INVERSE, len(sums))[start:end])


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64 bits so that any of them may pick a partition or a bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))
