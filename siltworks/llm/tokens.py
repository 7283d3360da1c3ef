"""Token ids of texts inside a task."""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

from siltworks.llm.frames import one_thread
from siltworks.llm.words import Words, space_words

# Where a tokenizer's file is: a path, or a function that finds it where the task runs.
Vocabulary = str | Callable[[], str]

# Tokens of known words that a worker keeps before it starts afresh.
KNOWN_TOKENS = 4_000_000

# The cutting rule of a tokenizer whose words can be encoded one by one.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


def word_vocabulary() -> str:
    """The place of the public word tokenizer's file on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def cuts_words(tokenizer) -> bool:
    """Whether the tokenizer normalises and cuts texts by the rule that ``WordTokens`` relies on."""
    settings = json.loads(tokenizer.to_str())
    normalizer, cutter = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    steps = normalizer.get("normalizers", [])
    cuts = cutter.get("pretokenizers", [])
    return (
        [step["type"] for step in steps] == WORD_NORMALIZERS
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and [cut["type"] for cut in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"] == {"Regex": WORD_PATTERN}
        and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
        and not cuts[1]["add_prefix_space"]
        and settings.get("post_processor") is None
        and not any(token["lstrip"] or token["rstrip"] for token in settings["added_tokens"])
    )


class PlainTokens:
    """Ids of texts by any tokenizer, text by text."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch(
            [(text or b"").decode() for text in texts], add_special_tokens=False
        )
        return [np.array(one.ids, np.uint32) for one in encoded]


class WordTokens:
    """Ids of texts by a tokenizer that never joins what blanks or its word rule part.

    Each distinct word is encoded once. Words are cut between an ASCII letter and ASCII
    punctuation other than an apostrophe, where the tokenizer's own rule always cuts. Only for
    tokenizers that :func:`cuts_words` tells to be of that kind.
    """

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content.encode() for token in special]
        self.letter = np.zeros(256, bool)
        self.letter[0x61:0x7B] = True
        self.mark = np.zeros(256, bool)
        for low, high in ((0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
            self.mark[low:high] = True
        self.mark[ord("'")] = False
        self._forget()

    def _forget(self) -> None:
        # Hashes of the known words in ascending order, and where each word's ids are. Numbers in
        # arrays, as a dictionary of a million words takes some 200 MB in every worker.
        self.hashes = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.offsets = np.zeros(1 << 12, np.int64)
        self.flat = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _plain(self, text: bytes) -> np.ndarray:
        return np.array(
            self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32
        )

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Encode new words, whose hashes are ascending and not known yet."""
        known = len(self.hashes)
        for at in range(0, len(words), 1024):
            part = words[at : at + 1024]
            # Blanks part words, so many are encoded as one text and told apart by offsets.
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(encoded.ids, np.uint32)
            sizes = np.fromiter(map(len, part), np.int64, len(part))
            at_char = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(ids))
            of = np.searchsorted(np.cumsum(sizes + 1), at_char, "right")
            lengths = np.bincount(of, minlength=len(part))
            slot = known + at
            self.lengths = _room(self.lengths, slot + len(part))
            self.offsets = _room(self.offsets, slot + len(part))
            self.flat = _room(self.flat, self.used + len(ids))
            self.lengths[slot : slot + len(part)] = lengths
            self.offsets[slot : slot + len(part)] = self.used + np.cumsum(lengths) - lengths
            self.flat[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        places = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, places, hashes)
        self.slots = np.insert(self.slots, places, np.arange(known, known + len(words)))

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        if self.used > KNOWN_TOKENS:
            self._forget()
        words = Words(texts, space_words())
        cut = np.flatnonzero(self.letter[words.data[:-1]] & self.mark[words.data[1:]]) + 1
        starts = np.sort(np.concatenate([words.starts, cut]))
        ends = np.sort(np.concatenate([words.ends, cut]))
        words.starts, words.ends = starts, ends
        hashes, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        places = first[new]
        self._learn(
            hashes[new],
            [words.bytes[a:b].decode() for a, b in zip(starts[places].tolist(), ends[places].tolist())],
        )
        slots = self.slots[np.searchsorted(self.hashes, hashes)][which]
        lengths = self.lengths[slots]
        ends_at = np.cumsum(lengths)
        take = np.repeat(self.offsets[slots] - (ends_at - lengths), lengths)
        take += np.arange(len(take))
        ids = self.flat[take]
        edges = np.append(0, ends_at)[np.searchsorted(starts, words.offsets)]
        result = np.split(ids, edges[1:]) if len(texts) else []
        for row, text in enumerate(texts):
            if text and any(token in text for token in self.special):
                result[row] = self._plain(text)
        return result


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger


_encoders: dict[str, WordTokens | PlainTokens] = {}


def encoder_of(vocabulary: Vocabulary) -> WordTokens | PlainTokens:
    """The task's encoder for a tokenizer; loaded once by a worker."""
    path = vocabulary if isinstance(vocabulary, str) else vocabulary()
    if path not in _encoders:
        one_thread()
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _encoders[path] = (WordTokens if cuts_words(tokenizer) else PlainTokens)(tokenizer)
    return _encoders[path]
