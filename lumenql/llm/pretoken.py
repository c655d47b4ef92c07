"""Splitting texts into the pre-tokens of a tokenizer file, with a fast way for plain Latin texts.

The file's own normalizer and pre-tokenizer define the result. A text made of printable
characters below U+0250 (which its normalization leaves as they are, but for case and
white space) is split by an equal regular expression instead; all others, and those with
a capital whose lower case lies at or above U+0250, go through the library.
"""

from __future__ import annotations

import re
import unicodedata

from tokenizers import Tokenizer

_LIMIT = 0x250


def _ranges(points) -> str:
    return "".join(re.escape(chr(p)) for p in points)


_PLAIN = [p for p in range(0xA1, _LIMIT) if p not in (0xAD, 0x130) and ord(chr(p).lower()) < _LIMIT]
_LETTERS = _ranges(p for p in _PLAIN if unicodedata.category(chr(p))[0] == "L")
_NUMBERS = _ranges(p for p in _PLAIN if unicodedata.category(chr(p))[0] == "N")
#: The contractions that the tokenizer's pattern names.
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: Texts that the fast way serves.
PLAIN = re.compile(rf"[\t\n\r\x20-\x7E{_ranges(_PLAIN)}]*")
#: A contraction starts with an apostrophe, so letters may be tried first.
_SPLIT = re.compile(rf"[a-z{_LETTERS}]+|{_CONTRACTIONS}|[0-9{_NUMBERS}]|[^\s a-z0-9{_LETTERS}{_NUMBERS}]+")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(spare)) for b in range(256)}


class Cache(dict):
    """Key -> ``make(key)``, filled on demand, in two generations of ``size`` entries.

    When the young generation is full it becomes the old one, and the old one goes; what
    is asked for again moves to the young. Frequent keys stay and memory is bounded.
    """

    def __init__(self, make, size: int):
        super().__init__()
        self._make, self._size, self._old = make, size, {}

    def __missing__(self, key):
        found = self._old.get(key)
        if found is None:
            found = self._make(key)
        if len(self) >= self._size:
            self._old = dict(self)
            self.clear()
        self[key] = found
        return found


class Splitter:
    """Cuts a text into special tokens and pre-tokens, as the tokenizer file says."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self._marks = [t for t in self.special]
        self._letter = byte_alphabet()
        self._byte = {c: b for b, c in self._letter.items()}

    def letters(self, word: str) -> str:
        """A pre-token in the vocabulary's byte characters."""
        return word if word.isascii() and word.isprintable() else "".join([self._letter[b] for b in word.encode("utf-8")])

    def plain(self, text: str) -> list[str] | None:
        """Pre-tokens of a text without special tokens, or None if the library has to split it."""
        if not PLAIN.fullmatch(text):
            return None
        return _SPLIT.findall(text.lower())

    def exact(self, text: str) -> list[str]:
        """The same from the library: pre-tokens as normalized text."""
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return [bytes(self._byte[c] for c in part).decode("utf-8") for part, _ in parts]

    def pieces(self, text: str):
        """Alternates lists of pre-tokens and ids of special tokens, in order."""
        if any(mark in text for mark in self._marks):
            at = 0
            for m in self._special.finditer(text):
                yield self._split(text[at : m.start()])
                yield self.special[m[0]]
                at = m.end()
            text = text[at:]
        yield self._split(text)

    def _split(self, text: str) -> list[str]:
        found = self.plain(text)
        return self.exact(text) if found is None else found
