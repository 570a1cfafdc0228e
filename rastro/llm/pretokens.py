"""Byte-level BPE text by text: words of the pattern, cached by worker."""

from __future__ import annotations

import re

import regex

# The word pattern of byte-level BPE, here for all of Unicode and, much faster,
# for texts whose characters all are below U+0100.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACE = "\t-\r \x85\xa0"
NARROW_PATTERN = (
    rf" ?[{LETTER}]+|'(?:[stmd]|re|ve|ll)| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)

_WIDE = regex.compile(PATTERN)
_NARROW = re.compile(NARROW_PATTERN)
_BEYOND = re.compile("[^\x00-\xff]")
_CUT = re.compile(r"\S(?=[ \n])")

#: Characters that are split into words at a time.
PIECE = 1 << 20


def pieces(text: str, size: int = PIECE):
    """The text in parts that can be split one by one: a word never reaches over the end of
    a non-space followed by a space."""
    low = 0
    while len(text) - low > size:
        cut = _CUT.search(text, low + size)
        if cut is None:
            break
        yield text[low : cut.end()]
        low = cut.end()
    yield text[low:] if low else text


def words_of(text: str) -> list[str]:
    return (_WIDE if _BEYOND.search(text) else _NARROW).findall(text)


class Cache(dict):
    """What a function gives for a word, for the words met of late.

    Two generations of at most ``size`` words each: when the young one is full, the old one
    goes, and words still in use move up again. So memory is bounded at any corpus size.
    """

    def __init__(self, function, size: int = 150_000, longest: int = 64) -> None:
        self.function, self.size, self.longest, self.old = function, size, longest, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.function(word)
            if len(word) > self.longest:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value
