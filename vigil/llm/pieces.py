"""Pre-tokenisation shared by the token operators: the matches of a pattern, exactly as the tokenizer libraries cut them.

The ``regex`` module is several times faster than a library's own splitter, but
the two may come with different Unicode versions. The code points on which
they disagree are found by asking both, once a process; a text with one of
them is cut by the library.
"""

from __future__ import annotations

from functools import lru_cache

import regex
from tokenizers import Regex, pre_tokenizers


@lru_cache(maxsize=1)
def _disputed() -> regex.Pattern | None:
    """A class of the code points that the two engines class differently as letter, number or space."""
    everything = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    bad: set[int] = set()
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        ours = {m.start() for m in regex.finditer(name, everything)}
        gaps = pre_tokenizers.Split(Regex(name + "+"), "removed").pre_tokenize_str(everything)
        theirs = set(range(len(everything)))
        for _, (a, b) in gaps:
            theirs.difference_update(range(a, b))
        bad |= ours ^ theirs
    if not bad:
        return None
    spots = sorted(ord(everything[k]) for k in bad)
    spans, start = [], spots[0]
    for a, b in zip(spots, spots[1:] + [-1]):
        if b != a + 1:
            spans.append((start, a))
            start = b
    return regex.compile("[" + "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in spans) + "]")


class Splitter:
    """Cuts a text into the matches of ``pattern`` (which must match every character)."""

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall
        self.exact = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.disputed = _disputed()

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or self.disputed is None or self.disputed.search(text) is None:
            return self.find(text)
        return [text[a:b] for _, (a, b) in self.exact.pre_tokenize_str(text)]


@lru_cache(maxsize=1)
def byte_chars() -> dict[int, str]:
    """The customary byte-to-character table of byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(rest)}}
