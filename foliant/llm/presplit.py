"""Vectorised pre-splitting of text into tokenizer words by character class."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
# The characters of \s in the tokenizers' patterns.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The suffixes that the patterns split off after an apostrophe.
SUFFIXES = ["s", "t", "re", "ve", "m", "ll", "d"]


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    first = np.array([ord(unicodedata.category(chr(c))[0]) for c in range(0x110000)], np.uint8)
    table[first == ord("L")] = LETTER
    table[first == ord("N")] = NUMBER
    table[WHITE] = SPACE
    return table


def _suffix_length(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Letters of the suffix that follows each apostrophe; 0: none."""
    n = len(points)
    one = np.where(at + 1 < n, points[np.minimum(at + 1, n - 1)], 0)
    two = np.where(at + 2 < n, points[np.minimum(at + 2, n - 1)], 0)
    out = np.zeros(len(at), np.int64)
    for s in SUFFIXES:
        hit = one == ord(s[0])
        if len(s) > 1:
            hit &= two == ord(s[1])
        out = np.where((out == 0) & hit, len(s), out)
    return out


def _cut_suffixes(points, kind, start, spaced: bool):
    """Joins apostrophe and suffix to one word, in ``start``; ``spaced``: a space before takes the apostrophe."""
    at = np.flatnonzero(points == ord("'"))
    if not len(at):
        return
    ok = start[at] & (np.append(kind[1:], SPACE)[at] == LETTER)
    if spaced:
        ok &= (at == 0) | (points[np.maximum(at - 1, 0)] != 0x20)
    at = at[ok]
    size = _suffix_length(points, at)
    at, size = at[size > 0], size[size > 0]
    start[at + 1] = False
    after = at + 1 + size
    after = after[after < len(points)]
    start[after[kind[after] == LETTER]] = True


def spaced_words(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Starts of the words of the byte-level pattern: every character is in one word, a space leads the next word.

    ``first``: True at the first character of each document.
    """
    kind = classes()[points]
    same = np.empty(len(points), bool)
    same[:1] = False
    same[1:] = kind[1:] == kind[:-1]
    same[first] = False
    blank = points == 0x20
    led = np.empty(len(points), bool)
    led[:1] = False
    led[1:] = blank[:-1]
    led[first] = False
    white = kind == SPACE
    start = np.where(white, ~same, ~same & ~led)
    # the last white character before other text stands apart from those before it
    follows = np.empty(len(points), bool)
    follows[-1:] = False
    follows[:-1] = ~white[1:] & ~first[1:]
    start |= white & follows
    start[first] = True
    # documents must not lend each other an apostrophe's neighbours
    cut = points.copy()
    lone = np.flatnonzero(first)
    lone = lone[lone > 0] - 1
    quote = lone[points[lone] == ord("'")]
    cut[quote] = 0
    edge = cut.copy()
    edge[lone[points[lone] == 0x20]] = 0
    _cut_suffixes(edge, kind, start, True)
    start[first] = True
    return start


def bare_words(points: np.ndarray):
    """Starts and ends (in code points) of the words of the lower-case pattern; white space is dropped.

    Documents must be separated by white space.
    """
    kind = classes()[points]
    start = np.empty(len(points), bool)
    start[:1] = True
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    _cut_suffixes(points, kind, start, False)
    at = np.flatnonzero(start)
    end = np.append(at[1:], len(points))
    word = kind[at] != SPACE
    return at[word], end[word]
