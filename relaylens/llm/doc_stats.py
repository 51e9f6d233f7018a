"""Counts over one whole text, shared by the quality operators.

Words are runs of characters other than space and \\t\\n\\v\\f\\r; a null text has none.
"""

from __future__ import annotations

import numpy as np

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WIDTH = 8

#: Character classes by byte of the UTF-8 text. A character above U+007F counts at its first
#: byte, by the script range that this byte stands for; its other bytes count nowhere.
CLASSES = ("vowel", "consonant", "upper", "digit", "space", "newline", "stop", "quote", "symbol", "control",
           "latin1", "latin_more", "two_byte", "three_byte", "four_byte")


def _class_of(byte: int) -> int | None:
    c = chr(byte)
    if byte < 0x80:
        name = ("vowel" if c in "aeiou" else "consonant" if c.islower() else "upper" if c.isupper()
                else "digit" if c.isdigit() else "space" if c in " \t" else "newline" if c in SPACES
                else "stop" if c in ".,;:!?" else "quote" if c in "'\"()-" else "symbol" if c.isprintable() else "control")
    elif byte < 0xC0:
        return None
    else:
        name = ("latin1" if byte < 0xC4 else "latin_more" if byte < 0xCA else "two_byte" if byte < 0xE0
                else "three_byte" if byte < 0xF0 else "four_byte")
    return CLASSES.index(name)


CLASS_MATRIX = np.array([[int(_class_of(b) == k) for k in range(len(CLASSES))] for b in range(256)], np.int64)


def class_counts(data: bytes) -> np.ndarray:
    """Characters of each class in UTF-8 bytes."""
    return np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ CLASS_MATRIX


def repeated_words(words: list[bytes], width: int = REPEAT_WIDTH) -> int:
    """Words inside windows of ``width`` words (a power of two) that occur at least twice."""
    if len(words) < 2 * width and len(words) <= width:
        return 0
    names: dict[bytes, int] = {}
    rank = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    have, kinds = 1, len(names)
    while have < width:                                   # ranks of runs of 2, 4, 8 words
        if kinds == len(rank):
            return 0                                      # no two equal runs, so no two equal windows
        pair = rank[:-have] * kinds + rank[have:]
        found, rank = np.unique(pair, return_inverse=True)
        have, kinds = 2 * have, len(found)
    twice = np.bincount(rank)[rank] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def base_counts(text: str, words: list[bytes]) -> dict[str, int]:
    """The rule counts of one text."""
    return {"n_words": len(words), "word_chars": len(text) - sum(map(text.count, SPACES)),
            "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": duplicate_lines(text),
            "n_repeat_words": repeated_words(words)}
