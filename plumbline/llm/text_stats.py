"""Statistics of one text that quality rules are made of."""

from __future__ import annotations

import numpy as np

#: Fixed values of the rule set: symbol characters, window length.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

FEATURES = (
    "log_words",
    "word_length",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "mark_share",
    "distinct_share",
    "line_words",
)

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_BLANK = b" \t\n\r\x0b\x0c"
_INSIDE = bytes(range(0x80, 0xC0))  # continuation bytes of UTF-8
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` (a power of two) words that occur twice or more.

    Exact: windows are named by doubling, two names of half the length at a
    time, and only windows whose halves both repeat are looked at again.
    """
    n = len(words)
    if n <= window:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    if len(names) == n:
        return 0
    # rank[i]: the name of the window that starts at i, -1 where it occurs once only.
    rank, size, at = ids, 1, np.arange(n)
    while size < window:
        at = at[at + size < n]
        left, right = rank[at], rank[np.minimum(at + size, n - 1)]
        both = (left >= 0) & (right >= 0)
        at, left, right = at[both], left[both], right[both]
        if len(at) < 2:
            return 0
        size *= 2
        _, name, count = np.unique(left * (n + 1) + right, return_inverse=True, return_counts=True)
        twice = count[name] > 1
        at, name = at[twice], name[twice]
        rank = np.full(n, -1, np.int64)
        rank[at] = name
    if not len(at):
        return 0
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def base_statistics(text: bytes) -> tuple[int, int, int, int, int, list[bytes], int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; the words; lines with words."""
    words = text.split()
    chars = len(text.translate(None, _BLANK + _INSIDE))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        chars,
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        words,
        len(lines),
    )


def features(text: bytes) -> tuple[tuple[int, ...], list[float]]:
    """The five base statistics and the model's inputs in the order of ``FEATURES``."""
    n, chars, symbols, dup, repeat, words, lines = base_statistics(text)
    some, some_chars = max(n, 1), max(chars, 1)
    size = len(text)
    return (n, chars, symbols, dup, repeat), [
        float(np.log1p(n)),
        chars / some,
        symbols / some_chars,
        dup / max(lines, 1),
        repeat / some,
        (size - len(text.translate(None, _UPPER))) / some_chars,
        (size - len(text.translate(None, _DIGITS))) / some_chars,
        (size - len(text.translate(None, _MARKS))) / some_chars,
        len(set(words)) / some,
        n / max(lines, 1),
    ]
