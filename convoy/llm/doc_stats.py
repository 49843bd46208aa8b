"""Statistics of one whole text, the inputs of the quality models.

A text is split into words at space and the control characters 0x09 to 0x0D. Null and empty texts give zeros.
"""

from __future__ import annotations

import numpy as np

from convoy.llm.common import SEPARATORS

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "top_word_share",
    "upper_share", "digit_share", "punct_share", "bang_share", "bar_share", "period_share", "short_word_share",
    "long_word_share", "symbol_word_share", "line_words", "adjacent_share", "high_byte_share", "length_spread",
)
#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

_SYMBOL_CODES = np.frombuffer(SYMBOLS, np.uint8)
_SEPARATOR_CODES = np.frombuffer(SEPARATORS.encode(), np.uint8)
_PUNCT_CODES = np.frombuffer(b"!\"'(),-./:;?@[\\]^_`{}~+=", np.uint8)


def repeated_words(ids: np.ndarray, size: int = 3) -> int:
    """Words inside windows of ``size`` words that occur at least twice in the text, the first one included."""
    if len(ids) < size + 1:
        return 0
    key = ids
    for step in range(1, size):
        # Renumbering keeps the combined key below 2**63 for texts of any length.
        base = int(ids.max()) + 1
        key = np.unique(key[:-1], return_inverse=True)[1] if int(key.max()) + 1 > 2**62 // base else key[:-1]
        key = key * base + ids[step:]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    marked = np.zeros(len(ids), bool)
    for step in range(size):
        marked[step: step + len(twice)] |= twice
    return int(marked.sum())


def duplicate_lines(text: str) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and all lines with a word."""
    lines = [x for x in text.split("\n") if x.strip(SEPARATORS)]
    return len(lines) - len(set(lines)), len(lines)


def statistics(text: str | None) -> tuple[tuple[int, ...], np.ndarray]:
    """The ``BASE`` counts and the ``FEATURES`` of a text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return (0,) * len(BASE), np.zeros(len(FEATURES))
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = int(codes[:128].sum() + codes[192:].sum())  # bytes that start a code point
    word_chars = chars - int(codes[_SEPARATOR_CODES].sum())
    n_symbols = int(codes[_SYMBOL_CODES].sum())
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    lengths = np.fromiter(map(len, words), np.int64, n)
    repeated = repeated_words(ids)
    dup_lines, lines = duplicate_lines(text)
    symbol_words = sum(w[-1] in SYMBOLS or w[0] in SYMBOLS for w in words)
    base = (n, word_chars, n_symbols, dup_lines, repeated)
    per_char = 1.0 / max(1, word_chars)
    features = np.array([
        np.log1p(n), word_chars / n, n_symbols * per_char, dup_lines / max(1, lines), repeated / n,
        len(known) / n, np.bincount(ids).max() / n,
        codes[65:91].sum() * per_char, codes[48:58].sum() * per_char, codes[_PUNCT_CODES].sum() * per_char,
        codes[33] * per_char, codes[124] * per_char, codes[46] * per_char,
        (lengths <= 3).mean(), (lengths >= 12).mean(), symbol_words / n, np.log1p(n / max(1, lines)),
        (ids[1:] == ids[:-1]).mean() if n > 1 else 0.0, codes[128:].sum() / len(raw), lengths.std(),
    ])
    return base, features
