"""Rows that operators must survive, and plain-Python versions of what they compute."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size string, _hash string, `a b` int"
LONG = " ".join(f"word{i % 997}" for i in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven other animals watch from the old wooden fence near a quiet river "

ROWS = [
    (1, PROSE * 3 + "one", "en", "a", 1, None, "x", "h", 1),
    (2, PROSE * 3 + "one", "en", "a", 1, True, None, None, None),
    (3, PROSE * 3 + "two", None, None, None, None, None, None, None),
    (4, None, "en", "b", 0, None, None, None, None),
    (5, "", "en", "b", 0, None, None, None, None),
    (6, " \n\t ", "en", "c", 3, None, None, None, None),
    (7, LONG, "en", "a", len(LONG), None, None, None, None),
    (8, "née 日本語 \U0001F600 x y", "fr", "c", 9, None, None, None, None),
    (9, "one two", "en", "d", 7, None, None, None, None),
    (9, "one two", "en", "d", 7, None, None, None, None),
    (2**60 + 1, PROSE + "mail a.b@c.example.org, host 10.0.0.1, card 4111 1111 1111 1111, call +1 (017) 555-7713", "en", "a", 5, None, None, None, None),
    (None, PROSE * 3 + "one", "en", None, None, None, None, None, None),
    (None, None, None, None, None, None, None, None, None),
]


def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


class Groups:
    def __init__(self, keys):
        self.parent = {k: k for k in keys}

    def find(self, k):
        while self.parent[k] != k:
            k = self.parent[k]
        return k

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
