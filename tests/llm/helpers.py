"""Shared inputs and brute-force versions for the tests of the subpackage."""

from __future__ import annotations

import random
import re

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


def documents(spark, rows):
    """Documents from (doc_id, text, source); with columns that clash with
    names used inside the operators."""
    frame = spark.createDataFrame([(i, t, None, s, None) for i, t, s in rows], DOC)
    for name in ("size", "_key", "_cell", "copies", "n", "id", "score", "target"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    return frame


def tokens(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


class Union:
    """Union-find with the smallest id as root."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
