"""Quality: a regularised quadratic discriminant over document statistics.

Each whole text becomes a short vector of transformed statistics.  Class means
and covariances come from sums over all learning rows (map-side, a fixed number
of values), the covariances are shrunk, and the score is the logistic of the
difference of Gaussian log-densities, with Mahalanobis distances taken through
Cholesky factors computed once.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import remainder

NAMES = (
    "log_words", "log_word_bytes", "upper", "symbols", "digits", "bars", "ends_in_symbol",
    "repeats_last_word", "seen_pairs", "log_sentence", "short_words", "log_line",
)

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_PLAIN = np.isin(np.arange(256), [ord(c) for c in ".,;:'-\"()?"])
_SYMBOL = ~(_DIGIT | _SPACE | _LETTER | _PLAIN)
_TAIL = tuple(bytes([b]) for b in np.flatnonzero(_SYMBOL))


def _angle(part: float, whole: float) -> float:
    """Variance-stabilising transform of a share; an empty whole has share 0."""
    return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0


def statistics(text: str | None) -> list[float]:
    """The statistics in NAMES of one whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words = raw.split()
    n, letters = len(words), int(counts[_LETTER].sum())
    ink = len(raw) - int(counts[_SPACE].sum())
    pairs = max(n - 1, 0)
    return [
        float(np.log1p(n)),
        float(np.log((ink + 1) / (n + 1))),
        _angle(int(counts[_UPPER].sum()), letters),
        _angle(int(counts[_SYMBOL].sum()), ink),
        _angle(int(counts[_DIGIT].sum()), ink),
        _angle(int(counts[ord("|")]), n),
        _angle(sum(w.endswith(_TAIL) for w in words), n),
        _angle(sum(map(eq, words, words[1:])), pairs),
        _angle(pairs - len(set(zip(words, words[1:]))), pairs),
        float(np.log((n + 1) / (int(counts[ord(".")]) + 1))),
        _angle(sum(len(w) <= 3 for w in words), n),
        float(np.log((n + 1) / (int(counts[ord("\n")]) + 1))),
    ]


def statistics_udf():
    """Column function: text to its statistics, in the order of NAMES."""

    @F.pandas_udf("array<double>")
    def text_statistics(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return text_statistics


@dataclass(frozen=True)
class QualityModel:
    """Per class (0, 1): log prior, mean, inverse Cholesky factor, log
    determinant.  ``base`` set: the score of every text (fewer than 2 classes)."""

    classes: tuple[tuple[float, np.ndarray, np.ndarray, float], ...] = ()
    base: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(x), self.base)
        density = []
        for prior, mean, inverse, log_det in self.classes:
            z = (x - mean) @ inverse.T
            density.append(prior - 0.5 * ((z * z).sum(axis=1) + log_det))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def discriminant(
    sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float, ridge: float
) -> QualityModel:
    """Model from per-class (count, sum vector, sum of outer products).

    A class covariance is shrunk towards the pooled one by ``shrink`` and its
    diagonal raised by ``ridge``, so it is positive definite even for one row.
    """
    total = sum(s[0] for s in sums.values())
    if set(sums) != {0, 1}:
        return QualityModel(base=float(1 in sums) if total else 0.5)
    moments = {}
    for k, (n, one, two) in sums.items():
        mean = one / n
        moments[k] = (n, mean, two / n - np.outer(mean, mean))
    pooled = sum(n * cov for n, _, cov in moments.values()) / total
    classes = []
    for k in (0, 1):
        n, mean, cov = moments[k]
        cov = (1 - shrink) * cov + shrink * pooled + ridge * np.eye(len(mean))
        factor = np.linalg.cholesky(cov)
        classes.append(
            (float(np.log(n / total)), mean, np.linalg.inv(factor), float(2 * np.log(np.diag(factor)).sum()))
        )
    return QualityModel(tuple(classes))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, _x): the statistics of every whole text."""
    return docs.select("doc_id", statistics_udf()("text").alias("_x"))


def fit(
    rows: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    held_out: int = 0,
    shrink: float = 0.05,
    ridge: float = 1e-3,
) -> QualityModel:
    """Fit on all labelled rows outside the held-out fold.

    ``rows`` are ``measured`` documents.  Null labels, null ids and labels without a document don't count; a
    repeated id counts once and is good only if all its labels are.  Only the
    class sums (2 x 91 values) come to the driver.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(remainder(F.col("doc_id"), folds) != held_out)
        .groupBy(F.col("doc_id").alias("_id"))
        .agg((F.min(F.col("quality").cast("int")) > 0).cast("int").alias("_label"))
    )
    d = len(NAMES)
    x = [F.col("_x")[i] for i in range(d)]
    seconds = [(i, j) for i in range(d) for j in range(i, d)]
    # the statistics are taken before the join, so texts are not shuffled
    sums = (
        rows.where(remainder(F.col("doc_id"), folds) != held_out)
        .select(F.col("doc_id").alias("_doc"), "_x")
        .join(known, F.col("_doc") == F.col("_id"))
        .groupBy("_label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*(F.sum(c) for c in x)).alias("one"),
            F.array(*(F.sum(x[i] * x[j]) for i, j in seconds)).alias("two"),
        )
        .collect()
    )
    found = {}
    for row in sums:
        two = np.zeros((d, d))
        for (i, j), v in zip(seconds, row["two"]):
            two[i, j] = two[j, i] = v
        found[row["_label"]] = (float(row["n"]), np.array(row["one"]), two)
    return discriminant(found, shrink, ridge)


def score_udf(model: QualityModel):
    """Column function: statistics to probability of label 1.  Null and empty
    texts have the statistics of an empty text and a score like any other."""

    @F.pandas_udf("double")
    def quality_score(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.stack(rows.to_numpy())))

    return quality_score
