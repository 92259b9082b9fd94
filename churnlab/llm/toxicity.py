"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A bag holds the character n-grams (over UTF-8 bytes, with word boundaries) of
one word.  Their embeddings are averaged and a linear softmax reads the
average; embeddings and softmax are trained jointly in numpy.  A misspelling
that was never seen still shares most of its n-gram vectors with the words that
were.  A document is as toxic as its most toxic word, so a single word in a
long text is not averaged away; a one-dimensional logistic curve, fitted on
labelled documents that the embeddings did not see, turns that word's margin
into a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labels import learning_rows

SIZES = (3, 4, 5, 6)  # n-gram lengths in bytes
BUCKET_BITS = 17
DIMENSIONS = 8
CHUNK_BYTES = 1 << 20  # bytes of words scored in one array pass
CHUNK_GRAMS = 1 << 18  # n-grams trained in one array pass

# Bytes of words: ASCII letters and digits, and all bytes of longer characters.
_CLEAN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: str | None) -> set[bytes]:
    """Distinct lower-case words of the whole text as UTF-8 bytes."""
    return set((text or "").lower().encode("utf-8", "replace").translate(_CLEAN).split())


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, index of its word) over a list of words."""
    line = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)
    gaps = np.flatnonzero(line == 0x20)
    word = np.cumsum(line == 0x20) - 1  # a gap belongs to the word after it
    end = gaps[np.minimum(word + 1, len(gaps) - 1)]
    place = np.arange(len(line))
    code = np.zeros(len(line), dtype=np.uint32)
    buckets, owners = [], []
    for n in range(1, max(SIZES) + 1):
        rest = len(line) - n + 1
        if rest <= 0:
            break
        code = code[:rest] * np.uint32(0x01000193) + line[n - 1 :].astype(np.uint32) + np.uint32(n)
        if n in SIZES:
            inside = np.flatnonzero(place[:rest] + n - 1 <= end[:rest])
            inside = inside[word[inside] < len(words)]
            mixed = code[inside] ^ (code[inside] >> np.uint32(15))
            buckets.append((mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS))
            owners.append(word[inside])
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass(frozen=True)
class ToxicModel:
    """Margin of each n-gram bucket (embedding times softmax difference), the
    softmax bias, and the logistic curve from margin to probability."""

    margins: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    base: float | None = None  # set: the score of every text (one class only)

    def word_margins(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        buckets, owners = subwords(words)
        total = np.bincount(owners, weights=self.margins[buckets], minlength=len(words))
        return total / np.maximum(np.bincount(owners, minlength=len(words)), 1) + self.bias

    def document_margins(self, texts: pd.Series) -> np.ndarray:
        """Largest word margin of each text; without words the empty bag's, the bias."""
        out = np.full(len(texts), -np.inf)
        words, owner, held = [], [], 0

        def flush() -> None:
            if words:
                np.maximum.at(out, np.array(owner), self.word_margins(words))

        for i, text in enumerate(texts):
            for w in words_of(text):
                words.append(w)
                owner.append(i)
                held += len(w) + 1
            if held > CHUNK_BYTES:
                flush()
                words, owner, held = [], [], 0
        flush()
        return np.where(np.isfinite(out), out, self.bias)

    def scores(self, texts: pd.Series) -> np.ndarray:
        if self.base is not None:
            return np.full(len(texts), self.base)
        z = self.slope * self.document_margins(texts) + self.offset
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _grams(words: list[bytes]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """The words' n-grams in runs of whole words: (first word, past the last,
    bucket of each n-gram in the order of its word, n-grams of each word)."""
    runs, at = [], 0
    most = np.cumsum([len(SIZES) * (len(w) + 2) for w in words])
    while at < len(words):
        before = most[at - 1] if at else 0
        end = max(int(np.searchsorted(most, before + CHUNK_GRAMS, side="right")), at + 1)
        buckets, owners = subwords(words[at:end])
        order = np.argsort(owners, kind="stable")
        runs.append((at, end, buckets[order].astype(np.int32), np.bincount(owners, minlength=end - at)))
        at = end
    return runs


def train_subwords(
    words: list[bytes],
    toxic: np.ndarray,
    clean: np.ndarray,
    epochs: int = 25,
    decay: float = 3e-2,
    most: int = 1000,
    prior: float = 8.0,
    seed: int = 17,
) -> tuple[np.ndarray, float]:
    """Train embeddings and softmax; return each bucket's margin and the bias.

    ``toxic`` and ``clean`` count the learning documents of each class that
    hold the word; a word weighs at most ``most`` documents.  Each word has
    ``prior`` more documents in the classes' overall shares and ``decay`` pulls
    embeddings to zero, so words that a few toxic documents hold by chance
    gain little; both were chosen by :func:`inner_losses` and invented misspellings.  Every epoch sums the gradient of all words, in runs of words
    of about ``CHUNK_GRAMS`` n-grams, so the arrays of a pass don't grow with
    the number of words.
    """
    rng = np.random.default_rng(seed)
    runs = _grams(words)  # (first word, past the last, bucket of each n-gram, their number by word)
    place = np.zeros(1 << BUCKET_BITS, dtype=bool)
    for _, _, buckets, _ in runs:
        place[buckets] = True
    used = np.flatnonzero(place)
    place = (np.cumsum(place) - 1).astype(np.int32)
    seen = toxic + clean
    weight = np.minimum(seen, most) / np.maximum(seen, 1)
    goal = np.stack([clean * weight, toxic * weight], axis=1).astype(np.float32)
    goal += np.float32(prior) * (goal.sum(axis=0) / goal.sum())
    total = goal.sum(axis=1, keepdims=True)
    mean = total.mean()
    params = [
        rng.normal(0, 0.1, (len(used), DIMENSIONS)).astype(np.float32),
        rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32),
        np.log(goal.sum(axis=0) / goal.sum()).astype(np.float32),
    ]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, epochs + 1):
        table, soft, bias = params
        grad = np.zeros((len(used), DIMENSIONS))
        soft_grad, bias_grad = decay * soft, np.zeros(2, dtype=np.float32)
        for start, end, buckets, counts in runs:
            cells, lengths = place[buckets], counts[:, None].astype(np.float32)
            bag = np.add.reduceat(table[cells], np.cumsum(counts) - counts, axis=0) / lengths
            z = bag @ soft + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = (z / z.sum(axis=1, keepdims=True) * total[start:end] - goal[start:end]) / mean
            back = np.repeat((error @ soft.T) / lengths, counts, axis=0)
            for d in range(DIMENSIONS):
                grad[:, d] += np.bincount(cells, weights=back[:, d], minlength=len(used))
            soft_grad, bias_grad = soft_grad + bag.T @ error, bias_grad + error.sum(axis=0)
        grads = [(grad + decay * table).astype(np.float32), soft_grad, bias_grad]
        for k, g in enumerate(grads):  # Adam
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            step = (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-6)
            params[k] = params[k] - np.float32(0.1) * step
    table, soft, bias = params
    margins = np.zeros(1 << BUCKET_BITS, dtype=np.float32)
    margins[used] = table @ (soft[:, 1] - soft[:, 0])
    return margins, float(bias[1] - bias[0])


def logistic_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression on one variable (Newton steps
    with a small ridge, so separable data stay finite).  Where a higher margin
    would make a label less likely, the slope is 0 and the offset gives the
    labels' share: such margins tell nothing."""
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-4])
        step = np.linalg.solve(hess, x.T @ (label - p) - np.array([1e-2, 1e-4]) * beta)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    if not np.isfinite(beta).all() or beta[0] <= 0:
        share = (label.sum() + 0.5) / (len(label) + 1)
        return 0.0, float(np.log(share / (1 - share)))
    return float(beta[0]), float(beta[1])


PARTS = 4  # of the learning rows: one for the logistic curve, the others for the embeddings


def _learning_texts(
    docs: DataFrame, labels: DataFrame, folds: int, held_out: int, max_documents: int
) -> tuple[DataFrame, DataFrame]:
    """The learning rows (_id, _label, _part) and their texts beside them;
    both are bounded by ``max_documents``."""
    part = F.pmod(F.crc32(F.concat(F.lit("curve:"), F.col("_id").cast("string"))), F.lit(PARTS))
    rows = learning_rows(labels, "toxic", folds, held_out, max_documents).withColumn("_part", part)
    texts = docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text"))
    return rows, texts.join(F.broadcast(rows), F.col("_doc") == F.col("_id"))


def _word_counts(texts: DataFrame) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All distinct words, sorted, so that a rerun adds in the same order, and
    the toxic and clean documents that hold each.  Only these counts, of at
    most ``max_documents`` texts, reach the driver, as Arrow columns."""

    def spell(batches):
        for batch in batches:
            found = [words_of(t) for t in batch["_text"]]
            label = np.repeat(batch["_label"].to_numpy(), [len(f) for f in found])
            yield pd.DataFrame({"word": [w for f in found for w in f], "toxic": label, "clean": 1 - label})

    counted = (
        texts.select("_text", "_label")
        .mapInPandas(spell, "word binary, toxic long, clean long")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    found = counted.toArrow().sort_by("word")
    toxic, clean = (found[c].to_numpy().astype(np.float64) for c in ("toxic", "clean"))
    return found["word"].to_pylist(), toxic, clean


def _margins_of(model: ToxicModel, texts: DataFrame) -> pd.DataFrame:
    """_id, _label and margin of at most ``max_documents`` learning texts."""
    return texts.select("_id", "_label", _margin_udf(model)("_text").alias("m")).toPandas()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    held_out: int = 2,
    max_documents: int = 8_000,
) -> ToxicModel:
    """Fit on at most ``max_documents`` labelled rows outside the held-out fold.

    Three quarters of them train the embeddings on all of their distinct words
    (only counts per word reach the driver), the rest the logistic curve.  With
    one class or no labels, every score is the share of toxic labels (0 without
    labels).
    """
    rows, texts = _learning_texts(docs, labels, folds, held_out, max_documents)
    words, toxic, clean = _word_counts(texts.where("_part != 0"))
    if toxic.sum() == 0 or clean.sum() == 0:
        share = rows.agg(F.avg("_label")).first()[0]
        return ToxicModel(np.zeros(1), 0.0, base=float(share or 0.0))
    margins, bias = train_subwords(words, toxic, clean)
    model = ToxicModel(margins, bias)
    held = _margins_of(model, texts.where("_part = 0"))
    if held["_label"].nunique() < 2:
        return model
    slope, offset = logistic_curve(held["m"].to_numpy(), held["_label"].to_numpy(dtype=float))
    return ToxicModel(margins, bias, slope, offset)


def half_losses(margin: np.ndarray, label: np.ndarray) -> list[float]:
    """Log-loss of each half of the rows under the curve fitted on the other
    half; a half without both classes fits none."""
    losses, half = [], np.arange(len(label)) % 2 == 0
    for fitted in (half, ~half):
        if len(set(label[fitted])) == 2 and (~fitted).any():
            slope, offset = logistic_curve(margin[fitted], label[fitted])
            z = np.where(label[~fitted] > 0, 1, -1) * (slope * margin[~fitted] + offset)
            losses.append(float(np.logaddexp(0, -z).mean()))
    return losses


def inner_losses(
    docs: DataFrame,
    labels: DataFrame,
    grid: list[dict],
    folds: int = 4,
    held_out: int = 2,
    max_documents: int = 8_000,
    rounds: int = PARTS,
) -> list[float]:
    """Mean log-loss of each set of :func:`train_subwords` parameters on inner
    folds of the learning rows; labels of the held-out fold are not read.

    In each of ``rounds`` rounds one part of the learning rows is left out of
    the training; half of it fits the logistic curve and the other half is
    scored, and the other way round.  Rounds whose halves or training rows lack
    a class don't count; without any, the losses are NaN.
    """
    _, texts = _learning_texts(docs, labels, folds, held_out, max_documents)
    losses: list[list[float]] = [[] for _ in grid]
    for part in range(rounds):
        words, toxic, clean = _word_counts(texts.where(F.col("_part") != part))
        if toxic.sum() == 0 or clean.sum() == 0:
            continue
        for at, params in enumerate(grid):
            model = ToxicModel(*train_subwords(words, toxic, clean, **params))
            left = _margins_of(model, texts.where(F.col("_part") == part)).sort_values("_id")
            losses[at] += half_losses(left["m"].to_numpy(), left["_label"].to_numpy(dtype=float))
    return [float(np.mean(found)) if found else float("nan") for found in losses]


def _margin_udf(model: ToxicModel):
    @F.pandas_udf("double")
    def margin(texts: pd.Series) -> pd.Series:
        return pd.Series(model.document_margins(texts))

    return margin


def score_udf(model: ToxicModel):
    """Column function: text to probability of being toxic.  A null or empty
    text, or one without words, scores as an empty bag, which has the softmax's bias."""

    @F.pandas_udf("double")
    def toxic_score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts))

    return toxic_score
