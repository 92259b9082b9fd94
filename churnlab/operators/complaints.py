"""Complaint-text classification.

Two classifiers share one output contract (best of the candidate labels, its
score, whether it equals the seed label):

* the built-in lexicon classifier: tokens of the whole text, matched against a
  word list per label; score = hits of the label / hits of all labels.  It is
  written as native regex counts, so it runs inside the scan stage with no
  shuffle, over each whole text;
* any pluggable Python classifier with the zero-shot interface
  ``f(text, candidate_labels=..., multi_label=False) -> {"labels", "scores"}``.
  Expensive models are run once per *distinct* text: texts are deduplicated by
  a SHA-256 key (map-side partial dedupe, so a text repeated across a third of
  all tickets costs one row per task), classified with ``mapInPandas`` (the
  model is built once per Python worker), and joined back on the key.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.functions.constants import COMPLAINT_LABELS
from churnlab.functions.scalar import normalize_label, round_half_up

# Default word lists of the built-in classifier, one per label in
# label order (domain words of each complaint type).
DOMAIN_LEXICON: list[list[str]] = [
    ["bill", "billing", "charge", "charged", "invoice", "payment", "refund"],
    ["outage", "down", "offline", "disconnected", "dead", "signal"],
    ["slow", "speed", "lag", "buffering", "latency", "mbps"],
    ["device", "phone", "handset", "router", "modem", "broken"],
    ["activate", "activation", "activated", "sim", "setup", "install"],
    ["price", "pricing", "expensive", "cost", "increase", "fee"],
    ["cancel", "cancellation", "terminate", "leave", "switch", "quit"],
]

# Word lists for the invented prose of the driver tables, two of
# its most frequent tokens per label in label order.
COMMON_WORD_LEXICON: list[list[str]] = [
    ["the", "and"],
    ["of", "to"],
    ["in", "is"],
    ["that", "it"],
    ["was", "for"],
    ["on", "with"],
    ["this", "as"],
]

TOKEN_SPLIT = "[^A-Za-z0-9]+"

# Classifiers built in this Python worker, reused by later tasks of the job;
# only the most recent few are kept so long-lived workers do not accumulate models.
_WORKER_CLASSIFIERS: dict[str, Callable] = {}
_WORKER_CACHE_SIZE = 4


def word_pattern(words: Sequence[str]) -> str:
    """Regex matching a whole token equal to one of ``words`` (ASCII case-insensitive).

    A token is a maximal run of [A-Za-z0-9]; the look-arounds pin the match to
    token boundaries, so counting matches equals counting matching tokens.
    """
    alternatives = "|".join(re.escape(w) for w in words)
    return f"(?i)(?<![A-Za-z0-9])(?:{alternatives})(?![A-Za-z0-9])"


def lexicon_classify(
    text: str | Column,
    lexicon: Sequence[Sequence[str]] = DOMAIN_LEXICON,
    labels: Sequence[str] = COMPLAINT_LABELS,
) -> Column:
    """The built-in classifier as one column expression: struct<label, score>.

    One regex pass over the whole text extracts every token that is a lexicon
    word; one fold over those matches counts hits per label (a word may count
    for several labels) and picks the best.  Null text gives null.
    """
    t = F.col(text) if isinstance(text, str) else text
    all_words = sorted({w for words in lexicon for w in words})
    matches = F.regexp_extract_all(t, F.lit(word_pattern(all_words)), F.lit(0))
    word_labels = F.create_map(
        *[
            x
            for w in all_words
            for x in (
                F.lit(w),
                F.array(*[F.lit(i) for i, words in enumerate(lexicon) if w in words]),
            )
        ]
    )
    k = len(lexicon)
    names = F.array(*[normalize_label(F.lit(label)) for label in labels])
    start = F.struct(*[F.lit(0).alias(f"c{i}") for i in range(k)])

    def step(acc, m):
        ids = F.element_at(word_labels, F.lower(m))
        return F.struct(
            *[
                (acc[f"c{i}"] + F.when(F.array_contains(ids, F.lit(i)), 1).otherwise(0)).alias(f"c{i}")
                for i in range(k)
            ]
        )

    def finish(acc):
        counts = [acc[f"c{i}"] for i in range(k)]
        best = F.greatest(*counts)
        total = counts[0]
        for c in counts[1:]:
            total = total + c
        idx = None
        for i, c in enumerate(counts):
            idx = F.when(c == best, F.lit(i)) if idx is None else idx.when(c == best, F.lit(i))
        score = F.when(total > 0, best.cast("double") / total.cast("double")).otherwise(F.lit(0.0))
        return F.struct(
            F.element_at(names, idx + 1).alias("label"), round_half_up(score, 6).alias("score")
        )

    return F.when(t.isNotNull(), F.aggregate(matches, start, step, finish))


def classify_support_tickets(
    tickets: DataFrame,
    lexicon: Sequence[Sequence[str]] = DOMAIN_LEXICON,
    text_col: str = "ticket_text",
    partitions: int | None = None,
) -> DataFrame:
    """N2 + N3 with the built-in classifier: three columns added in place.

    Classifying costs far more CPU per byte than moving text; for an input in
    a few large splits the caller may name the ``partitions`` to deal it into.
    """
    dealt = tickets.repartition(partitions) if partitions else tickets
    return _attach(dealt.withColumn("_res", lexicon_classify(text_col, lexicon)))


def _attach(df: DataFrame) -> DataFrame:
    """Predicted label, score and seed match from the ``_res`` struct.

    The three columns come out of an ``inline`` generator: filters on them
    (e.g. dropping null categories before an aggregate) then stay above the
    generator instead of being pushed into the projection, where they would
    re-run the whole-text classification once per reference.
    """
    predicted = F.col("_res")["label"]
    outputs = F.struct(
        predicted.alias("complaint_category_predicted"),
        F.col("_res")["score"].alias("complaint_category_score"),
        F.coalesce(predicted == F.col("complaint_category_seed"), F.lit(False)).alias(
            "complaint_category_matches_seed"
        ),
    )
    return df.select(*[c for c in df.columns if c != "_res"], F.inline(F.array(outputs)))


# --- pluggable classifier on distinct texts ----------------------------------


def classify_with(
    tickets: DataFrame,
    classifier_factory: Callable[[], Callable],
    labels: Sequence[str] = COMPLAINT_LABELS,
    text_col: str = "ticket_text",
    salts: int = 16,
) -> DataFrame:
    """N1 + N3 + J5 with a pluggable classifier (X3), each distinct text once.

    ``classifier_factory`` is called once per Python worker (it may load a
    model).  A classifier with a ``classify_batch(texts, candidate_labels,
    multi_label)`` method, which returns one result per text, gets a whole batch
    at a time; any other gets one text at a time.

    Results come back over (text key, salt): each result is repeated ``salts``
    times and the tickets of one text are dealt over them, so a text that a
    third of the tickets share is not one task.  Null texts skip the join.
    """
    keyed = tickets.withColumn("_text_key", F.sha2(F.col(text_col), 256))
    distinct_texts = (
        keyed.filter(F.col(text_col).isNotNull())  # L7
        .groupBy("_text_key")  # U3: partial dedupe per task, then one row per key
        .agg(F.first(text_col).alias(text_col))
    )
    label_list = list(labels)
    token = uuid.uuid4().hex  # names this classifier in each worker's cache

    def run(batches):
        import pandas as pd

        classify = _WORKER_CLASSIFIERS.get(token)
        if classify is None:
            while len(_WORKER_CLASSIFIERS) >= _WORKER_CACHE_SIZE:
                _WORKER_CLASSIFIERS.pop(next(iter(_WORKER_CLASSIFIERS)))
            classify = _WORKER_CLASSIFIERS[token] = classifier_factory()
        for pdf in batches:
            texts = list(pdf[text_col])
            batch = getattr(classify, "classify_batch", None)
            if batch is not None:
                results = list(batch(texts, candidate_labels=label_list, multi_label=False))
            else:
                results = [classify(t, candidate_labels=label_list, multi_label=False) for t in texts]
            yield pd.DataFrame(
                {
                    "_text_key": pdf["_text_key"],
                    "_label": [str(r["labels"][0]) for r in results],
                    "_score": [float(r["scores"][0]) for r in results],
                }
            )

    results = distinct_texts.mapInPandas(
        run, "_text_key string, _label string, _score double"
    ).select(
        "_text_key",
        F.struct(
            normalize_label(F.col("_label")).alias("label"),
            round_half_up(F.col("_score"), 6).alias("score"),
        ).alias("_res"),
    )
    salted = results.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64(*tickets.columns), F.lit(salts)).cast("int")
    texts = keyed.filter(F.col(text_col).isNotNull()).withColumn("_salt", salt)
    joined = texts.join(salted, ["_text_key", "_salt"], "left").select(*tickets.columns, "_res")
    nothing = F.lit(None).cast(joined.schema["_res"].dataType)
    nulls = tickets.filter(F.col(text_col).isNull()).withColumn("_res", nothing)
    return _attach(joined.unionByName(nulls))


class LexiconClassifier:
    """The built-in word-list rule as a Python zero-shot style classifier.

    Used through :func:`classify_with` it gives the same answers as
    :func:`lexicon_classify` (both tokenise the whole text the same way).
    """

    def __init__(self, lexicon: Sequence[Sequence[str]] = DOMAIN_LEXICON):
        self._split = re.compile(TOKEN_SPLIT)
        self._lexicon = [set(words) for words in lexicon]

    def __call__(self, text, candidate_labels, multi_label=False):
        toks = [t.lower() for t in self._split.split(text)]
        counts = [sum(1 for t in toks if t in words) for words in self._lexicon]
        total = sum(counts)
        order = sorted(range(len(candidate_labels)), key=lambda i: (-counts[i], i))
        scores = [counts[i] / total if total else 0.0 for i in order]
        return {"labels": [candidate_labels[i] for i in order], "scores": scores}

    def classify_batch(self, texts, candidate_labels, multi_label=False):
        return [self(text, candidate_labels, multi_label) for text in texts]


# --- summaries --------------------------------------------------------------


def complaint_tiles(classified: DataFrame) -> DataFrame:
    """Tickets, customers with tickets, seed-match rate."""
    match = F.col("complaint_category_matches_seed")
    return classified.agg(
        F.count(F.lit(1)).alias("classified_tickets"),
        F.countDistinct("customer_id").alias("customers_with_tickets"),
        (F.count_if(match).cast("double") / F.count(match).cast("double")).alias("match_rate"),
    )
