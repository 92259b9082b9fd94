"""Binary classification metrics (M7) as DataFrame aggregates.

ROC AUC is the tie-aware rank-sum statistic; average precision is
sum over thresholds of (recall step x precision), thresholds at every distinct
score.  Both need running sums along the score order: the scored rows are
first collapsed to one row per distinct score (a partial aggregate), then
:func:`churnlab.operators.ranking.prefix_sums` runs them in parallel.
Threshold metrics use ``p >= 0.5``; a zero denominator gives 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.functions.scalar import round_half_up
from churnlab.operators.ranking import prefix_sums

METRIC_DIGITS = 10


def evaluate_predictions(
    df: DataFrame,
    label: str = "churned",
    probability: str = "churn_probability",
    threshold: float = 0.5,
) -> DataFrame:
    """One row: roc_auc, average_precision, accuracy, precision, recall, f1."""
    y = F.col(label).cast("boolean")
    p = F.col(probability).cast("double")
    by_score = df.groupBy(p.alias("_p")).agg(
        F.count_if(y).cast("bigint").alias("_pos"),
        F.count_if(~y).cast("bigint").alias("_neg"),
    )
    running = prefix_sums(
        by_score,
        [F.col("_p").asc()],
        {"_cum_pos": F.col("_pos"), "_cum_neg": F.col("_neg")},
    )
    # AUC numerator: each positive beats the negatives below it, half the ties.
    # AP term: recall step (pos at this score / P) x precision at threshold p.
    tp_ge = F.col("_cum_pos_total") - F.col("_cum_pos") + F.col("_pos")
    fp_ge = F.col("_cum_neg_total") - F.col("_cum_neg") + F.col("_neg")
    pred = F.col("_p") >= F.lit(threshold)
    terms = running.select(
        pred.alias("_pred"),
        "_pos",
        "_neg",
        (
            F.col("_pos").cast("double")
            * ((F.col("_cum_neg") - F.col("_neg")).cast("double") + 0.5 * F.col("_neg"))
        ).alias("_auc_term"),
        (
            F.col("_pos").cast("double")
            * tp_ge.cast("double")
            / (tp_ge + fp_ge).cast("double")
        ).alias("_ap_term"),
    )
    # one global aggregate over the per-score rows gives every count
    both = terms.agg(
        F.sum("_auc_term").alias("_auc_sum"),
        F.sum("_ap_term").alias("_ap_sum"),
        F.sum(F.when(F.col("_pred"), F.col("_pos")).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.when(F.col("_pred"), F.col("_neg")).otherwise(0)).cast("bigint").alias("fp"),
        F.sum(F.when(~F.col("_pred"), F.col("_pos")).otherwise(0)).cast("bigint").alias("fn"),
        F.sum(F.when(~F.col("_pred"), F.col("_neg")).otherwise(0)).cast("bigint").alias("tn"),
    )

    def ratio(num, den):
        return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    positives = tp + fn
    negatives = fp + tn
    return both.select(
        # undefined (NULL) when the hold-out lacks one of the classes
        round_half_up(
            F.when(
                (positives > 0) & (negatives > 0),
                F.col("_auc_sum") / (positives.cast("double") * negatives.cast("double")),
            ),
            METRIC_DIGITS,
        ).alias("roc_auc"),
        round_half_up(
            F.when(positives > 0, F.col("_ap_sum") / positives.cast("double")), METRIC_DIGITS
        ).alias("average_precision"),
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )
