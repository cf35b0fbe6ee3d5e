"""Quality of binary scores: label in {0, 1}, score in [0, 1]."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlake.operators.running import range_totals


def confusion_matrix(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    actual, said = F.col(label) == 1, F.col(prediction) == 1
    return scored.agg(
        F.count_if(~actual & ~said).alias("tn"),
        F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"),
        F.count_if(actual & said).alias("tp"),
    )


def classification_metrics(matrix: DataFrame) -> DataFrame:
    """A share of nothing counts as 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def share(part, whole):
        return F.round(F.coalesce(F.try_divide(part, whole), F.lit(0.0)), 6)

    return matrix.select(
        share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def per_class_report(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support of each class. The class counts of both
    sides come from one small confusion table."""
    pairs = scored.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("said")).agg(
        F.count(F.lit(1)).alias("n")
    )
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("name"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
                F.struct(F.col("said").alias("name"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
            )
        ).alias("s"),
        F.when(F.col("actual") == F.col("said"), F.col("n")).otherwise(0).alias("hits"),
    )
    counts = sides.groupBy(F.col("s.name").alias("class")).agg(
        F.sum("s.support").alias("support"),
        F.sum("s.predicted").alias("predicted"),
        # A hit is listed once per side.
        (F.sum("hits") / 2).cast("long").alias("hits"),
    )
    zero = F.lit(0.0)
    return counts.select(
        "class",
        F.coalesce(F.try_divide("hits", "predicted"), zero).alias("precision"),
        F.coalesce(F.try_divide("hits", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(F.col("hits") * 2, F.col("predicted") + F.col("support")), zero).alias("f1"),
        "support",
    )


def ranked_scores(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: positives, negatives, and how many of each have a
    lower score. Scores are dealt by ranges that Spark samples from them, so no task sees
    all scores however close together they lie."""
    positive = F.col(label) == 1
    per_score = scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    return range_totals(
        per_score,
        ["score"],
        sums={"positives_below": "positives", "negatives_below": "negatives"},
        totals={"all_positives": "positives_below", "all_negatives": "negatives_below"},
    )


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area: the share of (positive, negative) pairs in the right order,
    equal scores counting half. Twice the pairs keeps the sum whole."""
    ranked = ranked_scores(scored, label, score)
    doubled = F.col("positives").cast("decimal(19,0)") * (2 * F.col("negatives_below") + F.col("negatives"))
    sums = ranked.agg(
        F.sum("positives").alias("positives"),
        F.sum("negatives").alias("negatives"),
        F.sum(doubled).cast("double").alias("doubled"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives") * 2
    return sums.select(
        "positives", "negatives", F.round(F.try_divide(F.col("doubled"), pairs), 6).alias("roc_auc")
    )


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """True and false positive rate when everything from a score up is flagged."""
    ranked = ranked_scores(scored, label, score)
    p, n = F.col("all_positives"), F.col("all_negatives")
    return ranked.select(
        F.col("score").alias("threshold"),
        F.round(F.try_divide(p - F.col("positives_below"), p), 6).alias("tpr"),
        F.round(F.try_divide(n - F.col("negatives_below"), n), 6).alias("fpr"),
    )
