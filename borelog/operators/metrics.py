"""Quality of a classifier, from counts that Spark takes where the rows are."""

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from borelog.operators.filling import cut_index
from borelog.support import BROADCAST_ROWS

# Labels of the report rows.
CLASS_PREFIX = "State_"
ACCURACY_ROW = "accuracy"
MACRO_ROW = "macro avg"
WEIGHTED_ROW = "weighted avg"

# Rows sampled per slice of a score range to find where to cut it.
SAMPLES_PER_SLICE = 1000


def confusion_counts(scored: DataFrame, label: str = "state", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def accuracy(scored: DataFrame, label: str = "state", prediction: str = "prediction") -> DataFrame:
    """One row: the share of rows whose prediction equals the label; a row without either is a miss."""
    hit = F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("bigint")
    return scored.agg(F.try_divide(F.sum(hit), F.count("*")).alias("accuracy"))


def class_report(scored: DataFrame, label: str = "state", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the macro and weighted averages.

    A ratio without a denominator is 0. The accuracy row holds its value in ``f1_score``.
    """
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hits = F.when(F.col("label").eqNullSafe(F.col("prediction")), n).otherwise(none)
    both_roles = F.inline(F.array(
        _role(F.col("label"), support=n, predicted=none, hits=hits),
        _role(F.col("prediction"), support=none, predicted=n, hits=none),
    ))
    classes = (
        confusion_counts(scored, label, prediction)
        .select(both_roles)
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
        .withColumns({
            "precision": _ratio(F.col("hits"), F.col("predicted")),
            "recall": _ratio(F.col("hits"), F.col("support")),
            "f1_score": _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")),
        })
    )
    scores = ("precision", "recall", "f1_score")
    support = F.sum("support")
    with_total = classes.rollup("class").agg(
        support.alias("support"),
        F.try_divide(F.sum("hits"), support).alias("share"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[F.try_divide(F.sum(F.col(s) * F.col("support")), support).alias(f"weighted_{s}") for s in scores],
        F.grouping("class").alias("is_total"),
    )
    nothing = F.lit(None).cast("double")
    class_row = _row(F.concat(F.lit(CLASS_PREFIX), F.col("class").cast("string")), [F.col(f"macro_{s}") for s in scores])
    total_rows = [
        _row(F.lit(ACCURACY_ROW), [nothing, nothing, F.col("share")]),
        _row(F.lit(MACRO_ROW), [F.col(f"macro_{s}") for s in scores]),
        _row(F.lit(WEIGHTED_ROW), [F.col(f"weighted_{s}") for s in scores]),
    ]
    return with_total.select(F.inline(F.when(F.col("is_total") == 1, F.array(*total_rows)).otherwise(F.array(class_row))))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def _role(state: Column, support: Column, predicted: Column, hits: Column) -> Column:
    return F.struct(
        state.alias("class"), support.alias("support"), predicted.alias("predicted"), hits.alias("hits")
    )


def _row(name: Column, values) -> Column:
    precision, recall, f1_score = values
    return F.struct(
        name.alias("class_name"), precision.alias("precision"), recall.alias("recall"), f1_score.alias("f1_score"),
        F.col("support").alias("support"),
    )


def ovr_auc(
    scored: DataFrame, scores: Mapping[int, Column | str], label: str = "state", slice_rows: int = 1_000_000
) -> DataFrame:
    """Exact one-vs-rest ROC-AUC of every class in ``scores`` (class -> its score column), with class counts.

    The AUC is the share of (positive, negative) pairs in the right order, ties counting half. Rows with equal scores
    are counted together first. Beyond ``slice_rows`` rows the score range of a class is cut at quantiles of a sample;
    pairs within a slice are counted inside it, pairs across slices from the slice totals, so the work spreads over
    tasks and where exactly the cuts fall does not matter.
    """
    per_class = F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("class"),
            (F.col(s) if isinstance(s, str) else s).cast("double").alias("score"),
            F.col(label).eqNullSafe(F.lit(c)).alias("is_positive"),
        )
        for c, s in scores.items()
    ]))
    long = scored.select(per_class)
    count_if = lambda condition: F.count(F.when(condition, 1)).cast("double")
    by_score = long.groupBy("class", "score").agg(
        count_if(F.col("is_positive")).alias("positives"), count_if(~F.col("is_positive")).alias("negatives")
    )
    n_rows = scored.count()
    n_slices = min(BROADCAST_ROWS, math.ceil(n_rows / slice_rows))
    if n_slices < 2:
        in_slice = by_score.withColumn("slice", F.lit(0))
    else:
        sample = long.where(F.rand(13) < n_slices * SAMPLES_PER_SLICE / n_rows)
        in_slice = _sliced(by_score, sample, n_slices)
    upto = F.sum("negatives").over(Window.partitionBy("class", "slice").orderBy("score"))
    pairs = F.col("positives") * (upto - F.col("negatives") / 2)
    by_slice = in_slice.withColumn("pairs", pairs).groupBy("class", "slice").agg(
        *[F.sum(c).alias(c) for c in ("positives", "negatives", "pairs")]
    )
    earlier = F.sum("negatives").over(Window.partitionBy("class").orderBy("slice")) - F.col("negatives")
    totals = by_slice.withColumn("pairs", F.col("pairs") + F.col("positives") * earlier).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("positives", "negatives", "pairs")]
    )
    possible = F.col("positives") * F.col("negatives")
    return totals.select(
        "class",
        F.col("positives").cast("bigint").alias("positives"),
        F.col("negatives").cast("bigint").alias("negatives"),
        F.when(possible > 0, F.col("pairs") / possible).alias("auc"),
    )


def _sliced(by_score: DataFrame, sample: DataFrame, n_slices: int) -> DataFrame:
    quantiles = [k / n_slices for k in range(1, n_slices)]
    cuts = sample.groupBy(F.col("class").alias("cut_class")).agg(
        F.percentile_approx("score", quantiles, 10 * n_slices).alias("cuts")
    )
    # One row of at most BROADCAST_ROWS numbers per scored class: the call itself bounds the broadcast side.
    found = by_score.join(F.broadcast(cuts), F.col("class") == F.col("cut_class"), "left")
    below = cut_index(F.col("cuts"), lambda cut: cut < F.col("score"), n_slices)
    return found.select(*by_score.columns, F.coalesce(below, F.lit(0)).alias("slice"))


def weighted_ovr_auc(
    scored: DataFrame, scores: Mapping[int, Column | str], label: str = "state", slice_rows: int = 1_000_000
) -> DataFrame:
    """One row: the class AUCs weighted by class size; NULL and a message if a class lacks positives or negatives."""
    by_class = ovr_auc(scored, scores, label, slice_rows)
    complete = (F.count("auc") == len(scores)) & F.lit(len(scores) > 1)
    weighted = F.try_divide(F.sum(F.col("auc") * F.col("positives")), F.sum("positives"))
    return by_class.agg(
        F.when(complete, weighted).alias("weighted_auc"),
        F.when(~complete, F.lit("not calculated: every class needs rows in and out of it")).alias("message"),
    )
