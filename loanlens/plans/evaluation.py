"""Quality of stored scores, by DataFrame aggregates over any number of rows.

Rows are counted per distinct score first.  The running counts that the areas need are
taken over range partitions of the scores; what crosses the driver is one pair of
counts per partition, so no task sees all scores.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlens.plans.features import LABEL
from loanlens.scratch import materialise

# monotonically_increasing_id holds the partition above its 33 row bits.
_ROW_BITS = 33


def positive_score(column: str = "rawPrediction") -> Column:
    """The score of the positive class in a vector of two."""
    return vector_to_array(F.col(column))[1]


def score_counts(predictions: DataFrame, score: Column | None = None) -> DataFrame:
    """(score, positive, negative): labelled rows per distinct score."""
    value = positive_score() if score is None else score
    is_positive = F.col(LABEL) == 1.0
    return predictions.groupBy(value.alias("score")).agg(
        F.count(F.when(is_positive, 1)).alias("positive"),
        F.count(F.when(~is_positive, 1)).alias("negative"),
    )


def threshold_curve(counts: DataFrame) -> DataFrame:
    """``score_counts`` with the positives and negatives at or above each score."""
    placed = materialise(counts.orderBy(F.desc("score"))).withColumn(
        "_part", F.shiftright(F.monotonically_increasing_id(), _ROW_BITS)
    )
    sums = placed.groupBy("_part").agg(F.sum("positive"), F.sum("negative")).collect()
    starts, above = [], (0, 0)
    for part, positive, negative in sorted(tuple(row) for row in sums):
        starts.append((part, *above))
        above = (above[0] + positive, above[1] + negative)
    schema = "_part long, _positive long, _negative long"
    # One row per partition of the range shuffle: bounded by the partition count.
    offsets = F.broadcast(counts.sparkSession.createDataFrame(starts, schema))
    running = Window.partitionBy("_part").orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return placed.join(offsets, "_part").select(
        *counts.columns,
        (F.col("_positive") + F.sum("positive").over(running)).alias("positives_above"),
        (F.col("_negative") + F.sum("negative").over(running)).alias("negatives_above"),
    )


def areas(curve: DataFrame) -> DataFrame:
    """One row: area under the ROC curve and under the precision-recall curve.

    The first is the share of pairs of a positive and a negative row that the score
    orders rightly, equal scores counting half: a sum of ranks.  The second joins
    the points of all thresholds by straight lines, from the first one's precision on.
    Missing where there are no rows of either class, or no positive ones.
    """
    positive, negative = F.col("positive"), F.col("negative")
    true, false = F.col("positives_above"), F.col("negatives_above")
    ordered = negative.cast("double") * (true - positive + positive / 2.0)
    precision = true / (true + false)
    before = true + false - positive - negative
    earlier = F.when(before > 0, (true - positive) / F.nullif(before, F.lit(0))).otherwise(precision)
    pairs = F.sum("positive").cast("double") * F.sum("negative")
    return curve.agg(
        F.when(pairs > 0, F.sum(ordered) / F.nullif(pairs, F.lit(0.0))).alias("auc_roc"),
        F.try_divide(F.sum(positive * (precision + earlier) / 2.0), F.sum("positive")).alias("auc_pr"),
    )


def class_scores(matrix: DataFrame) -> DataFrame:
    """One row per metric of a confusion matrix (label, prediction, loans).

    Precision, recall and F1 of each label are weighted by its rows; a label that is
    never predicted has precision 0.
    """
    hit = F.col(LABEL) == F.col("prediction")
    actual = matrix.groupBy(F.col(LABEL).alias("label")).agg(
        F.sum("loans").alias("rows"), F.sum(F.when(hit, F.col("loans")).otherwise(0)).alias("right")
    )
    predicted = matrix.groupBy(F.col("prediction").alias("label")).agg(
        F.sum("loans").alias("predicted")
    )
    joined = actual.join(predicted, "label", "left")
    precision = F.coalesce(F.try_divide("right", "predicted"), F.lit(0.0))
    recall = F.col("right") / F.col("rows")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    weighted = lambda value: F.try_divide(F.sum(value * F.col("rows")), F.sum("rows"))
    wide = joined.agg(
        F.try_divide(F.sum("right"), F.sum("rows")).alias("accuracy"),
        weighted(f1).alias("f1"),
        weighted(precision).alias("precision_weighted"),
        weighted(recall).alias("recall_weighted"),
    )
    return wide.unpivot([], wide.columns, "metric", "value")
