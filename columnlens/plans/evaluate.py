"""Labels found against labels given by hand.

``semantic`` is the output of ``semantic_types`` with the key ``dataset``;
``worklist`` has ``idx, dataset, column`` and ``truth`` has ``idx, labels``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed

COLUMN = ["dataset", "column"]


def manual_labels(worklist: DataFrame, truth: DataFrame) -> DataFrame:
    """The hand-made labels of each entry: ``dataset_name, column_name, manual_labels``."""
    return worklist.join(truth, "idx").select(
        F.col("dataset").alias("dataset_name"),
        F.col("column").alias("column_name"),
        F.transform(
            "labels", lambda label: F.struct(label.alias("semantic_type"))
        ).alias("manual_labels"),
    )


def label_lines(worklist: DataFrame, truth: DataFrame) -> DataFrame:
    """The label file as ``idx, value``: the vocabulary under -1, then an object per entry."""
    entries = worklist.join(truth, "idx").select(
        "idx",
        F.to_json(
            F.struct(
                F.col("dataset").alias("dataset_name"),
                F.col("column").alias("column_name"),
                F.transform("labels", lambda label: F.struct(label.alias("semantic_type"))).alias("manual_labels"),
            )
        ).alias("value"),
    )
    vocabulary = worklist.sparkSession.range(1).select(
        F.lit(-1).alias("idx"),
        F.to_json(F.struct(F.array(*[F.lit(t) for t in fixed.SEMANTIC_TYPES]).alias("actual_types"))).alias("value"),
    )
    return vocabulary.unionByName(entries)


def unmatched_labels(worklist: DataFrame, truth: DataFrame) -> DataFrame:
    """Label rows without a work-list entry."""
    return truth.join(worklist, "idx", "left_anti")


def distinct_worklist(worklist: DataFrame, truth: DataFrame) -> DataFrame:
    """Work list with labels, ``idx, dataset, column, labels``, each column once.

    A column listed twice counts once, under its first index.
    """
    return (
        worklist.join(truth, "idx")
        .groupBy(*COLUMN)
        .agg(F.min(F.struct("idx", "labels")).alias("first"))
        .select("first.idx", *COLUMN, "first.labels")
    )


def predicted_types(
    semantic: DataFrame, labelled: DataFrame, k: int | str = "truth"
) -> DataFrame:
    """The types a column is taken to have: ``idx, label, rank, correct``.

    The ``k`` most frequent ones; ``k='truth'`` takes as many as there are
    hand-made labels.  ``labelled`` comes from ``distinct_worklist``.
    """
    limit: Column = F.size("labels") if k == "truth" else F.lit(k)
    return (
        semantic.join(labelled, COLUMN)
        .filter(F.col("rank") <= limit)
        .select(
            "idx", "label", "rank",
            F.array_contains("labels", F.col("label")).alias("correct"),
        )
    )


def label_counts(labelled: DataFrame) -> DataFrame:
    """How many columns have each hand-made label: ``label, actual``."""
    return (
        labelled.select(F.explode("labels").alias("label"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("actual"))
    )


def predicted_counts(predicted: DataFrame) -> DataFrame:
    """How many columns are taken to have each label: ``label, predicted``."""
    return predicted.groupBy("label").agg(F.count(F.lit(1)).alias("predicted"))


def correct_counts(predicted: DataFrame) -> DataFrame:
    """How many of those are right: ``label, correct``."""
    return (
        predicted.filter("correct").groupBy("label").agg(F.count(F.lit(1)).alias("correct"))
    )


def precision_recall(predicted: DataFrame, labelled: DataFrame) -> DataFrame:
    """Per hand-made label: ``label, actual, predicted, correct, precision, recall``.

    Both rates are 0 for a label that was never right.
    """
    found = predicted.groupBy("label").agg(
        F.count(F.lit(1)).alias("predicted"), F.count_if("correct").alias("correct")
    )
    counted = label_counts(labelled).join(found, "label", "left").na.fill(
        0, ["predicted", "correct"]
    )
    return counted.select(
        "*",
        F.coalesce(F.try_divide("correct", "predicted"), F.lit(0.0)).alias("precision"),
        (F.col("correct") / F.col("actual")).alias("recall"),
    )


def column_precision(semantic: DataFrame, labelled: DataFrame) -> DataFrame:
    """Share of a column's filled cells whose type is a hand-made label.

    ``idx, dataset, column, precision``; NULL for a column without filled cells.
    """
    right = F.array_contains("labels", F.col("label"))
    return (
        labelled.join(semantic, COLUMN, "left")
        .groupBy("idx", *COLUMN)
        .agg(
            F.try_divide(
                F.sum(F.when(right, F.col("cnt")).otherwise(0)).cast("double"), F.sum("cnt")
            ).alias("precision")
        )
    )
