"""Classification metrics from the table of (label, prediction) counts, one row per pair of classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pair_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, classes: Sequence[int], label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """One row per true class, one column ``pred_<class>`` per predicted class."""
    pairs = pair_counts(df, label, prediction)
    counts = pairs.groupBy("label").pivot("prediction", list(classes)).agg(F.sum("n"))
    return counts.select("label", *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"pred_{c}") for c in classes])


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def _ratio(part: Column, total: Column) -> Column:
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def class_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class that occurs as label or prediction."""
    pairs = pair_counts(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), hit.alias("hits"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("hits"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )).alias("s")).select("s.*")
    sums = sides.groupBy("class").agg(F.sum("hits").alias("hits"), F.sum("support").alias("support"),
                                      F.sum("predicted").alias("predicted"))
    rated = sums.withColumns({"precision": _ratio(F.col("hits"), F.col("predicted")),
                              "recall": _ratio(F.col("hits"), F.col("support"))})
    f1 = _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rated.select("class", "precision", "recall", f1.alias("f1"), "support", "hits")


def accuracy_f1_macro(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and the unweighted mean of the class F1 scores."""
    scores = class_scores(df, label, prediction)
    return scores.agg((F.sum("hits") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("f1_macro"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Class rows, then ``accuracy``, ``macro avg`` and ``weighted avg``."""
    scores = class_scores(df, label, prediction)
    per_class = scores.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    total = F.sum("support")
    none = F.lit(None).cast("double")
    share = scores.agg(F.lit("accuracy").alias("class"), none.alias("precision"), none.alias("recall"),
                       (F.sum("hits") / total).alias("f1"), total.alias("support"))
    macro = scores.agg(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")],
                       total.alias("support"))
    weighted = scores.agg(F.lit("weighted avg").alias("class"), *[
        (F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in ("precision", "recall", "f1")],
        total.alias("support"))
    return per_class.unionByName(share).unionByName(macro).unionByName(weighted)


def cv_summary(folds: DataFrame, score: str = "accuracy") -> DataFrame:
    """Mean and population standard deviation of the fold scores."""
    return folds.agg(F.avg(score).alias("mean_accuracy"), F.stddev_pop(score).alias("std_accuracy"),
                     F.count("*").alias("folds"))
