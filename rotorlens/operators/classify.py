"""Fault classifier: multinomial gradient boosting, its stratified cross-validation and training on confirmed labels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlens.operators.boosting import BINS, Ensemble, boost
from rotorlens.operators.sampling import hash_rank
from rotorlens.session import materialise

ESTIMATORS = 100
LEARNING_RATE = 0.1
DEPTH = 5
FOLDS = 5


@dataclass(frozen=True)
class FaultClassifier:
    """One softmax model over all classes; its probabilities sum to 1."""

    model: Ensemble
    columns: tuple[str, ...]

    @property
    def classes(self) -> tuple[int, ...]:
        return self.model.classes

    def predict(self, df: DataFrame, x: str = "x", only: Column | None = None) -> DataFrame:
        """Add ``probability`` (array in class order), ``prediction`` and ``confidence``.

        Rows where ``only`` is not true get nulls: the model gets no values for them, and the plan stays a single pass
        over ``df``. Equal probabilities: the first class.
        """
        given = F.col(x) if only is None else F.when(only, F.col(x))
        out = df.withColumn("probability", self.model.probability_column(given))
        best = F.array_max("probability")
        index = F.array_position("probability", best).cast("int")
        chosen = F.element_at(F.array(*[F.lit(int(c)) for c in self.classes]), index)
        # Spark takes an element of a literal array to be there, even at an unknown place.
        return out.withColumns({"confidence": best, "prediction": F.when(F.col("probability").isNotNull(), chosen)})

    def importances(self) -> np.ndarray:
        """Share of each feature in the reductions of squared error of all trees."""
        return self.model.importances(len(self.columns))

    def importance_table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, float(v)) for c, v in zip(self.columns, self.importances())]
        return spark.createDataFrame(rows, "feature string, importance double")

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """All trees, a row per node."""
        return self.model.to_frame(spark)

    def save(self, path: str, spark: SparkSession) -> None:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, columns: Sequence[str]) -> FaultClassifier:
        return FaultClassifier(Ensemble.from_frame(spark.read.parquet(path)), tuple(columns))


def _classes(df: DataFrame, label: str) -> list[int]:
    found = df.select(F.col(label).cast("int").alias("c")).where("c is not null").distinct().orderBy("c")
    return [r["c"] for r in found.collect()]  # a few classes


def fault_classifier_fit(
    df: DataFrame, columns: Sequence[str], label: str = "label", x: str = "x", n_estimators: int = ESTIMATORS,
    learning_rate: float = LEARNING_RATE, depth: int = DEPTH, bins: int = BINS,
) -> FaultClassifier:
    """Fit on an array column and an integer label; rows without a label are left out. The input should be a stored
    table. A single class gets probability 1."""
    classes = _classes(df, label)
    rounds = n_estimators if len(classes) > 1 else 0
    models, _ = boost(df, classes, label, x, len(columns), rounds, learning_rate, depth, bins=bins)
    return FaultClassifier(models[-1], tuple(columns))


def stratified_folds(df: DataFrame, label: str = "label", folds: int = FOLDS, seed: int = 42,
                     record_id: str = "record_id") -> DataFrame:
    """Shuffled folds that split every class evenly: rank in hash order within the class, modulo ``folds``."""
    ranked = hash_rank(df, [label], record_id, seed, "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop("_rank")


def fit_and_validate(
    df: DataFrame, columns: Sequence[str], label: str = "label", x: str = "x", folds: int = FOLDS, seed: int = 42,
    record_id: str = "record_id", n_estimators: int = ESTIMATORS, learning_rate: float = LEARNING_RATE, depth: int = DEPTH,
    bins: int = BINS,
) -> tuple[FaultClassifier, DataFrame]:
    """The classifier of all rows, and ``fold, accuracy, rows`` of the models that left one fold out each; all of them
    are grown by the same jobs."""
    placed = materialise(stratified_folds(df.select(record_id, label, x), label, folds, seed, record_id), "folds")
    classes = _classes(placed, label)
    rounds = n_estimators if len(classes) > 1 else 0
    models, judged = boost(placed, classes, label, x, len(columns), rounds, learning_rate, depth, "fold", folds, bins)
    scores = judged.groupBy("fold").agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                                        F.count("*").alias("rows"))
    return FaultClassifier(models[-1], tuple(columns)), materialise(scores, "fold-scores")


def cross_validate(df: DataFrame, columns: Sequence[str], label: str = "label", x: str = "x", folds: int = FOLDS, seed: int = 42,
                   record_id: str = "record_id", **fit_options) -> DataFrame:
    """Accuracy per fold: ``fold, accuracy, rows``."""
    return fit_and_validate(df, columns, label, x, folds, seed, record_id, **fit_options)[1]


def supervised_fit(features: DataFrame, confirmed: DataFrame, columns: Sequence[str], label: str = "label",
                   x: str = "x", record_id: str = "record_id", **fit_options) -> FaultClassifier:
    """Train on confirmed labels, joined by record id, instead of cluster numbers."""
    joined = features.join(confirmed.select(record_id, label), record_id)
    return fault_classifier_fit(materialise(joined.select(x, label), "confirmed"), columns, label, x, **fit_options)
