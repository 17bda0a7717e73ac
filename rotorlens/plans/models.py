"""Training, storing, loading and applying the models, end to end."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlens.functions.labels import fault_description, probabilities_map, round_confidence
from rotorlens.functions.numeric import contamination_for
from rotorlens.operators.classify import ESTIMATORS, FOLDS, FaultClassifier, fault_classifier_fit, fit_and_validate
from rotorlens.operators.clustering import STARTS, KMeans, kmeans_fit, kmeans_predict
from rotorlens.operators.iforest import SUB_SAMPLE, TREES, IsolationForest, isolation_forest_fit
from rotorlens.operators.metrics import accuracy_f1_macro, classification_report, confusion_matrix, cv_summary
from rotorlens.operators.report import distribution, top_by
from rotorlens.operators.scaling import Scaler, standard_scale_fit
from rotorlens.schema import MODEL_INPUTS, N_CLUSTERS, NORMAL_CODE
from rotorlens.session import materialise
from rotorlens.sources.tables import select_model_inputs


@dataclass(frozen=True)
class Models:
    columns: tuple[str, ...]
    scaler: Scaler
    forest: IsolationForest
    kmeans: KMeans
    classifier: FaultClassifier


@dataclass(frozen=True)
class Training:
    models: Models
    labelled: DataFrame  # the anomalies: record_id, x, label (a stored table)
    tables: dict[str, DataFrame]


def fit_detector(
    features: DataFrame, columns: Sequence[str] = tuple(MODEL_INPUTS), contamination: float | None = None,
    trees: int = TREES, max_samples: int = SUB_SAMPLE, seed: int = 42,
) -> tuple[Scaler, IsolationForest]:
    """Scaler and isolation forest. ``features`` should be a stored table: it is read several times."""
    inputs = select_model_inputs(features, columns)
    rows = inputs.count()
    share = contamination_for(rows) if contamination is None else contamination
    scaler = standard_scale_fit(inputs, columns)
    scaled = scaler.vector(inputs).select("record_id", "x")
    return scaler, isolation_forest_fit(scaled, share, trees, max_samples, seed, rows=rows)


def fit_clusters(
    features: DataFrame, scaler: Scaler, forest: IsolationForest, clusters: int = N_CLUSTERS, n_init: int = STARTS,
    seed: int = 42,
) -> tuple[KMeans, DataFrame]:
    """K-means on the anomalies, and the anomalies with their cluster: ``record_id, x, label`` (a stored table)."""
    inputs = select_model_inputs(features, scaler.columns)
    flagged = forest.predict(scaler.vector(inputs).select("record_id", "x"))
    anomalous = materialise(flagged.filter("is_anomaly").select("record_id", "x"), "anomalies")
    kmeans = kmeans_fit(anomalous, clusters, n_init, seed)
    return kmeans, materialise(kmeans_predict(kmeans, anomalous, name="label"), "labelled")


def train(
    features: DataFrame, columns: Sequence[str] = tuple(MODEL_INPUTS), contamination: float | None = None,
    trees: int = TREES, max_samples: int = SUB_SAMPLE, clusters: int = N_CLUSTERS, n_init: int = STARTS,
    n_estimators: int = ESTIMATORS, folds: int | None = FOLDS, seed: int = 42,
) -> Training:
    """Scale, detect, cluster the anomalies, cross-validate and fit the classifier on the cluster labels."""
    scaler, forest = fit_detector(features, columns, contamination, trees, max_samples, seed)
    kmeans, labelled = fit_clusters(features, scaler, forest, clusters, n_init, seed)
    tables = {"cluster_distribution": distribution(labelled, "label")}
    if folds:
        classifier, tables["folds"] = fit_and_validate(labelled, columns, folds=folds, seed=seed, n_estimators=n_estimators)
        tables["cv_summary"] = cv_summary(tables["folds"])
    else:
        classifier = fault_classifier_fit(labelled, columns, n_estimators=n_estimators)
    fitted = classifier.predict(labelled).select("record_id", "label", "prediction", "confidence")
    tables.update({
        "train_predictions": fitted,
        "accuracy_f1_macro": accuracy_f1_macro(fitted),
        "confusion_matrix": confusion_matrix(fitted, classifier.classes),
        "classification_report": classification_report(fitted),
        "top_features": top_by(classifier.importance_table(features.sparkSession), "importance", 5),
    })
    return Training(Models(tuple(columns), scaler, forest, kmeans, classifier), labelled, tables)


def save_models(models: Models, path: str, spark: SparkSession) -> None:
    """Small tables: the scaler, the trees of both kinds, the centres and the ordered feature names."""
    models.scaler.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")
    models.forest.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/forest")
    models.kmeans.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/kmeans")
    models.classifier.save(f"{path}/classifier", spark)
    spark.createDataFrame([(i, c) for i, c in enumerate(models.columns)], "position int, name string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/feature_names")


def load_models(spark: SparkSession, path: str) -> Models:
    names = spark.read.parquet(f"{path}/feature_names").orderBy("position").collect()  # one row per column
    columns = tuple(r["name"] for r in names)
    return Models(
        columns,
        Scaler.from_frame(spark.read.parquet(f"{path}/scaler")),
        IsolationForest.from_frame(spark.read.parquet(f"{path}/forest")),
        KMeans.from_frame(spark.read.parquet(f"{path}/kmeans")),
        FaultClassifier.load(spark, f"{path}/classifier", columns),
    )


def predict_batch(df: DataFrame, models: Models, keep: Sequence[str] | None = None) -> DataFrame:
    """Score every record; classify the anomalies only. Lazy, and the same on streams.

    ``keep`` names the input columns to carry along (all by default), so alerts need no join with their metadata.
    """
    kept = list(df.columns if keep is None else keep)
    select_model_inputs(df, models.columns, keep=())  # raises where a column is missing
    flagged = models.forest.predict(models.scaler.vector(df, "_x"), "_x")
    rated = models.classifier.predict(flagged, "_x", only=F.col("is_anomaly"))
    return rated.select(
        *kept, "anomaly_score", "is_anomaly",
        F.coalesce(F.col("prediction").cast("int"), F.lit(NORMAL_CODE)).alias("fault_type"),
        fault_description(F.col("prediction").cast("int")).alias("fault_description"),
        F.coalesce(round_confidence(F.col("confidence")), F.lit(0.0)).alias("confidence"),
        probabilities_map(F.col("probability"), F.col("is_anomaly")).alias("probabilities"))
