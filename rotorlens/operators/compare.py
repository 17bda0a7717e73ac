"""Isolation forest against local outlier factor under the same contamination and the same k-means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlens.operators.clustering import KMeans, kmeans_predict, silhouette
from rotorlens.operators.iforest import IsolationForest
from rotorlens.operators.lof import NEIGHBOURS, local_outlier_factor
from rotorlens.operators.quantiles import exact_quantiles
from rotorlens.session import materialise


def lof_anomalies(df: DataFrame, contamination: float, k: int = NEIGHBOURS, x: str = "x",
                  record_id: str = "record_id") -> DataFrame:
    """``record_id, lof, is_anomaly``: anomalous are the records whose -LOF lies below the contamination quantile."""
    scores = materialise(local_outlier_factor(df, k, x, record_id).withColumn("_score", -F.col("lof")), "lof")
    limit = exact_quantiles(scores, "_score", [contamination]).first()["quantile"]
    return scores.withColumn("is_anomaly", F.col("_score") < F.lit(limit)).drop("_score")


def detector_comparison(df: DataFrame, forest: IsolationForest, kmeans: KMeans, k: int = NEIGHBOURS,
                        x: str = "x", record_id: str = "record_id") -> DataFrame:
    """One row per detector: anomalies, share, silhouette; difference and relative difference on the first row."""
    spark = df.sparkSession
    flagged = materialise(forest.predict(df.select(record_id, x), x), "flagged")
    total, found = flagged.agg(F.count("*"), F.count_if("is_anomaly")).first()
    lof = lof_anomalies(df, found / total, k, x, record_id).filter("is_anomaly")
    chosen = {
        "Isolation Forest": flagged.filter("is_anomaly").select(record_id, x),
        f"LOF (n_neighbors={k})": df.select(record_id, x).join(lof.select(record_id), record_id, "left_semi"),
    }
    rows = []
    for name, anomalous in chosen.items():
        clustered = materialise(kmeans_predict(kmeans, anomalous, x), "clustered")
        score = silhouette(clustered, label="cluster", x=x, record_id=record_id).first()["silhouette"]
        rows.append((name, clustered.count(), float(score)))
    difference = rows[0][2] - rows[1][2]
    relative = 100.0 * difference / rows[1][2] if rows[1][2] else None
    out = [(name, n, 100.0 * n / total, score, difference if i == 0 else None, relative if i == 0 else None)
           for i, (name, n, score) in enumerate(rows)]
    return spark.createDataFrame(
        out, "detector string, anomalies long, pct double, silhouette double, difference double, relative_pct double")
