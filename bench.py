"""Headline timings. Prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) names the tables, ``BENCH_CPUS`` (default 8) the cores, ``BENCH_ROUNDS`` (default 100)
the boosting rounds. The stages are those of a full run: parse raw lines and extract features, fit and apply the
detector, cluster the anomalies, fit the classifier, score everything; then the report queries on the stored tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "100"))

    from rotorlens.functions.spectral import extract_features
    from rotorlens.operators import alerts as A
    from rotorlens.operators import report as R
    from rotorlens.operators.classify import fault_classifier_fit
    from rotorlens.operators.clustering import kmeans_fit, kmeans_predict
    from rotorlens.operators.filters import anomalies
    from rotorlens.operators.iforest import isolation_forest_fit
    from rotorlens.operators.scaling import standard_scale_fit
    from rotorlens.plans import fixtures as fx
    from rotorlens.plans.models import Models, predict_batch
    from rotorlens.schema import MODEL_INPUTS
    from rotorlens.session import build_session, materialise, scratch_path
    from rotorlens.sources.spectra import read_spectra

    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, action):
        start = time.time()
        result = action()
        times[name] = round(time.time() - start, 3)
        return result

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    raw = scratch_path(spark, "bench-raw")
    fx.raw_lines(spark, sf_dir).write.text(raw)  # input of the run, not timed

    features = timed("preprocess", lambda: materialise(extract_features(read_spectra(spark, raw)), "bench-features"))
    rows = features.count()
    scaler = timed("scale_fit", lambda: standard_scale_fit(features, MODEL_INPUTS))
    scaled = scaler.vector(features).select("record_id", "x")
    forest = timed("detect_fit", lambda: isolation_forest_fit(scaled, 0.2, rows=rows))
    found = timed("detect", lambda: materialise(
        forest.predict(scaled).filter("is_anomaly").select("record_id", "x"), "bench-anomalies"))
    kmeans = timed("cluster", lambda: kmeans_fit(found))
    labelled = materialise(kmeans_predict(kmeans, found, name="label"), "bench-labelled")
    classifier = timed("classify_fit", lambda: fault_classifier_fit(labelled, MODEL_INPUTS, n_estimators=rounds))
    models = Models(tuple(MODEL_INPUTS), scaler, forest, kmeans, classifier)
    scored = timed("predict_batch", lambda: materialise(
        A.label_predictions(predict_batch(features, models)), "bench-predictions"))

    report = A.report_frame(scored)
    alerts = anomalies(report)
    queries = {
        "kpi_row": lambda: R.kpi_row(report),
        "fault_distribution": lambda: R.fault_distribution(scored),
        "fault_by_severity": lambda: R.fault_by_severity(alerts),
        "severity_crest": lambda: A.report_alerts(report),
        "box_stats": lambda: R.box_statistics(alerts, "crest_factor"),
        "score_histogram": lambda: R.score_histogram(scored),
        "latest_alerts": lambda: R.latest_alerts(alerts),
        "indicator_evolution": lambda: R.indicator_evolution(report),
        "persistence_rows": lambda: A.persistence_by_rows(scored),
        "persistence_range": lambda: A.persistence_by_time(scored, 6 * 3600 * 1000),
        "extreme_scores": lambda: A.extreme_scores(scored),
    }
    for name, make in queries.items():
        timed(name, lambda make=make: run(make()))

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "rows": rows, "boosting_rounds": rounds,
        "preprocess_records_per_sec": round(rows / times["preprocess"]),
        "predict_records_per_sec": round(rows / times["predict_batch"]),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
