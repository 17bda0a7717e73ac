"""Registered queries. Each takes ``(spark, sf_dir)``, reads whole tables and returns a lazy frame."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlens.functions import labels as L
from rotorlens.functions import numeric as N
from rotorlens.functions import spectral as X
from rotorlens.operators import alerts as A
from rotorlens.operators import classify as CL
from rotorlens.operators import clustering as C
from rotorlens.operators import compare as CMP
from rotorlens.operators import filters as FL
from rotorlens.operators import group_iforest as G
from rotorlens.operators import iforest as I
from rotorlens.operators import joins as J
from rotorlens.operators import lof as LOF
from rotorlens.operators import metrics as MT
from rotorlens.operators import report as R
from rotorlens.operators import sampling as S
from rotorlens.operators import scaling as SC
from rotorlens.plans import fixtures as fx
from rotorlens.plans import models as M
from rotorlens.plans.table_queries import TABLE_QUERIES
from rotorlens.schema import (
    FAULT_LABELS,
    LABEL_TRANSLATION,
    MODEL_INPUTS,
    SILHOUETTE_SAMPLE,
    SPECTRAL_FEATURES,
    UNKNOWN_ALERT_LABEL,
    fault_dimension,
)
from rotorlens.session import materialise, scratch_path
from rotorlens.sources import spectra as SRC
from rotorlens.sources import tables as TB
from rotorlens.streaming import streams as ST

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    """Round doubles so that the last bits of differently ordered sums do not matter (and -0.0 becomes 0.0)."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# --- Ingest ---

def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return SRC.parse_lines(fx.raw_lines(spark, sf))


def ingest_valid(spark: SparkSession, sf: str) -> DataFrame:
    valid = SRC.valid_spectra(_parsed(spark, sf))
    out = valid.select("dev_eui", "mode", "axis", "ts_ms", "temp", F.size("spectrum").alias("points"),
                       X.energy(F.col("spectrum")).alias("energy"))
    return rounded(out, "energy")


def ingest_discards(spark: SparkSession, sf: str) -> DataFrame:
    return SRC.discard_counts(_parsed(spark, sf))


def ingest_pairwise(spark: SparkSession, sf: str) -> DataFrame:
    """Non-strict parsing: a bad value costs one reading, not the record."""
    parsed = SRC.parse_lines(fx.raw_lines(spark, sf), strict=False)
    return SRC.valid_spectra(parsed).groupBy(F.size("spectrum").alias("points")).agg(F.count("*").alias("n"))


def ingest_lenient(spark: SparkSession, sf: str) -> DataFrame:
    spectra = SRC.parse_lines_lenient(fx.raw_lines(spark, sf), limit=None)
    return rounded(spectra.select(F.size("spectrum").alias("points"), X.energy(F.col("spectrum")).alias("energy")),
                   "energy")


def raw_features_by_device(spark: SparkSession, sf: str) -> DataFrame:
    """Raw JSON lines to an aggregate: the flagship query."""
    features = X.extract_features(SRC.valid_spectra(_parsed(spark, sf)))
    out = features.groupBy("dev_eui").agg(
        F.count("*").alias("records"), F.avg("rms").alias("mean_rms"), F.max("crest_factor").alias("max_crest"))
    return rounded(out, "mean_rms", "max_crest")


# --- Features and scalar functions ---

def features_all(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fx.features(spark, sf), *SPECTRAL_FEATURES)


def features_eda(spark: SparkSession, sf: str) -> DataFrame:
    out = X.extract_features_eda(fx.spectra(spark, sf)).select("record_id", *SPECTRAL_FEATURES)
    return rounded(out, *SPECTRAL_FEATURES)


def features_scrub(spark: SparkSession, sf: str) -> DataFrame:
    """Features of spectra whose amplitudes or temperature are not finite for some events."""
    kind = F.col("event_id") % 9
    bad = F.when(kind == 1, float("nan")).when(kind == 2, float("inf"))
    spectra = fx.spectra(spark, sf).withColumns({
        "spectrum": F.transform("spectrum", lambda p: F.struct(
            p["freq"].alias("freq"), F.coalesce(bad, p["value"]).alias("value"))),
        "temp": F.when(kind == 3, float("-inf")).when(kind != 4, F.col("temp")),
    })
    columns = ["rms", "temp", "ratio_low", "crest_factor", "peak_to_peak", "dominant_frequency"]
    return rounded(X.extract_features(spectra).select("record_id", *columns), *columns)


def label_columns(spark: SparkSession, sf: str) -> DataFrame:
    frame = fx.spectra(spark, sf).select("record_id", "event_id", "mode", "axis", "ts_ms")
    frame = fx.pseudo_predictions(frame)
    described = L.fault_description(F.col("fault_type"))
    return frame.select(
        "record_id", L.event_time(F.col("ts_ms")).cast("timestamp_ntz").alias("timestamp"),
        L.axis_label(F.col("axis")).alias("axis_label"), L.mode_label(F.col("mode")).alias("mode_label"),
        described.alias("fault_description"), L.alert_label(F.col("fault_type")).alias("alert_label"),
        L.translate_label(described).alias("translated"), L.short_label(described).alias("short"))


def dominant_peak(spark: SparkSession, sf: str) -> DataFrame:
    peak = X.dominant_peak(F.col("spectrum"))
    out = fx.spectra(spark, sf).select("record_id", peak.alias("p")).select(
        "record_id", F.col("p.freq").alias("freq"), F.col("p.amplitude").alias("amplitude"))
    return rounded(out, "freq", "amplitude")


def harmonic_energy(spark: SparkSession, sf: str) -> DataFrame:
    f0 = F.lit(fx.SHAFT_HZ)
    out = fx.spectra(spark, sf).select(
        "record_id", *[X.harmonic_energy(F.col("spectrum"), f0, k).alias(f"h{k}") for k in (1, 2, 3)])
    return rounded(out, "h1", "h2", "h3")


def rule_diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    diagnosis = X.rule_diagnosis(F.col("spectrum"), F.lit(fx.SHAFT_HZ), share=0.02, harmonic_share=0.05)
    return fx.spectra(spark, sf).select("record_id", diagnosis.alias("diagnosis"))


# --- Filters and samples ---

def temp_range(spark: SparkSession, sf: str) -> DataFrame:
    return FL.plausible_temperature(fx.spectra(spark, sf)).select("record_id", "temp")


def min_group(spark: SparkSession, sf: str) -> DataFrame:
    base = fx.spectra(spark, sf).select("record_id", *FL.SERIES)
    return FL.min_group_size(base, minimum=210)


def group_sample_cap(spark: SparkSession, sf: str) -> DataFrame:
    base = fx.spectra(spark, sf).select("record_id", "dev_eui")
    return S.group_sample_cap(base, ["dev_eui"], cap=1000)


def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return S.hash_sample(fx.spectra(spark, sf).select("record_id", "dev_eui"), 1000)


def numbered_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct ids for copies of one record; one id holds a third of all rows."""
    copies = fx._table(spark, sf, "events").select(
        F.when(F.col("event_id") % 3 == 0, "hot").otherwise((F.col("event_id") % 97).cast("string")).alias("record_id"))
    return S.number_copies(copies)


def repeated_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines of which every third comes twice: parsed, given features, joined with predictions; a row per line."""
    spectra = fx.spectra(spark, sf)
    lines = fx.lines_from(spectra).unionByName(fx.lines_from(spectra.filter("event_id % 3 = 0")))
    parsed = X.extract_features(SRC.valid_spectra(SRC.parse_lines(SRC.numbered_lines(lines))))
    # Both sides of the join need them: stored, so that the lines are parsed once.
    features = materialise(parsed.select("record_id", "dev_eui", "rms"), "line-features")
    flags = features.select("record_id", (F.col("rms") > 0).alias("is_anomaly"))
    joined = J.features_with_predictions(features.select("record_id", "dev_eui"), flags)
    return joined.groupBy("dev_eui").agg(F.count("*").alias("n"), F.count_distinct("record_id").alias("ids"))


def example_records(spark: SparkSession, sf: str) -> DataFrame:
    """Random single and four records, and the first five."""
    base = fx.spectra(spark, sf).select("record_id")
    picks = [("one", S.hash_sample(base, 1, seed=1)), ("four", S.hash_sample(base, 4, seed=2)),
             ("first", S.first_records(base, 5))]
    frames = [frame.select("record_id", F.lit(name).alias("pick")) for name, frame in picks]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# --- Joins and prediction tables ---

def pred_jsonl_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Prediction lines, half of them as lists of two, every 7th damaged, written as text and flattened."""
    base = fx.predictions(spark, sf)
    one = F.to_json(F.struct("record_id", "is_anomaly", "fault_type", "confidence"))
    two = F.concat(F.lit("["), one, F.lit(","), one, F.lit("]"))
    lines = base.select(F.when(F.col("event_id") % 7 == 0, F.lit("{broken"))
                        .when(F.col("event_id") % 2 == 0, two).otherwise(one).alias("value"))
    return TB.parse_predictions(lines).select("record_id", "is_anomaly", "fault_type", "confidence")


def features_join_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Full join; every 11th record has no prediction, every 13th no features."""
    spectra = fx.spectra(spark, sf).filter("event_id % 13 <> 0")
    features = X.extract_features(spectra).select("record_id", "dev_eui", "rms")
    predictions = fx.predictions(spark, sf).filter("event_id % 11 <> 0") \
        .select("record_id", "is_anomaly", "fault_type", F.lit("x").alias("dev_eui"))
    return rounded(J.features_with_predictions(features, predictions), "rms")


def metadata_first(spark: SparkSession, sf: str) -> DataFrame:
    features = fx.spectra(spark, sf).select("record_id", "dev_eui", "mode", "axis", "ts_ms")
    predictions = fx.predictions(spark, sf).select("record_id", "is_anomaly", "fault_label", "severity_level")
    return J.metadata_with_predictions(features, predictions)


def alerts_left_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions keep their row where metadata is missing; labels and severities as in the alert table."""
    meta = fx.spectra(spark, sf).filter("event_id % 11 <> 0").select("record_id", "dev_eui", "mode", "axis", "ts_ms")
    predictions = fx.predictions(spark, sf).select("record_id", "is_anomaly", "fault_type", "confidence")
    return J.predictions_left_metadata(A.rederive_alerts(predictions), meta)


def label_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Code to label through the dimension table, with a default for codes it does not know."""
    codes = fx.predictions(spark, sf).select(
        "record_id", F.when(F.col("event_id") % 17 == 0, 9).otherwise(F.col("fault_type")).alias("fault_type"))
    return J.with_dimension(codes, fault_dimension(spark), "fault_type", UNKNOWN_ALERT_LABEL)


# --- Severity ---

def severity_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return fx.predictions(spark, sf).select("record_id", "fault_label", "confidence", "severity_level")


def severity_crest(spark: SparkSession, sf: str) -> DataFrame:
    return A.report_alerts(fx.scored(spark, sf)).select("record_id", "severity_crest")


def quantiles_crest(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.crest_quantiles(FL.anomalies(fx.scored(spark, sf))), "q50", "q80")


# --- Report ---

def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Anomalies with metadata, without the spectral features."""
    meta = fx.spectra(spark, sf).select("record_id", "event_id", "dev_eui", "mode", "axis", "ts_ms")
    return FL.anomalies(A.report_frame(A.label_predictions(fx.pseudo_predictions(meta))))


def alerts_filtered(spark: SparkSession, sf: str) -> DataFrame:
    shown = [LABEL_TRANSLATION[FAULT_LABELS[c]] for c in (0, 2)]
    kept = FL.alert_filter(_alerts(spark, sf), ["HIGH", "MEDIUM"], shown)
    return kept.select("record_id", "fault_label", "severity_level")




def report_table(spark: SparkSession, sf: str) -> DataFrame:
    """The alert report under its display names."""
    frame = _alerts(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return FL.report_columns(frame)


def kpi_row(spark: SparkSession, sf: str) -> DataFrame:
    meta = fx.spectra(spark, sf).select("record_id", "event_id", "dev_eui", "mode", "axis", "ts_ms")
    frame = A.report_frame(A.label_predictions(fx.pseudo_predictions(meta)))
    return rounded(R.kpi_row(frame), "pct_anomalies", "pct_normals")


def anomaly_rate(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.anomaly_rate(fx.predictions(spark, sf)), "pct_anomalies")


def fault_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.fault_distribution(fx.predictions(spark, sf)), "pct")


def fault_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.fault_counts(_alerts(spark, sf))


def severity_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.severity_counts(_alerts(spark, sf))


def fault_by_severity(spark: SparkSession, sf: str) -> DataFrame:
    return R.fault_by_severity(_alerts(spark, sf))


def device_fault_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as predicted, as translated for a report (even ids), and unknown (every ninth)."""
    meta = fx.spectra(spark, sf).select("record_id", "event_id", "dev_eui")
    alerts = FL.anomalies(A.label_predictions(fx.pseudo_predictions(meta)))
    mixed = F.when(F.col("event_id") % 9 == 0, F.lit("unknown")).when(
        F.col("event_id") % 2 == 0, L.translate_label(F.col("fault_label"))).otherwise(F.col("fault_label"))
    return R.device_fault_pivot(alerts.withColumn("fault_label", mixed))


def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = R.box_statistics(FL.anomalies(fx.scored(spark, sf)).select("fault_label", "crest_factor"), "crest_factor")
    return rounded(out, "whisker_low", "q1", "median", "q3", "whisker_high")


def box_outliers(spark: SparkSession, sf: str) -> DataFrame:
    alerts = FL.anomalies(fx.scored(spark, sf)).select("record_id", "fault_label", "rms")
    return R.box_outliers(alerts, "rms").select("record_id", "fault_label")


def score_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return R.score_histogram(fx.predictions(spark, sf))


def score_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.score_threshold(fx.predictions(spark, sf)), "threshold")


def mean_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.mean_confidence(fx.predictions(spark, sf)), "mean_confidence")


def latest_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return R.latest_alerts(_alerts(spark, sf)).select("record_id", "dev_eui", "axis_label", "ts_ms", "fault_label",
                                                      "severity_level")


def clearest_examples(spark: SparkSession, sf: str) -> DataFrame:
    """The clearest records of both classes with the size of their spectra."""
    frame = fx.pseudo_predictions(fx.spectra(spark, sf))
    out = R.clearest_examples(frame).select("record_id", "class", "anomaly_score", F.size("spectrum").alias("points"))
    return rounded(out, "anomaly_score")


def sorted_labels(spark: SparkSession, sf: str) -> DataFrame:
    return R.sorted_labels(_alerts(spark, sf))


def contamination(spark: SparkSession, sf: str) -> DataFrame:
    counted = fx.predictions(spark, sf).agg(F.count("*").alias("n"))
    return counted.select("n", N.adaptive_contamination(F.col("n")).alias("contamination"))


def alerts_per_period(spark: SparkSession, sf: str) -> DataFrame:
    out = R.alerts_per_period(_alerts(spark, sf))
    return out.withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))


def indicator_evolution(spark: SparkSession, sf: str) -> DataFrame:
    frame = A.report_frame(fx.scored(spark, sf))
    out = R.indicator_evolution(frame).withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))
    return rounded(out, "mean_rms", "anomaly_rate")


def fleet_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Every series (device, mode and axis) stands for a device of its own, so that there is a fleet to compare."""
    frame = A.report_frame(fx.scored(spark, sf))
    named = frame.withColumn("dev_eui", F.concat_ws("/", "dev_eui", F.col("mode").cast("int"), F.col("axis").cast("double").cast("int")))
    out = R.fleet_comparison(named).withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))
    return rounded(out.drop("place"), "mean", "fleet_median", "deviation").select(
        "*", F.when(F.abs("deviation") > 1.5, "far").otherwise("near").alias("distance"))


# --- Temporal filters ---

def _series(spark: SparkSession, sf: str) -> DataFrame:
    meta = fx.spectra(spark, sf).select("record_id", "event_id", "dev_eui", "mode", "axis", "ts_ms")
    return fx.pseudo_predictions(meta)


def persistence_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of 1,000 rows, so that series span several blocks."""
    out = A.persistence_by_rows(_series(spark, sf), rows_per_block=1000)
    return out.select("record_id", "persistent")


def persistence_range(spark: SparkSession, sf: str) -> DataFrame:
    return A.persistence_by_time(_series(spark, sf), range_ms=6 * 3600 * 1000).select("record_id", "persistent")


def extreme_scores(spark: SparkSession, sf: str) -> DataFrame:
    return A.extreme_scores(_series(spark, sf), quantile=0.05).select("record_id", "extreme")


def confirmed_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Persistent or extreme."""
    persistent = A.persistence_by_rows(_series(spark, sf))
    return A.combined_flag(A.extreme_scores(persistent, quantile=0.05)).select("record_id", "confirmed")


# --- Scaling, models and metrics ---

_STAGES: dict[tuple[str, str, str], Any] = {}


def _contents(spark: SparkSession, sf: str) -> str:
    """A digest of the rows of the tables that the training stages read."""
    sums = []
    for name in ("events", "embeddings"):
        table = fx._table(spark, sf, name)
        sums.append(table.agg(F.count("*"), F.sum(F.xxhash64(*table.columns).cast("decimal(20,0)"))).first())
    return repr(sums)


def _once(stage: str, spark: SparkSession, sf: str, make: Callable[[], Any]) -> Any:
    """Run a training stage once per session and table contents; queries share the stages they have in common."""
    key = (stage, spark.sparkContext.applicationId, _contents(spark, sf))
    if key not in _STAGES:
        _STAGES[key] = make()
    return _STAGES[key]


def _stored_features(spark: SparkSession, sf: str) -> DataFrame:
    return _once("features", spark, sf, lambda: materialise(fx.features(spark, sf), "features"))


def _detector(spark: SparkSession, sf: str) -> tuple[SC.Scaler, I.IsolationForest]:
    return _once("detector", spark, sf, lambda: M.fit_detector(_stored_features(spark, sf)))


def _clusters(spark: SparkSession, sf: str) -> tuple[C.KMeans, DataFrame]:
    return _once("clusters", spark, sf, lambda: M.fit_clusters(_stored_features(spark, sf), *_detector(spark, sf)))


def _training(spark: SparkSession, sf: str) -> M.Training:
    """The whole training, from stored features to models and metric tables."""
    return _once("training", spark, sf, lambda: M.train(_stored_features(spark, sf)))


def _models(spark: SparkSession, sf: str) -> M.Models:
    return _training(spark, sf).models


def train(spark: SparkSession, sf: str) -> DataFrame:
    """What the whole training found: the sizes of its clusters of anomalies."""
    return rounded(_training(spark, sf).tables["cluster_distribution"], "pct")


def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    features = _stored_features(spark, sf)
    out = SC.standard_scale_fit(features, MODEL_INPUTS).transform(features)
    return rounded(out.select("record_id", *MODEL_INPUTS), *MODEL_INPUTS)


def robust_scale(spark: SparkSession, sf: str) -> DataFrame:
    features = _stored_features(spark, sf)
    out = SC.robust_scale_fit(features, SPECTRAL_FEATURES).transform(features)
    return rounded(out.select("record_id", *SPECTRAL_FEATURES), *SPECTRAL_FEATURES)


def _scaled(spark: SparkSession, sf: str) -> DataFrame:
    return _detector(spark, sf)[0].vector(_stored_features(spark, sf)).select("record_id", "x")


def iforest_scores(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_detector(spark, sf)[1].score(_scaled(spark, sf)).select("record_id", "anomaly_score"), "anomaly_score")


def iforest_predict(spark: SparkSession, sf: str) -> DataFrame:
    """The flagged share follows from the contamination alone."""
    flagged = _detector(spark, sf)[1].predict(_scaled(spark, sf))
    return rounded(R.anomaly_rate(flagged), "pct_anomalies")


def group_iforest(spark: SparkSession, sf: str) -> DataFrame:
    features = _stored_features(spark, sf)
    models = materialise(G.group_forest_fit(features, SPECTRAL_FEATURES), "group-models")
    return G.group_forest_predict(features, models, SPECTRAL_FEATURES).select(
        "record_id", *FL.SERIES, "anomaly_score", "is_anomaly")


def kmeans_best_of_10(spark: SparkSession, sf: str) -> DataFrame:
    return _clusters(spark, sf)[1].select("record_id", "label")


def nearest_centre(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding's nearest of four centres (the embeddings 0 to 3)."""
    points = fx._table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    centres = [r["x"] for r in points.filter("vec_id < 4").orderBy("vec_id").collect()]
    return C.nearest_centre(points, centres).select("vec_id", "cluster")


def cluster_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(R.distribution(fx.labelled(spark, sf), "label"), "pct")


def silhouette_euclid(spark: SparkSession, sf: str) -> DataFrame:
    """Silhouette of the labelled embeddings on a sample of at most 5,000, each cluster compared with whole."""
    points = fx._table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("record_id"), F.transform("embedding", lambda v: v.cast("double")).alias("x"),
        F.col("label").alias("cluster"))
    return rounded(C.silhouette(points, per_cluster=SILHOUETTE_SAMPLE, sample=SILHOUETTE_SAMPLE), "silhouette")


def silhouette_all(spark: SparkSession, sf: str) -> DataFrame:
    """Silhouette with squared distances over all labelled embeddings."""
    points = fx._table(spark, sf, "embeddings").select(
        F.transform("embedding", lambda v: v.cast("double")).alias("x"), F.col("label").alias("cluster"))
    found = spark.createDataFrame([(C.silhouette_squared(points),)], "silhouette double")
    return rounded(found, "silhouette")


def lof_scores(spark: SparkSession, sf: str) -> DataFrame:
    points = fx._table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("record_id"), F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    return rounded(LOF.local_outlier_factor(points), "lof")


def detector_comparison(spark: SparkSession, sf: str) -> DataFrame:
    scaled = materialise(_scaled(spark, sf), "scaled")
    return CMP.detector_comparison(scaled, _detector(spark, sf)[1], _clusters(spark, sf)[0])


def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return CL.stratified_folds(fx.labelled(spark, sf).select("record_id", "label"))


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return MT.confusion_matrix(fx.labelled(spark, sf), range(4))


def accuracy_f1_macro(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(MT.accuracy_f1_macro(fx.labelled(spark, sf)), "accuracy", "f1_macro")


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(MT.classification_report(fx.labelled(spark, sf)), "precision", "recall", "f1")


def fault_classifier(spark: SparkSession, sf: str) -> DataFrame:
    fitted = _models(spark, sf).classifier.predict(_training(spark, sf).labelled)
    return fitted.select("record_id", "label", "prediction", "confidence")


def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _training(spark, sf).tables["cv_summary"]


def feature_importance_top(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_by(_models(spark, sf).classifier.importance_table(spark), "importance", 10)


def supervised_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Training on confirmed labels, joined by record id, instead of cluster numbers."""
    confirmed = fx.labelled(spark, sf).select("record_id", "label")
    points = _clusters(spark, sf)[1].select("record_id", "x")
    model = CL.supervised_fit(points, confirmed, MODEL_INPUTS)
    return model.predict(points).select("record_id", "prediction", "confidence")


def predict_batch(spark: SparkSession, sf: str) -> DataFrame:
    out = M.predict_batch(_stored_features(spark, sf), _models(spark, sf), keep=["record_id"])
    return out.withColumn("probabilities", F.to_json("probabilities"))


def prediction_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What has to hold for every prediction: clean normal records, probabilities that sum to 1."""
    out = M.predict_batch(_stored_features(spark, sf), _models(spark, sf), keep=["record_id"])
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda acc, p: acc + p)
    clean = (F.col("fault_type") == -1) & (F.col("confidence") == 0) & (F.size("probabilities") == 0)
    sound = F.col("fault_type").between(0, 3) & (F.abs(total - 1) < 1e-9) & (F.col("confidence") >= 0.25)
    return out.agg(
        F.count("*").alias("total"), F.count_if("is_anomaly").alias("anomalies"),
        F.count_if(~F.col("is_anomaly") & clean).alias("clean_normals"),
        F.count_if(F.col("is_anomaly") & sound).alias("sound_anomalies"))


def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """What the stored and re-read models find."""
    features, path = _stored_features(spark, sf), scratch_path(spark, "models")
    M.save_models(_models(spark, sf), path, spark)
    after = M.predict_batch(features, M.load_models(spark, path), keep=["record_id"])
    return rounded(after.select("record_id", "anomaly_score", "is_anomaly"), "anomaly_score")


# --- Streams: each runs over all files available and returns the table it wrote ---

def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = fx._table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf}/events*.parquet")
    return fx.spectra_from(events, fx._table(spark, sf, "embeddings"))


def _scored_stream(spark: SparkSession, sf: str) -> DataFrame:
    return fx.pseudo_predictions(_event_stream(spark, sf).select("event_id", "dev_eui", "mode", "axis", "ts_ms"))


def stream_features(spark: SparkSession, sf: str) -> DataFrame:
    table = ST.run_available(ST.stream_features(fx.lines_from(_event_stream(spark, sf))))
    return rounded(table.drop("record_id"), *SPECTRAL_FEATURES)


def stream_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Every record of the stream as the stored models see it."""
    live = X.extract_features(_event_stream(spark, sf))
    table = ST.run_available(ST.stream_predictions(live, _models(spark, sf)))
    sound = (F.col("fault_type") >= 0) == F.col("is_anomaly")
    return table.select("record_id", "is_anomaly", sound.alias("sound"))


def stream_persistence(spark: SparkSession, sf: str) -> DataFrame:
    table = ST.run_updates(ST.persistent_windows(_scored_stream(spark, sf)), ["dev_eui", "mode", "axis", "window_start", "window_end"])
    return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    table = ST.run_updates(ST.alerts_per_period(_scored_stream(spark, sf)), ["dev_eui", "period_start"])
    return table.withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        raw_features_by_device, ingest_valid, ingest_discards, ingest_pairwise, ingest_lenient,
        features_all, features_eda, features_scrub, label_columns, dominant_peak, harmonic_energy, rule_diagnosis,
        temp_range, min_group, group_sample_cap, hash_sample, numbered_copies, repeated_lines, example_records,
        pred_jsonl_flatten, features_join_predictions, metadata_first, alerts_left_meta, label_dimension,
        severity_confidence, severity_crest, quantiles_crest,
        alerts_filtered, report_table, kpi_row, anomaly_rate, fault_distribution, fault_counts, severity_counts,
        fault_by_severity, device_fault_pivot, box_stats, box_outliers, score_histogram, score_threshold,
        mean_confidence, latest_alerts, clearest_examples, sorted_labels, contamination,
        alerts_per_period, indicator_evolution, fleet_comparison,
        persistence_rows, persistence_range, extreme_scores, confirmed_anomalies,
        standard_scale, robust_scale, iforest_scores, iforest_predict, group_iforest,
        kmeans_best_of_10, nearest_centre, cluster_distribution, silhouette_euclid, silhouette_all, lof_scores, detector_comparison,
        stratified_folds, confusion_matrix, accuracy_f1_macro, classification_report,
        train, fault_classifier, cv_summary, feature_importance_top, supervised_labels,
        predict_batch, prediction_checks, model_roundtrip,
        stream_features, stream_predictions, stream_persistence, stream_alerts,
    )
}
QUERIES |= TABLE_QUERIES
