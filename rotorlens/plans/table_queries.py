"""Registered queries that write files to the shared folder and read them back: the library's sources and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rotorlens.functions.spectral import extract_features
from rotorlens.operators import alerts as A
from rotorlens.plans import fixtures as fx
from rotorlens.schema import FEATURES_SCHEMA, MODEL_INPUTS
from rotorlens.session import scratch_path
from rotorlens.sources import spectra as SRC
from rotorlens.sources import tables as TB

_META = ("event_id", "record_id", "dev_eui", "mode", "axis", "ts_ms")


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return extract_features(fx.spectra(spark, sf), keep=_META)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return A.label_predictions(fx.pseudo_predictions(fx.spectra(spark, sf).select(*_META)))


def feature_files(spark: SparkSession, sf: str) -> DataFrame:
    """Feature tables as Parquet and as CSV, read with the declared schema."""
    path = scratch_path(spark, "features")
    table = _features(spark, sf).select(*FEATURES_SCHEMA.names)
    read = []
    for fmt in ("parquet", "csv"):
        TB.write_features(table, f"{path}/{fmt}", fmt)
        read.append(TB.read_features(spark, f"{path}/{fmt}", fmt).select(
            F.lit(fmt).alias("fmt"), "record_id", "dev_eui", *[F.round(c, 6).alias(c) for c in ("axis", "rms", "crest_factor")]))
    return read[0].unionByName(read[1])


def feature_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Ids and metadata columns of a stored feature table; a table that is not there has none."""
    path = scratch_path(spark, "features")
    TB.write_features(_features(spark, sf).select(*FEATURES_SCHEMA.names), path)
    none = TB.read_feature_metadata(spark, f"{path}-none")
    return TB.read_feature_metadata(spark, path).join(none, "record_id", "left_anti")


def model_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """The model's columns in order, nulls (every seventh temperature) as 0."""
    features = _features(spark, sf)
    inputs = TB.select_model_inputs(features.withColumn("temp", F.when(F.col("event_id") % 7 != 0, F.col("temp"))))
    return inputs.select("record_id", *[F.round(c, 6).alias(c) for c in MODEL_INPUTS])


def prediction_files(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions written as JSON lines and read back from the files."""
    path = scratch_path(spark, "predictions")
    TB.write_predictions_jsonl(fx.predictions(spark, sf).select("record_id", "is_anomaly", "fault_type", "confidence"), path)
    return TB.read_predictions_jsonl(spark, path).select("record_id", "is_anomaly", "fault_type", "confidence")


def prediction_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions as JSON arrays per batch of a third of the ids, parsed again."""
    batches = fx.predictions(spark, sf).select("record_id", "is_anomaly", "fault_type", (F.col("event_id") % 3).alias("batch"))
    arrays = TB.predictions_as_json_array(batches, "batch", batch_rows=500)
    rows = TB.parse_predictions(arrays.select(F.col("predictions").alias("value")))
    return rows.select("record_id", "is_anomaly", "fault_type")


def alert_files(spark: SparkSession, sf: str) -> DataFrame:
    """The stored alerts."""
    alerts = TB.write_alert_tables(_labelled(spark, sf), scratch_path(spark, "alerts"))
    return alerts.select("record_id", "dev_eui", "fault_type", "fault_label", "severity_level")


def report_frame_files(spark: SparkSession, sf: str) -> DataFrame:
    """Stored features and predictions (CSV) joined for a report; every 11th record has no prediction."""
    path = scratch_path(spark, "report")
    TB.write_features(_features(spark, sf).select(*FEATURES_SCHEMA.names), f"{path}/features", "csv")
    _labelled(spark, sf).filter("event_id % 11 <> 0").select(
        "record_id", "is_anomaly", "fault_type", "confidence").write.option("header", True).csv(f"{path}/predictions")
    frame = TB.read_report_frame(spark, f"{path}/features", f"{path}/predictions", "csv")
    return frame.select("record_id", "dev_eui", F.round("rms", 6).alias("rms"), "is_anomaly", "fault_type", "confidence")


def chronological_order(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in series and time order: no row of a partition comes before its predecessor."""
    ordered = A.chronological(_labelled(spark, sf)).select(
        F.struct("dev_eui", "mode", "axis", "ts_ms", "record_id").alias("k"), F.monotonically_increasing_id().alias("at"),
        F.spark_partition_id().alias("part"))
    before = F.lag("k").over(Window.partitionBy("part").orderBy("at"))
    return ordered.select((before > F.col("k")).alias("wrong")).agg(
        F.count("*").alias("n"), F.count_if("wrong").alias("inversions"))


def text_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines as files of a text stream, parsed on the way into a table."""
    path = scratch_path(spark, "stream")
    fx.raw_lines(spark, sf).write.text(f"{path}/raw", compression="gzip")  # a fifth of the plain lines
    parsed = SRC.parse_lines(SRC.stream_lines(spark, f"{path}/raw"))
    query = (SRC.valid_spectra(parsed).select("dev_eui", "ts_ms", F.size("spectrum").alias("points")).writeStream
             .format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/out"))
    query.awaitTermination()
    return spark.read.schema("dev_eui string, ts_ms double, points int").parquet(f"{path}/out")


TABLE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {query.__name__: query for query in (
    feature_files, feature_metadata, model_inputs, prediction_files, prediction_arrays, alert_files, report_frame_files,
    chronological_order, text_stream)}
