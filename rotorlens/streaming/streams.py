"""The batch transformations on Structured Streaming, and the aggregations that need a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rotorlens.functions.labels import event_time
from rotorlens.functions.spectral import extract_features
from rotorlens.operators.filters import SERIES
from rotorlens.plans.models import Models, predict_batch
from rotorlens.session import scratch_path
from rotorlens.sources.spectra import parse_lines, stream_lines, valid_spectra


def stream_spectra(spark: SparkSession, path: str, strict: bool = True, **options: str) -> DataFrame:
    """Spectra of text files as they arrive in a folder."""
    return valid_spectra(parse_lines(stream_lines(spark, path, **options), strict))


def stream_features(lines: DataFrame) -> DataFrame:
    """Stateless: the batch parser and extractor."""
    return extract_features(valid_spectra(parse_lines(lines)))


def stream_predictions(features: DataFrame, models: Models) -> DataFrame:
    """Stateless: the models are shipped to the tasks when the query starts."""
    return predict_batch(features, models)


def _timed(scored: DataFrame, delay: str) -> DataFrame:
    return scored.withColumn("timestamp", event_time(F.col("ts_ms"))).withWatermark("timestamp", delay)


def persistent_windows(
    scored: DataFrame, length: str = "6 hours", slide: str = "3 hours", minimum: int = 2, delay: str = "1 hour",
    by: Sequence[str] = SERIES,
) -> DataFrame:
    """Sliding windows of a series with at least ``minimum`` anomalies; records later than the watermark are dropped.

    The row-count definition of the batch filter would need ordered state per series; on streams the time range is
    used, so that state is one counter per open window.
    """
    hits = _timed(scored, delay).groupBy(F.window("timestamp", length, slide).alias("w"), *by).agg(
        F.sum(F.coalesce("is_anomaly", F.lit(False)).cast("int")).alias("anomalies"))
    return hits.filter(F.col("anomalies") >= minimum).select(
        *by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "anomalies")


def alerts_per_period(scored: DataFrame, period: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Alerts per device and tumbling period. ``run_available`` emits each once, when the watermark has passed its end;
    ``run_updates`` has every period of the data read so far."""
    alerts = _timed(scored, delay).filter(F.coalesce("is_anomaly", F.lit(False)))
    counted = alerts.groupBy(F.window("timestamp", period).alias("w"), "dev_eui").agg(F.count("*").alias("alerts"))
    return counted.select("dev_eui", F.col("w.start").alias("period_start"), "alerts")


def run_available(stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything available now into a parquet table and return that table.

    Sink and checkpoint live in the shared folder unless given, so a restarted query goes on where it stopped.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream")
    query = (stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", checkpoint or f"{path}-checkpoint").start(path))
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_updates(stream: DataFrame, keys: Sequence[str], path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process everything available now and return the windows as they stand, those still open included.

    Every micro-batch writes the windows it changed under its number, so a batch that runs again replaces its own rows;
    the latest state of each window is the one of its highest batch.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream")
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{path}/_number=-1")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_number={number}")

    query = (stream.writeStream.outputMode("update").foreachBatch(put).trigger(availableNow=True)
             .option("checkpointLocation", checkpoint or f"{path}-checkpoint").start())
    query.awaitTermination()
    states = spark.read.schema(StructType([*stream.schema.fields, StructField("_number", LongType())])).option("basePath", path).parquet(
        f"{path}/_number=*")
    values = [c for c in stream.columns if c not in keys]
    return states.groupBy(*keys).agg(F.max_by(F.struct(*values), "_number").alias("_v")).select(*keys, "_v.*").select(
        *stream.columns)
