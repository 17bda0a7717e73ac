"""Frames derived from the given tables: one vibration spectrum per event.

The embedding gives a spectrum its shape, the event its scale and metadata. All of them are whole-table derivations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorlens.functions.spectral import extract_features
from rotorlens.operators.alerts import label_predictions
from rotorlens.session import spread

SHAFT_HZ = 10.5
#: A spectrum is some hundred times as much work as the event it comes from, so a split of events is cut to so many.
EVENTS_PER_TASK = 50_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spectra_from(events: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Spectra of an event frame, batch or streaming. All embeddings (ids 0, 1, ...) are shapes; Spark picks the join."""
    count = max(1, embeddings.count())
    shapes = embeddings.select("vec_id", "embedding", "label")
    joined = spread(events, EVENTS_PER_TASK).join(shapes, F.pmod(F.col("event_id"), F.lit(count)) == F.col("vec_id"))
    scale = 1 + F.col("value") / 100
    spectrum = F.transform(
        "embedding",
        lambda x, i: F.struct((i * F.lit(1.5)).cast("double").alias("freq"),
                              (F.abs(x.cast("double")) * scale).alias("value")))
    return joined.select(
        F.col("event_id").cast("string").alias("record_id"),
        "event_id",
        F.concat(F.lit("dev-"), (F.col("user_id") % 3).cast("string")).alias("dev_eui"),
        (1 + F.col("event_id") % 4).cast("double").alias("mode"),
        (1 + F.col("user_id") % 4).cast("double").alias("axis"),
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("double").alias("ts_ms"),
        F.col("value").alias("temp"),
        spectrum.alias("spectrum"),
        (F.col("label") % 4).cast("int").alias("true_label"),
    )


def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra_from(_table(spark, sf_dir, "events"), _table(spark, sf_dir, "embeddings"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_features(spectra(spark, sf_dir))


def lines_from(spectra_frame: DataFrame) -> DataFrame:
    """Spectra as JSON lines with typed leaves; every 50th event carries one kind of damage."""
    kind = F.col("event_id") % 50

    def number(value: Column) -> Column:
        return F.struct(value.cast("string").alias("N"))

    def reading(p: Column, value: Column) -> Column:
        return F.to_json(F.struct(F.struct(number(p["freq"]).alias("frequency"), value.alias("value")).alias("M")))

    def sound(p: Column) -> Column:
        # Numbers have nothing to escape, so plain text gives the same; a null is left to the writer, which omits it.
        text = F.concat(F.lit('{"M":{"frequency":{"N":"'), p["freq"].cast("string"), F.lit('"},"value":{"N":"'),
                        p["value"].cast("string"), F.lit('"}}}'))
        return F.coalesce(text, reading(p, number(p["value"])))

    healthy = F.transform("spectrum", sound)
    no_value = F.transform("spectrum", lambda p: F.to_json(F.struct(F.struct(number(p["freq"]).alias("frequency")).alias("M"))))
    one_bad = F.transform("spectrum", lambda p, i: F.when(
        i == 5, reading(p, F.struct(F.lit("bad").alias("N")))).otherwise(sound(p)))
    foreign = F.concat(F.array(F.lit('{"S":"x"}')), healthy)
    bare = F.concat(F.array(F.lit('{"M":{"frequency":"40","value":{"N":"1"}}}')), healthy)
    readings = (F.when(kind == 17, F.array().cast("array<string>")).when(kind == 19, no_value)
                .when(kind == 29, one_bad).when(kind == 31, foreign).when(kind == 43, bare).otherwise(healthy))

    def leaf(name: str, typed: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":{{"{typed}":"'), value, F.lit('"},'))

    fields = F.concat(
        F.when(kind == 41, F.lit("")).otherwise(leaf("dev_eui", "S", F.col("dev_eui"))),
        F.when(kind == 37, F.lit("")).when(kind == 45, F.lit('"mode":{"N":null},')).otherwise(F.concat(
            leaf("mode", "N", F.col("mode").cast("string")), leaf("axis", "N", F.col("axis").cast("string")))),
        leaf("T1", "N", F.when(kind == 23, F.lit("oops")).otherwise(F.col("temp").cast("string"))),
        leaf("timestamp", "N", F.col("ts_ms").cast("decimal(20,0)").cast("string")),
        F.when(kind == 13, F.lit('"other":{"S":"x"}')).otherwise(
            F.concat(F.lit('"readings":{"L":['), F.array_join(readings, ","), F.lit("]}"))),
    )
    line = (F.when(kind == 3, F.lit("not json")).when(kind == 7, F.lit(""))
            .when(kind == 11, F.lit('{"Other":{}}'))
            .otherwise(F.concat(F.lit('{"Item":{'), fields, F.lit("}}"), F.when(kind == 47, F.lit('],"x":[1')).otherwise(F.lit("")))))
    return spectra_frame.select(line.alias("value"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_from(spectra(spark, sf_dir))


def pseudo_predictions(frame: DataFrame) -> DataFrame:
    """Deterministic stand-in predictions for any frame with ``event_id``."""
    draw = F.pmod(F.col("event_id") * 7919, F.lit(1000))
    anomaly = draw >= 800
    code = F.when(anomaly, F.pmod(F.col("event_id") * 31, F.lit(4))).otherwise(-1).cast("int")
    confidence = F.when(anomaly, F.round(F.lit(0.25) + 0.0007 * F.pmod(F.col("event_id") * 104729, F.lit(1000)), 4)) \
        .otherwise(F.lit(0.0))
    return frame.withColumns({
        "anomaly_score": F.lit(-0.3) - 0.4 * draw / F.lit(1000.0),
        "is_anomaly": anomaly,
        "fault_type": code,
        "confidence": confidence,
    })


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled stand-in predictions alone (no features, no spectra): a narrow scan of the events."""
    events = _table(spark, sf_dir, "events").select("event_id", F.col("event_id").cast("string").alias("record_id"))
    return label_predictions(pseudo_predictions(events))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with labelled stand-in predictions."""
    frame = extract_features(spectra(spark, sf_dir), keep=("event_id", "record_id", "dev_eui", "mode", "axis", "ts_ms"))
    return label_predictions(pseudo_predictions(frame))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True and predicted class of every event."""
    base = spectra(spark, sf_dir).select("record_id", "event_id", F.col("true_label").alias("label"))
    return base.withColumn(
        "prediction", F.when(F.col("event_id") % 10 < 8, F.col("label")).otherwise((F.col("label") + 1) % 4).cast("int"))
