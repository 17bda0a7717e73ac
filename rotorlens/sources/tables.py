"""Feature, prediction and alert tables: sources, sinks and the folder layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorlens.operators.filters import anomalies, select_existing
from rotorlens.operators.joins import features_with_predictions
from rotorlens.schema import FEATURES_SCHEMA, META_COLUMNS, MODEL_INPUTS, PREDICTION_SCHEMA


def zones(root: str) -> dict[str, str]:
    """Folder layout below one root, on any file system Spark can reach."""
    root = root.rstrip("/")
    return {name: f"{root}/{path}" for name, path in {
        "raw": "raw", "processed": "processed", "models": "models", "outputs": "outputs"}.items()}


def write_features(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("header", True).format(fmt).save(path)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType = FEATURES_SCHEMA) -> DataFrame:
    """Declared schema, no inference pass."""
    return spark.read.schema(schema).option("header", True).format(fmt).load(path)


def read_feature_metadata(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Record id and those metadata columns the table has; an empty frame where there is no table."""
    try:
        table = spark.read.option("header", True).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([T.StructField("record_id", T.StringType())]))
    return select_existing(table, ["record_id", *META_COLUMNS, "ts_ms"])


def select_model_inputs(df: DataFrame, columns: Sequence[str] = tuple(MODEL_INPUTS),
                        keep: Sequence[str] = ("record_id",)) -> DataFrame:
    """The model's columns in order, null as 0; missing columns are an error that lists them."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    kept = [c for c in keep if c in df.columns and c not in columns]
    return df.select(*kept, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])


def write_predictions_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per record; text beyond ASCII stays as it is."""
    df.write.mode(mode).json(path)


def predictions_as_json_array(df: DataFrame, batch_key: str, accept: str = "application/json",
                              batch_rows: int = 1000) -> DataFrame:
    """Predictions as JSON arrays: one array per batch key and run of at most about ``batch_rows`` records.

    A batch key that holds many records is cut by id hash, so no array grows with the data.
    """
    if accept != "application/json":
        raise ValueError(f"unsupported output type: {accept}")
    sizes = df.groupBy(batch_key).agg(F.count("*").alias("_rows"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_rows") / F.lit(batch_rows)))
    placed = df.join(sizes.withColumn("_parts", parts), batch_key).withColumn(
        "part", F.pmod(F.xxhash64("record_id"), F.col("_parts")).cast("int"))
    record = F.struct(*[c for c in df.columns if c != batch_key])
    return placed.groupBy(batch_key, "part").agg(F.to_json(F.collect_list(record)).alias("predictions"))


def parse_predictions(lines: DataFrame, schema: T.StructType = PREDICTION_SCHEMA) -> DataFrame:
    """JSON lines to prediction rows. A line holds one object or a list; other lines and other elements are ignored."""
    text = F.trim("value")
    is_list = text.startswith("[")
    listed = F.when(is_list, text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    # Elements stay text at first, so that one of another kind does not cost its neighbours.
    elements = F.from_json(F.concat(F.lit('{"rows":'), listed, F.lit("}")), "rows array<string>").getField("rows")
    each = lines.filter(F.length(text) > 0).select(is_list.alias("_list"), elements.alias("_rows")).filter(
        F.col("_list") | (F.size("_rows") == 1)).select(F.explode("_rows").alias("_row"))
    objects = each.filter(F.col("_row").startswith("{")).select(F.from_json("_row", schema).alias("_row"))
    return objects.select("_row.*")


def read_predictions_jsonl(spark: SparkSession, paths: str | list[str],
                           schema: T.StructType = PREDICTION_SCHEMA) -> DataFrame:
    return parse_predictions(spark.read.text(paths), schema)


ALERT_COLUMNS = ["record_id", *META_COLUMNS, "ts_ms", "is_anomaly", "fault_type", "fault_label", "confidence",
                 "severity_level"]


_ALERT_TYPES = {"mode": "double", "axis": "double", "ts_ms": "double", "is_anomaly": "boolean", "fault_type": "int",
                "confidence": "double", "anomaly_score": "double"}


def write_alert_tables(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> DataFrame:
    """Write ``all_predictions`` and, from that table, ``alerts``. Returns the alerts as read back.

    The second table is a filter on the first one's files, so the scoring plan runs once.
    """
    spark = df.sparkSession
    everything = f"{path}/all_predictions"
    table = select_existing(df, ALERT_COLUMNS)
    table.write.mode(mode).option("header", True).format(fmt).save(everything)
    stored = spark.read.schema(table.schema).option("header", True).format(fmt).load(everything)
    anomalies(stored).write.mode(mode).option("header", True).format(fmt).save(f"{path}/alerts")
    return spark.read.schema(table.schema).option("header", True).format(fmt).load(f"{path}/alerts")


def read_report_frame(spark: SparkSession, features_path: str, predictions_path: str,
                      fmt: str = "parquet") -> DataFrame:
    """Features and predictions joined for reporting."""
    features = read_features(spark, features_path, fmt)
    predictions = spark.read.option("header", True).format(fmt).load(predictions_path)
    typed = {c: F.col(c).cast(t) for c, t in _ALERT_TYPES.items() if c in predictions.columns}  # a CSV has only text
    return features_with_predictions(features, predictions.withColumns(typed))
