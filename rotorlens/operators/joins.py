"""Joins of features, predictions and dimensions. Rows are matched by ``record_id``, never by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlens.schema import META_COLUMNS


def drop_shared_columns(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("record_id",)) -> DataFrame:
    """``right`` without the columns ``left`` has already: the first of two equal names wins."""
    return right.select(*[c for c in right.columns if c in keys or c not in left.columns])


def features_with_predictions(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Full join: a record missing on one side keeps nulls there; the features' columns win."""
    return features.join(drop_shared_columns(features, predictions), "record_id", "full")


def metadata_with_predictions(features: DataFrame, predictions: DataFrame) -> DataFrame:
    """Metadata columns first, then the predictions."""
    meta = features.select("record_id", *[c for c in META_COLUMNS + ["ts_ms"] if c in features.columns])
    return meta.join(drop_shared_columns(meta, predictions), "record_id", "full")


def predictions_left_metadata(predictions: DataFrame, meta: DataFrame) -> DataFrame:
    """Every prediction is kept; metadata only where it exists."""
    return predictions.join(drop_shared_columns(predictions, meta), "record_id", "left")


def with_dimension(df: DataFrame, dimension: DataFrame, key: str, default: str | None = None) -> DataFrame:
    """Look a code up in a fixed dimension table (a handful of rows built from constants, hence broadcast)."""
    label = [c for c in dimension.columns if c != key][0]
    joined = df.join(F.broadcast(dimension), key, "left")
    return joined.withColumn(label, F.coalesce(label, F.lit(default))) if default is not None else joined


def zero_filled_counts(df: DataFrame, dimension: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Rows per dimension member; members without rows appear with 0."""
    counts = df.groupBy(key).agg(F.count("*").alias(name))
    return dimension.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
