"""Scalar expressions for labels, severities and dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from rotorlens.schema import (
    AXIS_LABELS,
    FAULT_LABELS,
    LABEL_TRANSLATION,
    NORMAL_ALERT_LABEL,
    NORMAL_CODE,
    NORMAL_DESCRIPTION,
    SEVERITY_HIGH_CONFIDENCE,
    SEVERITY_MEDIUM_CONFIDENCE,
    SEVERITY_RANKS,
    SILHOUETTE_GOOD,
    SILHOUETTE_MODERATE,
    UNKNOWN_ALERT_LABEL,
)


def lookup(key: Column, mapping: Mapping, default: Column) -> Column:
    """Look a key up in a small fixed mapping, else take ``default``."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), default)


def event_time(ts_ms: Column) -> Column:
    """Unix milliseconds to a UTC timestamp (the session time zone is UTC)."""
    return F.timestamp_millis(ts_ms.cast("bigint"))


def axis_label(axis: Column) -> Column:
    return lookup(axis, AXIS_LABELS, axis.cast("string"))


def fault_description(fault_type: Column) -> Column:
    """Label used in predictions; every other code reads as normal behaviour."""
    return lookup(fault_type, FAULT_LABELS, F.lit(NORMAL_DESCRIPTION))


def alert_label(fault_type: Column) -> Column:
    """Label used in alert tables; the normal code and unknown codes have their own text."""
    return lookup(F.coalesce(fault_type, F.lit(NORMAL_CODE)),
                  {**FAULT_LABELS, NORMAL_CODE: NORMAL_ALERT_LABEL}, F.lit(UNKNOWN_ALERT_LABEL))


def translate_label(label: Column, translation: Mapping[str, str] = LABEL_TRANSLATION) -> Column:
    """Translated label, the label itself where there is no translation."""
    return lookup(label, translation, label)


def short_text(label: str) -> str:
    """The wording of ``short_label`` for a label of the dimension."""
    _, dash, tail = label.rpartition(" - ")
    return tail.capitalize() if dash else label


def short_label(label: Column) -> Column:
    """Last part after `` - ``, first letter upper, the rest lower; unchanged without a separator."""
    last = F.element_at(F.split(label, " - "), -1)
    capitalised = F.concat(F.upper(F.substring(last, 1, 1)), F.lower(F.substr(last, F.lit(2))))
    return F.when(F.contains(label, F.lit(" - ")), capitalised).otherwise(label)


def mode_label(mode: Column) -> Column:
    return F.coalesce(mode.cast("int").cast("string"), F.lit(""))


def round_confidence(confidence: Column) -> Column:
    return F.round(confidence, 4)


def severity_by_confidence(confidence: Column, is_anomaly: Column) -> Column:
    return (
        F.when(~F.coalesce(is_anomaly, F.lit(False)), F.lit("NONE"))
        .when(confidence >= SEVERITY_HIGH_CONFIDENCE, F.lit("HIGH"))
        .when(confidence >= SEVERITY_MEDIUM_CONFIDENCE, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def severity_rank(level: Column) -> Column:
    return lookup(level, SEVERITY_RANKS, F.lit(len(SEVERITY_RANKS)))


def silhouette_verdict(score: Column) -> Column:
    return (
        F.when(score >= SILHOUETTE_GOOD, F.lit("good"))
        .when(score >= SILHOUETTE_MODERATE, F.lit("moderate"))
        .otherwise(F.lit("low"))
    )


def probabilities_map(probabilities: Column, is_anomaly: Column) -> Column:
    """Class index to probability for anomalies, an empty map for normal records."""
    keys = F.sequence(F.lit(0), F.size(probabilities) - 1)
    filled = F.map_from_arrays(keys, probabilities)
    return F.when(is_anomaly & (F.size(probabilities) > 0), filled).otherwise(
        F.create_map().cast("map<int,double>"))
